"""Catalogue entries beyond the minimum slice (registered on import)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import clean_text, keyword_column_name, keyword_flags, text_length
from ..operators import news as N
from ..operators import report as R
from ..operators import sentiment as SE
from ..operators import series as S
from ..operators import upsert as U
from . import oracle_sql as Q
from . import standins as SI
from .catalog import (
    MODEL_TABLE_CTES,
    PANEL_PPI,
    clean_news,
    feature_table,
    register,
)
from .feature_table import monthly_series

KW = SI.STANDIN_KEYWORDS
KW_COLS = [keyword_column_name(k) for k in KW]
DOC_CLEAN = Q.CLEAN_TEXT.format(c="text")
BASE_NEWS = f"{Q.RAW_NEWS},{Q.CLEAN_NEWS}"


def _docs(spark, sf):
    return SI.table(spark, sf, "documents")


def _news_features(spark, sf):
    return N.monthly_news_features(clean_news(spark, sf), SI.lexicon(spark), KW, id_col="doc_id",
                                   **SI.sentiment_rules())


# ---------------------------------------------------------------------------
# 2. Text
# ---------------------------------------------------------------------------

@register("clean_text", f"SELECT doc_id, {DOC_CLEAN} AS clean_text FROM documents")
def q_clean_text(spark, sf):
    return _docs(spark, sf).select("doc_id", clean_text("text").alias("clean_text"))


@register("keyword_flags", f"""
SELECT doc_id, {", ".join(f"CAST(contains(c, '{k}') AS INTEGER) AS {keyword_column_name(k)}" for k in KW)}
FROM (SELECT doc_id, {DOC_CLEAN} AS c FROM documents)
""")
def q_keyword_flags(spark, sf):
    d = _docs(spark, sf).select("doc_id", clean_text("text").alias("c"))
    return d.select("doc_id", *[v.alias(k) for k, v in keyword_flags("c", KW).items()])


@register("title_length", "SELECT doc_id, CAST(length(text) AS INTEGER) AS title_len FROM documents")
def q_title_length(spark, sf):
    return _docs(spark, sf).select("doc_id", text_length("text").alias("title_len"))


@register("dedup_articles", f"WITH {BASE_NEWS}\nSELECT doc_id, url, published_at FROM deduped")
def q_dedup_articles(spark, sf):
    return N.parse_and_dedup(SI.raw_news(spark, sf)).select("doc_id", "url", "published_at")


@register("language_filter", f"""
WITH {BASE_NEWS}
SELECT doc_id, language FROM deduped
WHERE language IN ({Q.lit_list(["English", "english", "EN", "en"])}) OR language = ''
""")
def q_language_filter(spark, sf):
    return N.language_filter(N.parse_and_dedup(SI.raw_news(spark, sf))).select("doc_id", "language")


@register("monthly_news_features", f"WITH {BASE_NEWS},{Q.monthly_news_ctes()}\nSELECT * FROM news")
def q_monthly_news_features(spark, sf):
    return _news_features(spark, sf)


@register("keyword_monthly_counts", f"WITH {BASE_NEWS},{Q.monthly_news_ctes()}\nSELECT month, {', '.join(KW_COLS)} FROM stats")
def q_keyword_monthly_counts(spark, sf):
    return N.monthly_article_stats(clean_news(spark, sf), KW).select("month", *KW_COLS)


@register("unique_sources", f"WITH {BASE_NEWS}\nSELECT month, COUNT(DISTINCT source) AS unique_sources FROM clean GROUP BY month")
def q_unique_sources(spark, sf):
    return clean_news(spark, sf).groupBy("month").agg(F.count_distinct("source").alias("unique_sources"))


@register("lexicon_sentiment", f"""
WITH dclean AS (SELECT doc_id, {DOC_CLEAN} AS clean_text FROM documents),
{Q.sentiment_ctes('dclean', 'doc_id')}
SELECT dclean.doc_id, coalesce(doc_sent.sentiment, CAST(0.0 AS DOUBLE)) AS sentiment
FROM dclean LEFT JOIN doc_sent ON dclean.doc_id = doc_sent.doc_id
""")
def q_lexicon_sentiment(spark, sf):
    d = _docs(spark, sf).select("doc_id", clean_text("text").alias("clean_text"))
    return SE.score_all(d, "clean_text", "doc_id", SI.lexicon(spark), **SI.sentiment_rules())


@register("fillna_string", """
SELECT o.o_orderkey, coalesce(d.text, '') AS title, coalesce(d.source, '') AS source,
       coalesce(d.lang, '') AS language
FROM orders o LEFT JOIN documents d ON o.o_orderkey = d.doc_id
""")
def q_fillna_string(spark, sf):
    o, d = SI.table(spark, sf, "orders"), _docs(spark, sf)
    j = o.join(d, o.o_orderkey == d.doc_id, "left").select(
        "o_orderkey", F.col("text").alias("title"), "source", F.col("lang").alias("language"))
    return j.fillna("", subset=["title", "source", "language"])


@register("news_scan_sorted", f"""
WITH {BASE_NEWS}
SELECT doc_id, published_at, month, title_len, language FROM clean ORDER BY published_at ASC NULLS LAST
""")
def q_news_scan_sorted(spark, sf):
    from ..sources.tables import scan_sorted
    return scan_sorted(clean_news(spark, sf).select("doc_id", "published_at", "month", "title_len", "language"),
                       "published_at")


# ---------------------------------------------------------------------------
# 3. Joins, fill, indicator features
# ---------------------------------------------------------------------------

NEWS_COLS = ["article_count", "avg_sentiment", "negative_share", "avg_title_len", "unique_sources", *KW_COLS]


@register("left_join_zero_fill", f"""
WITH {Q.PPI},{BASE_NEWS},{Q.monthly_news_ctes()},
base AS (SELECT DISTINCT month, ppi_value FROM ppi)
SELECT base.month, base.ppi_value,
       {", ".join(f"coalesce(news.{c}, 0) AS {c}" for c in NEWS_COLS)}
FROM base LEFT JOIN news ON base.month = news.month
""")
def q_left_join_zero_fill(spark, sf):
    base = monthly_series(SI.price_series(spark, sf))
    return base.join(_news_features(spark, sf), "month", "left").fillna(0, subset=NEWS_COLS)


@register("indicator_outer_join", f"WITH {Q.INDICATORS}\nSELECT month, gscpi, wti_oil_price FROM ind")
def q_indicator_outer_join(spark, sf):
    return SI.indicators(spark, sf)


FFILL_SQL = f"""{Q.PPI},{Q.INDICATORS},
base AS (SELECT DISTINCT month, ppi_value FROM ppi),
filled AS (
  SELECT base.month, base.ppi_value,
    last_value(ind.gscpi IGNORE NULLS) OVER (ORDER BY base.month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS gscpi,
    last_value(ind.wti_oil_price IGNORE NULLS) OVER (ORDER BY base.month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS wti_oil_price
  FROM base LEFT JOIN ind ON base.month = ind.month
)"""


def _filled(spark, sf):
    return S.left_join_ffill(monthly_series(SI.price_series(spark, sf)), SI.indicators(spark, sf))


@register("indicator_left_join_ffill", f"WITH {FFILL_SQL}\nSELECT month, ppi_value, gscpi, wti_oil_price FROM filled")
def q_indicator_left_join_ffill(spark, sf):
    return _filled(spark, sf).select("month", "ppi_value", "gscpi", "wti_oil_price")


IND = ["gscpi", "wti_oil_price"]
IND_FEATS = [f"{c}_{s}" for c in IND for s in ("pct_change", "lag_1", "pct_change_lag_1")]


@register("indicator_features", f"""
WITH {FFILL_SQL},
f1 AS (SELECT *, {", ".join(f"{Q.pct(c)} AS {c}_pct_change, lag({c}, 1) OVER (ORDER BY month) AS {c}_lag_1" for c in IND)} FROM filled),
f2 AS (SELECT *, {", ".join(f"lag({c}_pct_change, 1) OVER (ORDER BY month) AS {c}_pct_change_lag_1" for c in IND)} FROM f1)
SELECT month, {", ".join(IND_FEATS)} FROM f2
""")
def q_indicator_features(spark, sf):
    return S.indicator_features(_filled(spark, sf), IND).select("month", *IND_FEATS)


@register("distinct_pairs", f"WITH {PANEL_PPI}\nSELECT DISTINCT month, ppi_value FROM panel")
def q_distinct_pairs(spark, sf):
    orders = SI.table(spark, sf, "orders")
    panel = S.monthly_mean(orders, "o_orderdate", "o_totalprice", "ppi_value", keys=["o_orderpriority"],
                           exact_scale=2)
    return S.distinct_series(panel)


# ---------------------------------------------------------------------------
# 4. Upsert family. Target = the collection as loaded before 1998 (last
#    row per url); batch = everything seen from 1997 on (overlapping year).
# ---------------------------------------------------------------------------

SEQ = ["seen_date", "doc_id"]
TARGET_CUT, BATCH_FROM = "1998-01-01", "1997-01-01"
RAW_COLS = ["provider", "window_start", "window_end", "title", "url", "source", "language", "seen_date",
            "social_image", "source_country", "doc_id"]
RAW_NON_KEY = [c for c in RAW_COLS if c != "url"]


def _target_and_batch(spark, sf):
    raw = SI.raw_news(spark, sf)
    target = U.dedup_keep_last(raw.where(F.col("seen_date") < TARGET_CUT), ["url"], SEQ)
    batch = raw.where(F.col("seen_date") >= BATCH_FROM)
    return target, batch


UPSERT_SQL = f"""{Q.RAW_NEWS},
tgt AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY url ORDER BY seen_date DESC, doc_id DESC) AS rn
    FROM raw_news WHERE seen_date < '{TARGET_CUT}' AND url IS NOT NULL) WHERE rn = 1
),
bat AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY url ORDER BY seen_date DESC, doc_id DESC) AS rn
    FROM raw_news WHERE seen_date >= '{BATCH_FROM}' AND url IS NOT NULL) WHERE rn = 1
),
merged AS (
  SELECT coalesce(t.url, b.url) AS url,
         {", ".join(f"CASE WHEN b.url IS NOT NULL THEN b.{c} ELSE t.{c} END AS {c}" for c in RAW_NON_KEY)},
         CASE WHEN t.url IS NULL THEN 'inserted' WHEN b.url IS NULL THEN 'untouched'
              WHEN {" AND ".join(f"t.{c} IS NOT DISTINCT FROM b.{c}" for c in RAW_NON_KEY)} THEN 'unchanged'
              ELSE 'modified' END AS change
  FROM tgt t FULL OUTER JOIN bat b ON t.url = b.url
)"""


@register("dedup_keep_last", f"WITH {UPSERT_SQL}\nSELECT url, doc_id, seen_date FROM bat")
def q_dedup_keep_last(spark, sf):
    _, batch = _target_and_batch(spark, sf)
    return U.dedup_keep_last(batch, ["url"], SEQ).select("url", "doc_id", "seen_date")


@register("upsert_merge", f"WITH {UPSERT_SQL}\nSELECT url, doc_id, seen_date, language, source FROM merged")
def q_upsert_merge(spark, sf):
    target, batch = _target_and_batch(spark, sf)
    return U.upsert_merge(target, batch, ["url"], seq_col=SEQ).select("url", "doc_id", "seen_date", "language",
                                                                        "source")


@register("upsert_partitioned_merge", f"""
WITH {UPSERT_SQL}
SELECT url, doc_id, seen_date, language, source,
       CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 11 = 0 THEN '' ELSE substr(seen_date, 1, 7) END AS load_month
FROM merged
""")
def q_upsert_partitioned_merge(spark, sf):
    """The same two loads as ``upsert_merge`` into a month-partitioned table
    that rewrites only the partitions each batch touches. Some rows have no
    month and some an empty one, and updated rows move between all three."""
    from ..session import scratch_path
    from ..sinks.tables import PartitionedUpsertTable
    raw = SI.raw_news(spark, sf)
    table = PartitionedUpsertTable(spark, scratch_path(spark, "raw-news-partitioned"), ["url"], "load_month")
    month = (F.when(F.col("doc_id") % 7 == 0, F.lit(None)).when(F.col("doc_id") % 11 == 0, "")
             .otherwise(F.substring("seen_date", 1, 7)))
    table.upsert(raw.where(F.col("seen_date") < TARGET_CUT), "initial", month, seq_col=SEQ)
    table.upsert(raw.where(F.col("seen_date") >= BATCH_FROM), "batch-1", month, seq_col=SEQ)
    return table.read().select("url", "doc_id", "seen_date", "language", "source", "load_month")


@register("upsert_change_counts", f"""
WITH {UPSERT_SQL}
SELECT {", ".join(f"CAST(SUM(CASE WHEN change = '{k}' THEN 1 ELSE 0 END) AS BIGINT) AS {k}" for k in ("inserted", "modified", "unchanged", "untouched"))},
       CAST(SUM(CASE WHEN change IN ('inserted', 'modified') THEN 1 ELSE 0 END) AS BIGINT) AS changed
FROM merged
""")
def q_upsert_change_counts(spark, sf):
    target, batch = _target_and_batch(spark, sf)
    return U.change_counts(U.merge_with_changes(target, batch, ["url"], seq_col=SEQ))


@register("duplicate_key_audit", f"""
WITH {Q.RAW_NEWS}
SELECT url, COUNT(*) AS n, MIN(doc_id) AS keep, COUNT(*) - 1 AS n_extra
FROM raw_news WHERE url IS NOT NULL AND url <> '' GROUP BY url HAVING COUNT(*) > 1
""")
def q_duplicate_key_audit(spark, sf):
    return U.duplicate_key_audit(SI.raw_news(spark, sf), ["url"], "doc_id")


@register("dedup_keep_first_by_key", f"""
WITH {Q.RAW_NEWS}
SELECT url, doc_id FROM (
  SELECT url, doc_id, row_number() OVER (PARTITION BY url ORDER BY doc_id) AS rn
  FROM raw_news WHERE url IS NOT NULL AND url <> '') WHERE rn = 1
UNION ALL
SELECT url, doc_id FROM raw_news WHERE url IS NULL OR url = ''
""")
def q_dedup_keep_first_by_key(spark, sf):
    return U.dedup_keep_first_by_key(SI.raw_news(spark, sf), ["url"], "doc_id").select("url", "doc_id")


# ---------------------------------------------------------------------------
# 5. Report and ad-hoc queries
# ---------------------------------------------------------------------------

@register("recent_articles", f"""
WITH {BASE_NEWS}
SELECT coalesce(strftime(published_at, '%Y-%m-%d'), '') AS published_at, provider, source, title, url, language
FROM clean ORDER BY published_at DESC NULLS FIRST, url DESC NULLS FIRST, title DESC NULLS FIRST LIMIT 20
""")
def q_recent_articles(spark, sf):
    return R.recent_articles(clean_news(spark, sf), 20)


@register("api_news_articles", f"""
WITH {BASE_NEWS}
SELECT provider, coalesce(strftime(published_at, '%Y-%m-%d'), '') AS published_at,
       coalesce(strftime(try_strptime(seen_date, '%Y-%m-%dT%H:%M:%SZ'), '%Y-%m-%d'), '') AS seen_date,
       coalesce(strftime(month, '%Y-%m-%d'), '') AS month, title, url, source, language, source_country,
       clean_text
FROM clean ORDER BY clean.published_at DESC NULLS FIRST, url DESC NULLS FIRST, title DESC NULLS FIRST LIMIT 50
""")
def q_api_news_articles(spark, sf):
    return R.api_articles(clean_news(spark, sf), None, limit=50, cleaned=True)


@register("recent_raw_articles", f"""
WITH {Q.RAW_NEWS}
SELECT provider, seen_date, title, url, source, language, source_country
FROM raw_news ORDER BY seen_date DESC NULLS FIRST, url DESC NULLS FIRST, doc_id DESC NULLS FIRST LIMIT 50
""")
def q_recent_raw_articles(spark, sf):
    return R.recent_raw_articles(SI.raw_news(spark, sf), 50, tiebreak=("url", "doc_id"))


@register("api_raw_articles", f"""
WITH {Q.RAW_NEWS},
shown AS (SELECT * REPLACE (CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN 'unknown' ELSE seen_date END AS seen_date,
                            CASE WHEN doc_id % 3 = 0 THEN NULL ELSE source END AS source) FROM raw_news)
SELECT provider, coalesce(strftime(try_strptime(seen_date, '%Y-%m-%dT%H:%M:%SZ'), '%Y-%m-%d'), '') AS seen_date,
       coalesce(title, '') AS title, coalesce(url, '') AS url, coalesce(source, '') AS source, coalesce(language, '') AS language,
       coalesce(source_country, '') AS source_country
FROM shown ORDER BY shown.seen_date DESC NULLS FIRST, shown.url DESC NULLS FIRST, doc_id DESC NULLS FIRST LIMIT 500
""")
def q_api_raw_articles(spark, sf):
    """The listing of the raw table, with missing and unreadable dates."""
    raw = SI.raw_news(spark, sf)
    five, seven = F.col("doc_id") % 5 == 0, F.col("doc_id") % 7 == 0
    raw = raw.withColumns({"seen_date": F.when(five, F.lit(None)).when(seven, "unknown").otherwise(F.col("seen_date")),
                           "source": F.when(F.col("doc_id") % 3 == 0, F.lit(None)).otherwise(F.col("source"))})
    return R.api_articles(None, raw, limit=500, cleaned=False, tiebreak=("url", "doc_id"))


@register("news_signal_trend", f"""
WITH {MODEL_TABLE_CTES},
tail AS (SELECT month, CAST(coalesce(article_count, 0) AS INTEGER) AS article_count,
                coalesce(avg_sentiment, CAST(0.0 AS DOUBLE)) AS avg_sentiment
         FROM model_table ORDER BY month DESC LIMIT 18)
SELECT strftime(month, '%Y-%m') AS month, article_count, avg_sentiment,
       least(CAST(100.0 AS DOUBLE), article_count / greatest(max(article_count) OVER (), 1) * CAST(100.0 AS DOUBLE)) AS volume_width,
       least(CAST(100.0 AS DOUBLE), abs(avg_sentiment) * CAST(100.0 AS DOUBLE)) AS sentiment_width,
       CASE WHEN avg_sentiment >= 0 THEN 'sentiment-positive' ELSE 'sentiment-negative' END AS sentiment_class
FROM tail
""")
def q_news_signal_trend(spark, sf):
    return R.news_signal_trend(feature_table(spark, sf))


@register("external_indicator_trend", f"""
WITH {MODEL_TABLE_CTES}
SELECT strftime(month, '%Y-%m') AS month, gscpi, wti_oil_price
FROM (SELECT * FROM model_table ORDER BY month DESC LIMIT 18)
""")
def q_external_indicator_trend(spark, sf):
    return R.external_indicator_trend(feature_table(spark, sf)).select("month", "gscpi", "wti_oil_price")


@register("latest_row", f"""
WITH {MODEL_TABLE_CTES}
SELECT month, ppi_value, article_count, target_class FROM model_table ORDER BY month DESC LIMIT 1
""")
def q_latest_row(spark, sf):
    return R.latest_row(feature_table(spark, sf)).select("month", "ppi_value", "article_count", "target_class")


@register("stage_row_counts", f"""
WITH {MODEL_TABLE_CTES}
SELECT 'fred_series' AS stage, COUNT(*) AS rows FROM ppi
UNION ALL SELECT 'raw_news', COUNT(*) FROM raw_news
UNION ALL SELECT 'clean_news', COUNT(*) FROM clean
UNION ALL SELECT 'model_table', COUNT(*) FROM model_table
""")
def q_stage_row_counts(spark, sf):
    """Row counts of the stage outputs. The cleaned news is written once to
    the shared checkpoint folder (as the stage runner writes it) and both its
    count and the model table are built from that table."""
    from .feature_table import build_feature_table
    from .sizing import materialize
    clean = materialize(clean_news(spark, sf))
    model = build_feature_table(SI.price_series(spark, sf), clean, SI.lexicon(spark),
                                indicators=SI.indicators(spark, sf), keywords=SI.STANDIN_KEYWORDS,
                                id_col="doc_id", **SI.sentiment_rules())
    return R.stage_counts({
        "fred_series": SI.price_series(spark, sf),
        "raw_news": SI.raw_news(spark, sf),
        "clean_news": clean,
        "model_table": model,
    })


from . import catalog_sources  # noqa: E402,F401  (registers the remaining entries)


# ---------------------------------------------------------------------------
# Options: calendar gaps, bounded fill, cuts from the training months
# ---------------------------------------------------------------------------

#: A stand-in series that is not published in these months.
SILENT_MONTHS = [5, 10, 11]
GAPPY = f"""
gappy AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
                 CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / COUNT(l_quantity) AS ppi_value
          FROM lineitem WHERE l_shipdate IS NOT NULL AND month(l_shipdate) NOT IN ({", ".join(map(str, SILENT_MONTHS))}) GROUP BY 1)"""


def _gappy(spark, sf):
    li = SI.table(spark, sf, "lineitem").where(~F.month("l_shipdate").isin(SILENT_MONTHS))
    return S.monthly_mean(li, "l_shipdate", "l_quantity", "ppi_value", exact_scale=2)


@register("dense_months", f"""
WITH {GAPPY},
ends AS (SELECT min(month) AS a, max(month) AS b FROM gappy),
months AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS DATE) AS month FROM ends)
SELECT months.month, ppi_value FROM months LEFT JOIN gappy ON gappy.month = months.month
""")
def q_dense_months(spark, sf):
    return S.dense_months(_gappy(spark, sf)).select("month", "ppi_value")


@register("calendar_series_features", f"""
WITH {GAPPY},
lagged AS (SELECT g.month, g.ppi_value, a.ppi_value AS l1, b.ppi_value AS l2, c.ppi_value AS l3
           FROM gappy g LEFT JOIN gappy a ON a.month = g.month - INTERVAL 1 MONTH
           LEFT JOIN gappy b ON b.month = g.month - INTERVAL 2 MONTH LEFT JOIN gappy c ON c.month = g.month - INTERVAL 3 MONTH)
SELECT month, round(l1, 6) AS ppi_lag_1, round((ppi_value - l1) / NULLIF(l1, 0) * 100, 6) AS ppi_pct_change,
       round((l1 - l2) / NULLIF(l2, 0) * 100, 6) AS ppi_pct_change_lag_1, round((l1 + l2 + l3) / 3, 6) AS ppi_ma_3,
       CASE WHEN l1 + l2 + l3 IS NOT NULL THEN round(list_stddev_samp([l1, l2, l3]), 6) END AS ppi_std_3
FROM lagged
""")
def q_calendar_series_features(spark, sf):
    """A lag is a calendar month: rows after a silent month have none."""
    cols = ["ppi_lag_1", "ppi_pct_change", "ppi_pct_change_lag_1", "ppi_ma_3", "ppi_std_3"]
    return S.calendar_series_features(_gappy(spark, sf)).select("month", *[F.round(c, 6).alias(c) for c in cols])


@register("bounded_forward_fill", f"""
WITH {GAPPY},
ends AS (SELECT min(month) AS a, max(month) AS b FROM gappy),
months AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS DATE) AS month FROM ends),
dense AS (SELECT months.month, ppi_value AS v FROM months LEFT JOIN gappy ON gappy.month = months.month)
SELECT month, coalesce(v, lag(v, 1) OVER w) AS one, coalesce(v, lag(v, 1) OVER w, lag(v, 2) OVER w, lag(v, 3) OVER w) AS three
FROM dense WINDOW w AS (ORDER BY month)
""")
def q_bounded_forward_fill(spark, sf):
    """The two silent months in a row are filled by a limit of three, the
    second of them not by a limit of one."""
    dense = S.dense_months(_gappy(spark, sf)).select("month", F.col("ppi_value").alias("one"), F.col("ppi_value").alias("three"))
    return S.forward_fill(S.forward_fill(dense, ["one"], limit=1), ["three"], limit=3)
