"""SQL text for the independent DuckDB oracle.

Reusable CTE bodies for the stand-in roles of ``standins.py``; each
catalogue entry composes them into one statement. Numeric literals in the
sentiment rules are cast to DOUBLE so DuckDB does not switch to DECIMAL
arithmetic.
"""

from __future__ import annotations

from ..config import (
    BOOSTER_DAMPING,
    BOOSTER_INCREMENT,
    COMPOUND_ALPHA,
    CONTRAST_AFTER,
    CONTRAST_BEFORE,
    ENGLISH_SPELLINGS,
    NEGATION_SCALAR,
)
from ..functions.text import keyword_column_name
from . import standins as SI


def lit_list(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def d(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


PPI = """
ppi AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(o_totalprice) AS ppi_value
  FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1
)"""

WTI = """
wti AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(l_extendedprice) AS wti_oil_price
  FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1
)"""

INDICATORS = WTI + f""",
gsc AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
         CAST(SUM(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) / COUNT(l_discount) AS gscpi
  FROM lineitem WHERE l_shipdate IS NOT NULL AND month(l_shipdate) IN ({", ".join(map(str, SI.QUARTER_MONTHS))})
  GROUP BY 1
),
ind AS (
  SELECT COALESCE(gsc.month, wti.month) AS month, gsc.gscpi, wti.wti_oil_price
  FROM gsc FULL OUTER JOIN wti ON gsc.month = wti.month
)"""

RAW_NEWS = f"""
raw_news AS (
  SELECT 'guardian' AS provider,
         strftime(date_trunc('month', o.o_orderdate), '%Y-%m-%d') AS window_start,
         strftime(last_day(o.o_orderdate), '%Y-%m-%d') AS window_end,
         d.text AS title,
         '{SI.NEWS_URL_PREFIX}' || CAST(o.o_custkey AS VARCHAR) AS url,
         d.source AS source, d.lang AS language,
         strftime(o.o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS seen_date,
         '' AS social_image, '' AS source_country, d.doc_id
  FROM documents d JOIN orders o ON d.doc_id = o.o_orderkey
)"""

CLEAN_TEXT = ("trim(regexp_replace(regexp_replace(regexp_replace(lower(coalesce({c}, '')), "
              "'http\\S+', ' ', 'g'), '[^a-z0-9\\s\\-]', ' ', 'g'), '\\s+', ' ', 'g'))")

CLEAN_NEWS = f"""
parsed AS (
  SELECT provider, window_start, window_end, coalesce(title, '') AS title, url,
         coalesce(source, '') AS source, coalesce(language, '') AS language, seen_date,
         social_image, source_country, doc_id,
         CAST(try_strptime(seen_date, '%Y-%m-%dT%H:%M:%SZ') AS TIMESTAMP) AS published_at
  FROM raw_news
),
deduped AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY title, url, published_at
      ORDER BY seen_date, provider, window_start, window_end, source, language,
               social_image, source_country, doc_id) AS rn
    FROM parsed WHERE published_at IS NOT NULL) WHERE rn = 1
),
clean AS (
  SELECT *, {CLEAN_TEXT.format(c='title')} AS clean_text,
         CAST(date_trunc('month', published_at) AS DATE) AS month,
         CAST(length(title) AS INTEGER) AS title_len
  FROM deduped
  WHERE language IN ({lit_list(ENGLISH_SPELLINGS)}) OR language = ''
)"""


def lexicon_values() -> str:
    rows = ", ".join(f"('{t}', {d(v)})" for t, v in SI.STANDIN_LEXICON)
    return f"lex AS (SELECT * FROM (VALUES {rows}) AS v(token, valence))"


def sentiment_ctes(source: str, id_col: str, carry: str = "") -> str:
    """CTEs ending in ``doc_sent(id, carry..., sentiment)`` for texts with hits."""
    carry_sel = f"{carry}, " if carry else ""
    up, down, neg = (lit_list(SI.STANDIN_BOOSTERS_UP), lit_list(SI.STANDIN_BOOSTERS_DOWN),
                     lit_list(SI.STANDIN_NEGATORS))
    steps = []
    prev = "valence"
    for k in (1, 2, 3):
        p = f"p{k}"
        boost = (f"(CASE WHEN {p} IN ({up}) THEN {d(BOOSTER_INCREMENT)} "
                 f"WHEN {p} IN ({down}) THEN {d(-BOOSTER_INCREMENT)} ELSE {d(0.0)} END)")
        signed = f"(CASE WHEN {prev} < 0 THEN -{boost} ELSE {boost} END) * {d(BOOSTER_DAMPING[k - 1])}"
        negate = f"(CASE WHEN {p} IN ({neg}) THEN {d(NEGATION_SCALAR)} ELSE {d(1.0)} END)"
        applies = f"{p} IS NOT NULL AND {p} NOT IN (SELECT token FROM lex)"
        steps.append(f"CASE WHEN {applies} THEN ({prev} + {signed}) * {negate} ELSE {prev} END AS v{k}")
        prev = f"v{k}"
    step_sql = ""
    cur = "hits"
    for k, s in enumerate(steps, start=1):
        step_sql += f",\nsv{k} AS (SELECT *, {s} FROM {cur})"
        cur = f"sv{k}"
    contrast = (f"CASE WHEN contrast_pos < 0 THEN {d(1.0)} WHEN pos < contrast_pos THEN {d(CONTRAST_BEFORE)} "
                f"WHEN pos > contrast_pos THEN {d(CONTRAST_AFTER)} ELSE {d(1.0)} END")
    return f"""{lexicon_values()},
toks AS (SELECT {id_col}, {carry_sel}string_split(clean_text, ' ') AS t FROM {source}),
ctx AS (
  SELECT {id_col}, {carry_sel}coalesce(list_position(t, '{SI.STANDIN_CONTRAST}'), 0) - 1 AS contrast_pos,
         unnest(list_transform(t, lambda x, i: {{'pos': i - 1, 'tok': x,
            'p1': CASE WHEN i > 1 THEN t[i - 1] END,
            'p2': CASE WHEN i > 2 THEN t[i - 2] END,
            'p3': CASE WHEN i > 3 THEN t[i - 3] END}})) AS c
  FROM toks
),
hits AS (
  SELECT {id_col}, {carry_sel}contrast_pos, c.pos AS pos, c.p1 AS p1, c.p2 AS p2, c.p3 AS p3, lex.valence
  FROM ctx JOIN lex ON c.tok = lex.token
){step_sql},
scored AS (SELECT {id_col}, {carry_sel}v3 * ({contrast}) AS score FROM sv3),
doc_sent AS (
  SELECT {id_col}, {carry_sel}round(greatest(least(s / sqrt(s * s + {d(COMPOUND_ALPHA)}), {d(1.0)}), {d(-1.0)}), 4) AS sentiment
  FROM (SELECT {id_col}, {carry_sel}SUM(score) AS s FROM scored GROUP BY ALL)
)"""


def monthly_news_ctes() -> str:
    kws = ",\n         ".join(
        f"CAST(SUM(CASE WHEN contains(clean_text, '{k}') THEN 1 ELSE 0 END) AS BIGINT) AS {keyword_column_name(k)}"
        for k in SI.STANDIN_KEYWORDS)
    return f"""{sentiment_ctes('clean', 'doc_id', 'month')},
stats AS (
  SELECT month, COUNT(title) AS article_count, COUNT(*) AS n_rows, AVG(title_len) AS avg_title_len,
         COUNT(DISTINCT source) AS unique_sources,
         {kws}
  FROM clean WHERE month IS NOT NULL GROUP BY month
),
msent AS (
  SELECT month, CAST(SUM(CAST(sentiment AS DECIMAL(38,4))) AS DOUBLE) AS sentiment_sum, SUM(CASE WHEN sentiment < 0 THEN 1 ELSE 0 END) AS negative_count
  FROM doc_sent GROUP BY month
),
news AS (
  SELECT stats.month, article_count,
         coalesce(sentiment_sum, {d(0.0)}) / n_rows AS avg_sentiment,
         coalesce(negative_count, 0) / n_rows AS negative_share,
         avg_title_len, unique_sources,
         {", ".join(keyword_column_name(k) for k in SI.STANDIN_KEYWORDS)}
  FROM stats LEFT JOIN msent ON stats.month = msent.month
)"""


def pct(col: str, order: str = "month", part: str = "") -> str:
    pb = f"PARTITION BY {part} " if part else ""
    cur = f"last_value({col} IGNORE NULLS) OVER ({pb}ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    prev = f"last_value({col} IGNORE NULLS) OVER ({pb}ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"({cur} / NULLIF({prev}, 0) - 1) * 100"


def series_feature_ctes(src: str = "ppi", part: str = "") -> str:
    """``feat1`` adds change/lag/rolling, ``feat2`` lagged change + lead."""
    pb = f"PARTITION BY {part} " if part else ""
    w3 = f"({pb}ORDER BY month ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)"
    return f"""
feat1 AS (
  SELECT *, {pct('ppi_value', part=part)} AS ppi_pct_change,
         lag(ppi_value, 1) OVER ({pb}ORDER BY month) AS ppi_lag_1,
         CASE WHEN count(ppi_value) OVER {w3} = 3 THEN avg(ppi_value) OVER {w3} END AS ppi_ma_3,
         CASE WHEN count(ppi_value) OVER {w3} = 3 THEN stddev_samp(ppi_value) OVER {w3} END AS ppi_std_3
  FROM {src}
),
feat2 AS (
  SELECT *, lag(ppi_pct_change, 1) OVER ({pb}ORDER BY month) AS ppi_pct_change_lag_1,
         lead(ppi_pct_change, 1) OVER ({pb}ORDER BY month) AS target_pct_change_next_month
  FROM feat1
)"""


def class_expr(v: str = "target_pct_change_next_month") -> str:
    return (f"CASE WHEN {v} IS NULL THEN NULL WHEN {v} <= low_cut THEN 'low' "
            f"WHEN {v} <= high_cut THEN 'medium' ELSE 'high' END")


def r6(cols) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)
