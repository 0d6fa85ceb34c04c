"""Catalogue entries: sources, split / metrics, scalar functions, ML fits and
streaming (registered on import)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..config import HIGH_QUANTILE, LOW_QUANTILE, CLASS_LABELS, TEST_SIZE_MONTHS
from ..functions.dates import format_compact_datetime, parse_timestamps, try_date
from ..functions.formatting import capitalize, format_fixed, format_percent
from ..functions.numeric import coerce_double, falsy_coalesce, nan_to_null
from ..functions.text import boolean_text_filter, clean_text
from ..operators import labels as L
from ..operators import metrics as M
from ..operators import series as S
from ..sources import calendar as CAL
from ..sources import payloads as P
from ..sources.series import clean_series, table_guard
from . import oracle_sql as Q
from . import standins as SI
from .catalog import clean_news, ppi_monthly, register
from .feature_table import PPI_FEATURES
from .sizing import materialize

MIN_ROWS = TEST_SIZE_MONTHS + 6 + 1


# ---------------------------------------------------------------------------
# PPI-only model table (the pipeline without news and indicators)
# ---------------------------------------------------------------------------

def ppi_model_table(spark, sf, dropna: bool = True):
    df = L.add_target_class(S.target_lead(S.series_features(ppi_monthly(spark, sf))))
    return df.dropna(subset=[*PPI_FEATURES, "target_class"]) if dropna else df


PMT = f"""{Q.PPI},{Q.series_feature_ctes()},
pcuts AS (
  SELECT *, quantile_cont(target_pct_change_next_month, 0.33) OVER () AS low_cut,
            quantile_cont(target_pct_change_next_month, 0.67) OVER () AS high_cut
  FROM feat2
),
pall AS (SELECT * EXCLUDE (low_cut, high_cut), {Q.class_expr()} AS target_class FROM pcuts),
pmt AS (
  SELECT * FROM pall WHERE ppi_lag_1 IS NOT NULL AND ppi_pct_change_lag_1 IS NOT NULL
    AND ppi_ma_3 IS NOT NULL AND ppi_std_3 IS NOT NULL AND target_class IS NOT NULL
),
evald AS (
  SELECT *, lag(target_class, 1) OVER (ORDER BY month) AS predicted,
         row_number() OVER (ORDER BY month DESC) <= {TEST_SIZE_MONTHS} AS is_test
  FROM pmt
),
test AS (SELECT * FROM evald WHERE is_test),
train AS (SELECT * FROM evald WHERE NOT is_test)"""


def evaluated(spark, sf):
    """PPI model table + persistence forecast (last month's class) + split.

    The month-level table is referenced by several branches (split top-k,
    join-back, per-label unions), so it is materialised once."""
    pmt = ppi_model_table(spark, sf)
    pmt = pmt.withColumn("predicted", F.lag("target_class", 1).over(Window.orderBy("month")))
    return M.chronological_split(materialize(pmt), TEST_SIZE_MONTHS)


def _test(spark, sf):
    return evaluated(spark, sf).where(F.col("is_test"))


def _r(df, cols, places=6):
    return df.withColumns({c: F.round(F.col(c), places) for c in cols})


def _r_sql(cols):
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


# ---------------------------------------------------------------------------
# 7. Split and metrics
# ---------------------------------------------------------------------------

@register("chronological_split", f"WITH {PMT}\nSELECT month, is_test FROM evald")
def q_chronological_split(spark, sf):
    return evaluated(spark, sf).select("month", "is_test")


@register("class_distribution", f"WITH {PMT}\nSELECT target_class, COUNT(*) AS count FROM pmt GROUP BY 1")
def q_class_distribution(spark, sf):
    return M.class_distribution(ppi_model_table(spark, sf), "target_class")


@register("target_class_train_fit", f"""
WITH {Q.PPI},{Q.series_feature_ctes()},
seen AS (SELECT *, count(target_pct_change_next_month) OVER (ORDER BY month DESC ROWS UNBOUNDED PRECEDING) AS from_here FROM feat2),
tcuts AS (SELECT quantile_cont(target_pct_change_next_month, 0.33) AS low_cut, quantile_cont(target_pct_change_next_month, 0.67) AS high_cut
          FROM seen WHERE from_here > {TEST_SIZE_MONTHS}),
cut AS (SELECT seen.*, low_cut, high_cut FROM seen, tcuts)
SELECT month, {Q.class_expr()} AS target_class, round(low_cut, 6) AS low_cut, round(high_cut, 6) AS high_cut FROM cut
""")
def q_target_class_train_fit(spark, sf):
    """Class cuts from the training months only."""
    df = L.add_target_class(S.target_lead(S.series_features(ppi_monthly(spark, sf))), holdout=TEST_SIZE_MONTHS, with_cuts=True)
    return _r(df.select("month", "target_class", "low_cut", "high_cut"), ["low_cut", "high_cut"])


@register("quantile_sketch_cuts", """
SELECT l_returnflag, COUNT(*) AS n, TRUE AS low_within, TRUE AS high_within FROM lineitem
WHERE l_extendedprice IS NOT NULL GROUP BY l_returnflag
""")
def q_quantile_sketch_cuts(spark, sf):
    """Cuts of each flag's prices from sketches of its shipping months, merged;
    whether their true ranks lie within 1 % of those asked for."""
    li = SI.table(spark, sf, "lineitem").select("l_returnflag", F.trunc("l_shipdate", "month").alias("month"), "l_extendedprice")
    monthly = L.quantile_sketches(li, "l_extendedprice", ["l_returnflag", "month"])
    merged = L.merged_sketches(monthly, ["l_returnflag"])
    cuts = L.sketch_cuts(merged, keys=["l_returnflag"])
    ranks = li.where(F.col("l_extendedprice").isNotNull()).join(cuts, "l_returnflag").groupBy("l_returnflag").agg(
        F.count("*").alias("n"), *[F.avg((F.col("l_extendedprice") <= F.col(c)).cast("double")).alias(c) for c in ("low_cut", "high_cut")])
    return ranks.select("l_returnflag", "n", (F.abs(F.col("low_cut") - LOW_QUANTILE) <= 0.01).alias("low_within"),
                        (F.abs(F.col("high_cut") - HIGH_QUANTILE) <= 0.01).alias("high_within"))


@register("confusion_matrix", f"""
WITH {PMT},
grid AS (SELECT a.l AS actual, p.l AS predicted FROM (VALUES {", ".join(f"('{x}')" for x in CLASS_LABELS)}) a(l),
         (VALUES {", ".join(f"('{x}')" for x in CLASS_LABELS)}) p(l)),
cnt AS (SELECT target_class AS actual, predicted, COUNT(*) AS n FROM test GROUP BY 1, 2)
SELECT grid.actual, grid.predicted, coalesce(cnt.n, 0) AS n
FROM grid LEFT JOIN cnt ON grid.actual = cnt.actual AND grid.predicted = cnt.predicted
""")
def q_confusion_matrix(spark, sf):
    return M.confusion_matrix(_test(spark, sf), "target_class", "predicted")


PRF_SQL = """
lab AS (
  SELECT label, SUM(s) AS support, SUM(q) AS predicted, SUM(tp) AS tp FROM (
    SELECT target_class AS label, 1 AS s, 0 AS q, CASE WHEN target_class = predicted THEN 1 ELSE 0 END AS tp FROM test
    UNION ALL SELECT predicted, 0, 1, 0 FROM test) WHERE label IS NOT NULL GROUP BY label
),
prf AS (
  SELECT label, support, predicted, tp,
         coalesce(tp / NULLIF(CAST(predicted AS DOUBLE), 0), 0) AS precision,
         coalesce(tp / NULLIF(CAST(support AS DOUBLE), 0), 0) AS recall,
         coalesce(2.0 * tp / NULLIF(CAST(support + predicted AS DOUBLE), 0), 0) AS f1
  FROM lab
)"""


@register("classification_report", f"""
WITH {PMT},{PRF_SQL},
fixed AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{x}')" for i, x in enumerate(CLASS_LABELS))}) v(ord, label)),
per AS (
  SELECT fixed.ord, fixed.label, coalesce(prf.precision, 0) AS precision, coalesce(prf.recall, 0) AS recall,
         coalesce(prf.f1, 0) AS f1, coalesce(prf.support, 0) AS support
  FROM fixed LEFT JOIN prf ON fixed.label = prf.label
),
allrows AS (
  SELECT ord, label, precision, recall, f1, support FROM per
  UNION ALL SELECT 3, 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM per
  UNION ALL SELECT 4, 'weighted avg', coalesce(sum(precision * support) / NULLIF(CAST(sum(support) AS DOUBLE), 0), 0),
         coalesce(sum(recall * support) / NULLIF(CAST(sum(support) AS DOUBLE), 0), 0),
         coalesce(sum(f1 * support) / NULLIF(CAST(sum(support) AS DOUBLE), 0), 0), sum(support) FROM per
)
SELECT CAST(ord AS INTEGER) AS ord, label, {_r_sql(["precision", "recall", "f1"])}, CAST(support AS BIGINT) AS support FROM allrows
""")
def q_classification_report(spark, sf):
    rep = M.classification_report(_test(spark, sf), "target_class", "predicted")
    return _r(rep, ["precision", "recall", "f1"]).select(
        F.col("ord").cast("int").alias("ord"), "label", "precision", "recall", "f1",
        F.col("support").cast("long").alias("support"))


@register("accuracy", f"""
WITH {PMT}
SELECT avg(CASE WHEN target_class = predicted THEN 1.0 ELSE 0.0 END) AS accuracy FROM test
""")
def q_accuracy(spark, sf):
    return M.accuracy(_test(spark, sf), "target_class", "predicted")


@register("macro_f1", f"WITH {PMT},{PRF_SQL}\nSELECT round(avg(f1), 6) AS macro_f1 FROM prf")
def q_macro_f1(spark, sf):
    return _r(M.macro_f1(_test(spark, sf), "target_class", "predicted"), ["macro_f1"])


@register("model_selection", f"""
WITH {PMT},
cand AS (
  SELECT 'persistence' AS model, 0 AS position, target_class, predicted FROM test
  UNION ALL SELECT 'constant_medium', 1, target_class, 'medium' FROM test
),
lab AS (
  SELECT model, position, label, SUM(s) AS support, SUM(q) AS predicted, SUM(tp) AS tp FROM (
    SELECT model, position, target_class AS label, 1 AS s, 0 AS q,
           CASE WHEN target_class = predicted THEN 1 ELSE 0 END AS tp FROM cand
    UNION ALL SELECT model, position, predicted, 0, 1, 0 FROM cand) WHERE label IS NOT NULL
  GROUP BY model, position, label
),
scores AS (
  SELECT model, position, avg(coalesce(2.0 * tp / NULLIF(CAST(support + predicted AS DOUBLE), 0), 0)) AS macro_f1
  FROM lab GROUP BY model, position
)
SELECT model, position, round(macro_f1, 6) AS macro_f1 FROM scores
ORDER BY coalesce(macro_f1, '-inf'::DOUBLE) DESC, position ASC LIMIT 1
""")
def q_model_selection(spark, sf):
    test = _test(spark, sf)
    cand = (test.select(F.lit("persistence").alias("model"), F.lit(0).alias("position"), "target_class", "predicted")
            .unionByName(test.select(F.lit("constant_medium").alias("model"), F.lit(1).alias("position"),
                                     "target_class", F.lit("medium").alias("predicted"))))
    scores = M.macro_f1(cand, "target_class", "predicted", by=["model", "position"])
    return _r(M.select_best(scores, "macro_f1"), ["macro_f1"]).select("model", "position", "macro_f1")


def _artifact_sql() -> str:
    grid = ", ".join(f"('{a}', '{b}')" for a in CLASS_LABELS for b in CLASS_LABELS)
    fixed = ", ".join(f"('{x}')" for x in CLASS_LABELS)
    names = ["precision", "recall", "f1-score"]
    ratio = "coalesce({} / NULLIF(CAST({} AS DOUBLE), 0), 0)".format
    return f"""
WITH {PMT},
cand AS (
  SELECT 'persistence' AS model, target_class AS y, predicted AS p FROM test WHERE predicted IS NOT NULL
  UNION ALL SELECT 'constant_medium', target_class, 'medium' FROM test
  UNION ALL SELECT 'unknown_label', target_class, CASE WHEN target_class = 'low' THEN 'other' ELSE target_class END FROM test
),
lab AS (
  SELECT model, label, SUM(s) AS support, SUM(q) AS predicted, SUM(tp) AS tp FROM (
    SELECT model, y AS label, 1 AS s, 0 AS q, CAST(y = p AS INTEGER) AS tp FROM cand UNION ALL SELECT model, p, 0, 1, 0 FROM cand)
  GROUP BY model, label
),
per AS (
  SELECT m.model, f.label, coalesce(support, 0) AS support, {ratio('tp', 'predicted')} AS "precision", {ratio('tp', 'support')} AS recall,
         {ratio('2.0 * tp', '(support + predicted)')} AS "f1-score"
  FROM (SELECT DISTINCT model FROM cand) m CROSS JOIN (VALUES {fixed}) f(label) LEFT JOIN lab ON lab.model = m.model AND lab.label = f.label
),
long AS (
  SELECT model, 'n_rows_test' AS metric, NULL AS label, NULL AS predicted_label, CAST(COUNT(*) AS DOUBLE) AS value FROM cand GROUP BY model
  UNION ALL SELECT model, 'accuracy', NULL, NULL, avg(CAST(y = p AS DOUBLE)) FROM cand GROUP BY model
  UNION ALL SELECT model, 'macro_f1', NULL, NULL, avg({ratio('2.0 * tp', '(support + predicted)')}) FROM lab GROUP BY model
  {" ".join(f"""UNION ALL SELECT model, '{n}', label, NULL, "{n}" FROM per
  UNION ALL SELECT model, '{n}', 'macro avg', NULL, avg("{n}") FROM per GROUP BY model
  UNION ALL SELECT model, '{n}', 'weighted avg', NULL, {ratio(f'sum("{n}" * support)', 'sum(support)')} FROM per GROUP BY model""" for n in names)}
  UNION ALL SELECT model, 'support', label, NULL, support FROM per
  UNION ALL SELECT model, 'support', x, NULL, sum(support) FROM per, (VALUES ('macro avg'), ('weighted avg')) v(x) GROUP BY model, x
  UNION ALL SELECT m.model, 'confusion_matrix', a, b, (SELECT COUNT(*) FROM cand c WHERE c.model = m.model AND c.y = a AND c.p = b)
    FROM (SELECT DISTINCT model FROM cand) m, (VALUES {grid}) g(a, b)
  UNION ALL SELECT model, 'test_class_distribution', y, NULL, COUNT(*) FROM cand GROUP BY model, y
  UNION ALL SELECT model, 'predicted_class_distribution', p, NULL, COUNT(*) FROM cand GROUP BY model, p
)
SELECT model, metric, label, predicted_label, round(CAST(value AS DOUBLE), 6) AS value FROM long"""


@register("metrics_artifact", _artifact_sql())
def q_metrics_artifact(spark, sf):
    """Every figure of the metrics artifact for three fixed forecasts, one of
    which predicts a label that no truth has."""
    test = _test(spark, sf)
    forecasts = {"persistence": F.col("predicted"), "constant_medium": F.lit("medium"),
                 "unknown_label": F.when(F.col("target_class") == "low", "other").otherwise(F.col("target_class"))}
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), p.alias("p")) for m, p in forecasts.items()]))
    cand = test.select("target_class", each.alias("f")).select("f.model", "target_class", "f.p")
    return M.evaluation(cand, "target_class", "p").withColumn("value", F.round("value", 6))


@register("class_weights", f"""
WITH {PMT},
c AS (SELECT target_class, COUNT(*) AS n_c FROM train GROUP BY 1)
SELECT target_class, n_c, SUM(n_c) OVER () / (COUNT(*) OVER () * n_c) AS weight FROM c
""")
def q_class_weights(spark, sf):
    return M.class_weights(evaluated(spark, sf).where(~F.col("is_test")), "target_class")


@register("labels_in_test", f"WITH {PMT}\nSELECT list_sort(list(DISTINCT target_class)) AS labels FROM test")
def q_labels_in_test(spark, sf):
    return M.labels_in(_test(spark, sf), "target_class")


IMPUTE_COLS = ["ppi_lag_1", "ppi_pct_change_lag_1", "ppi_ma_3", "ppi_std_3"]


@register("median_impute", f"""
WITH {PMT},
sp AS (SELECT *, row_number() OVER (ORDER BY month DESC) <= {TEST_SIZE_MONTHS} AS is_test FROM pall),
med AS (SELECT {", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in IMPUTE_COLS)} FROM sp WHERE NOT is_test)
SELECT month, {", ".join(f"round(coalesce({c}, m_{c}), 6) AS {c}" if c in ("ppi_ma_3", "ppi_std_3") else f"CASE WHEN {c} IS NULL THEN round(m_{c}, 6) ELSE {c} END AS {c}" for c in IMPUTE_COLS)}
FROM sp, med
""")
def q_median_impute(spark, sf):
    from ..operators.ml import median_impute
    full = M.chronological_split(materialize(ppi_model_table(spark, sf, dropna=False)), TEST_SIZE_MONTHS)
    imputed = median_impute(full, full.where(~F.col("is_test")), IMPUTE_COLS)
    orig = full.select("month", *[F.col(c).alias(f"o_{c}") for c in IMPUTE_COLS])
    j = imputed.join(orig, "month")
    # window mean/std values differ by engine in the last bits: always rounded
    return j.select("month", *[(F.round(F.col(c), 6) if c in ("ppi_ma_3", "ppi_std_3") else
                                F.when(F.col(f"o_{c}").isNull(), F.round(F.col(c), 6)).otherwise(F.col(c))).alias(c)
                               for c in IMPUTE_COLS])


SCALE_COLS = ["ppi_value", "ppi_pct_change", "ppi_ma_3"]


@register("standard_scale", f"""
WITH {PMT},
st AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in SCALE_COLS)} FROM train)
SELECT month, {", ".join(f"round(({c} - m_{c}) / (CASE WHEN s_{c} IS NULL OR s_{c} = 0 THEN 1.0 ELSE s_{c} END), 6) AS {c}" for c in SCALE_COLS)}
FROM evald, st
""")
def q_standard_scale(spark, sf):
    from ..operators.ml import standard_scale
    ev = evaluated(spark, sf)
    out = standard_scale(ev, ev.where(~F.col("is_test")), SCALE_COLS)
    return _r(out.select("month", *SCALE_COLS), SCALE_COLS)


# ---------------------------------------------------------------------------
# 6. Sources: calendar, assignment, caps, term filter, payloads, union
# ---------------------------------------------------------------------------

def _order_bounds(spark, sf):
    o = SI.table(spark, sf, "orders")
    return o.agg(F.min("o_orderdate").alias("start"), F.max("o_orderdate").alias("end"))


WINDOWS_SQL = """
windows AS (
  SELECT CAST(ws AS DATE) AS window_start, last_day(CAST(ws AS DATE)) AS window_end
  FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)),
                                      INTERVAL 1 MONTH)) AS ws FROM orders)
)"""


@register("month_windows", f"WITH {WINDOWS_SQL}\nSELECT window_start, window_end FROM windows")
def q_month_windows(spark, sf):
    return CAL.month_windows(_order_bounds(spark, sf))


@register("window_assign_range_join", f"""
WITH {Q.RAW_NEWS},{Q.CLEAN_NEWS},{WINDOWS_SQL}
SELECT clean.doc_id, windows.window_start, windows.window_end
FROM clean JOIN windows ON clean.published_at >= CAST(windows.window_start AS TIMESTAMP)
                       AND clean.published_at < CAST(windows.window_end + INTERVAL 1 DAY AS TIMESTAMP)
""")
def q_window_assign_range_join(spark, sf):
    windows = CAL.month_windows(_order_bounds(spark, sf))
    return CAL.assign_windows_range(clean_news(spark, sf), windows).select("doc_id", "window_start", "window_end")


@register("window_assign_equi_join", f"""
WITH {Q.RAW_NEWS},{Q.CLEAN_NEWS},{WINDOWS_SQL}
SELECT clean.doc_id, windows.window_start, windows.window_end
FROM clean JOIN windows ON CAST(date_trunc('month', clean.published_at) AS DATE) = windows.window_start
""")
def q_window_assign_equi_join(spark, sf):
    windows = CAL.month_windows(_order_bounds(spark, sf))
    return CAL.assign_month_windows(clean_news(spark, sf), windows).select("doc_id", "window_start", "window_end")


PER_WINDOW_CAP = CAL.per_window_cap(50, 3)


@register("topk_per_window", f"""
SELECT event_id, window_start FROM (
  SELECT event_id, CAST(ts AS DATE) AS window_start,
         row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts DESC, event_id ASC) AS rn
  FROM events) WHERE rn <= {PER_WINDOW_CAP}
""")
def q_topk_per_window(spark, sf):
    ev = SI.table(spark, sf, "events").select("event_id", "ts", F.to_date("ts").alias("window_start"))
    return CAL.cap_per_window(ev, PER_WINDOW_CAP, ts_col="ts", tiebreak="event_id").select("event_id", "window_start")


@register("topk_recent", """
SELECT event_id, ts FROM events
WHERE ts >= CAST(CAST((SELECT max(ts) FROM events) AS DATE) - INTERVAL 30 DAY AS TIMESTAMP)
ORDER BY ts DESC, event_id ASC LIMIT 50
""")
def q_topk_recent(spark, sf):
    ev = SI.table(spark, sf, "events")
    now = ev.select(F.max("ts")).scalar()
    recent = CAL.recent_lookback(ev, "ts", 30, now)
    return CAL.cap_recent(recent, 50, 1, ts_col="ts", tiebreak="event_id").select("event_id", "ts")


@register("recent_lookback", """
SELECT event_id, ts FROM events
WHERE ts >= CAST(CAST((SELECT max(ts) FROM events) AS DATE) - INTERVAL 7 DAY AS TIMESTAMP)
""")
def q_recent_lookback(spark, sf):
    ev = SI.table(spark, sf, "events")
    return CAL.recent_lookback(ev, "ts", 7, ev.select(F.max("ts")).scalar()).select("event_id", "ts")


TERMS_A, TERMS_B = ["that", "with"], ["ble", "thon"]


@register("boolean_text_filter", f"""
SELECT doc_id FROM (SELECT doc_id, {Q.CLEAN_TEXT.format(c='text')} AS c FROM documents)
WHERE ({" OR ".join(f"regexp_matches(c, '\\b{t}\\b')" for t in TERMS_A)})
  AND ({" OR ".join(f"regexp_matches(c, '\\b{t}\\b')" for t in TERMS_B)})
""")
def q_boolean_text_filter(spark, sf):
    d = SI.table(spark, sf, "documents").select("doc_id", clean_text("text").alias("c"))
    return d.where(boolean_text_filter("c", TERMS_A, TERMS_B)).select("doc_id")


def _gdelt_payloads(spark, sf):
    ev = SI.table(spark, sf, "events")
    art = F.struct(
        F.col("event_type").alias("title"),
        F.concat(F.lit("https://events.example/"), F.col("event_id").cast("string")).alias("url"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("domain"),
        F.lit("en").alias("language"),
        F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'").alias("seendate"),
        F.coalesce(F.get_json_object("props", "$.k"), F.lit("")).alias("socialimage"),
        F.lit(None).cast("string").alias("sourcecountry"))
    return ev.select(F.to_json(F.struct(
        F.date_format("ts", "yyyy-MM-dd").alias("window_start"),
        F.date_format("ts", "yyyy-MM-dd").alias("window_end"),
        F.array(art).alias("articles"))).alias("payload"))


@register("json_payload_flatten", """
SELECT 'gdelt' AS provider, strftime(ts, '%Y-%m-%d') AS window_start, strftime(ts, '%Y-%m-%d') AS window_end,
       event_type AS title, 'https://events.example/' || CAST(event_id AS VARCHAR) AS url,
       'user' || CAST(user_id AS VARCHAR) AS source, 'en' AS language,
       strftime(ts, '%Y%m%dT%H%M%SZ') AS seen_date,
       coalesce(json_extract_string(props, '$.k'), '') AS social_image, CAST(NULL AS VARCHAR) AS source_country
FROM events
""")
def q_json_payload_flatten(spark, sf):
    return P.flatten_gdelt(_gdelt_payloads(spark, sf))


def _newsapi_payloads(spark, sf):
    ev = SI.table(spark, sf, "events")
    art = F.struct(
        F.col("event_type").alias("title"),
        F.concat(F.lit("https://events.example/"), F.col("event_id").cast("string")).alias("url"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"),
        F.lit(None).cast("string").alias("urlToImage"),
        F.struct(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("id"),
                 F.when(F.col("value") < 10, F.lit("")).otherwise(
                     F.concat(F.lit("User "), F.col("user_id").cast("string"))).alias("name")).alias("source"))
    return ev.select(F.to_json(F.struct(
        F.date_format("ts", "yyyy-MM-dd").alias("window_start"),
        F.date_format("ts", "yyyy-MM-dd").alias("window_end"),
        F.when(F.col("event_type") == "error", F.lit("error")).otherwise(F.lit("ok")).alias("status"),
        F.array(art).alias("articles"))).alias("payload"))


@register("payload_error_screen", """
SELECT 'https://events.example/' || CAST(event_id AS VARCHAR) AS url, event_type AS title,
       CASE WHEN value < 10 THEN 'u' || CAST(user_id AS VARCHAR) ELSE 'User ' || CAST(user_id AS VARCHAR) END AS source,
       strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS seen_date, 'newsapi' AS provider
FROM events WHERE event_type <> 'error'
""")
def q_payload_error_screen(spark, sf):
    return P.flatten_newsapi(_newsapi_payloads(spark, sf)).select("url", "title", "source", "seen_date", "provider")


HOST_RE = "^[a-zA-Z]+://([^/:?#]+)"
TITLE_RE = "<title>(.*?)</title>"
LANG_RE = '<html lang="([^"]*)"'


def _page_rows(spark, sf):
    pg = SI.table(spark, sf, "pages")
    return pg.select(
        F.lit("gdelt").alias("provider"),
        F.regexp_extract("html", TITLE_RE, 1).alias("title"), F.col("url"),
        F.regexp_extract("url", HOST_RE, 1).alias("source"),
        F.regexp_extract("html", LANG_RE, 1).alias("language"))


@register("provider_union", f"""
WITH {Q.RAW_NEWS}
SELECT provider, title, url, source, language FROM raw_news
UNION ALL
SELECT 'gdelt', regexp_extract(html, '{TITLE_RE}', 1), url, regexp_extract(url, '{HOST_RE}', 1),
       regexp_extract(html, '{LANG_RE}', 1) FROM pages
""")
def q_provider_union(spark, sf):
    docs = SI.raw_news(spark, sf).select("provider", "title", "url", "source", "language")
    return P.provider_union(docs, _page_rows(spark, sf)).select("provider", "title", "url", "source", "language")


@register("falsy_coalesce", f"""
SELECT page_id, coalesce(NULLIF(regexp_extract(html, '{TITLE_RE}', 1), ''), url) AS label FROM pages
""")
def q_falsy_coalesce(spark, sf):
    pg = SI.table(spark, sf, "pages")
    return pg.select("page_id", falsy_coalesce(F.regexp_extract("html", TITLE_RE, 1), F.col("url")).alias("label"))


@register("parse_mixed_timestamps", """
SELECT event_id,
  CASE event_type WHEN 'click' THEN strftime(ts, '%Y%m%dT%H%M%SZ')
                  WHEN 'view' THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
                  WHEN 'purchase' THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
                  WHEN 'signup' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00')
                  ELSE 'bad-' || CAST(event_id AS VARCHAR) END AS seen_date,
  CASE WHEN event_type IN ('click', 'view', 'purchase') THEN date_trunc('second', ts)
       WHEN event_type = 'signup' THEN ts ELSE NULL END AS published_at
FROM events
""")
def q_parse_mixed_timestamps(spark, sf):
    ev = SI.table(spark, sf, "events")
    e = F.col("event_type")
    seen = (F.when(e == "click", F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'"))
             .when(e == "view", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
             .when(e == "purchase", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
             .when(e == "signup", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))
             .otherwise(F.concat(F.lit("bad-"), F.col("event_id").cast("string"))))
    return (ev.select("event_id", seen.alias("seen_date"))
              .withColumn("published_at", parse_timestamps("seen_date")))


# ---------------------------------------------------------------------------
# 8. Remaining scans and scalar functions
# ---------------------------------------------------------------------------

@register("series_scan", """
SELECT CAST(o_orderdate AS DATE) AS date, o_totalprice AS ppi_value FROM orders
WHERE o_orderdate IS NOT NULL AND o_totalprice IS NOT NULL AND NOT isnan(o_totalprice)
""")
def q_series_scan(spark, sf):
    o = SI.table(spark, sf, "orders")
    as_text = o.select(F.col("o_orderdate").cast("string").alias("observation_date"),
                       F.col("o_totalprice").cast("string").alias("value"))
    return clean_series(as_text, "ppi_value")


@register("table_guard", f"""
SELECT 'orders' AS "table", COUNT(*) AS rows, 6 AS columns, COUNT(*) >= {MIN_ROWS} AS ok FROM orders
UNION ALL SELECT 'lineitem', COUNT(*), 11, COUNT(*) >= {MIN_ROWS} FROM lineitem
UNION ALL SELECT 'documents', COUNT(*), 5, COUNT(*) >= {MIN_ROWS} FROM documents
""")
def q_table_guard(spark, sf):
    parts = [table_guard(SI.table(spark, sf, t), t, MIN_ROWS, 2) for t in ("orders", "lineitem", "documents")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("nan_to_null", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_discount - 0.05 < 0 THEN NULL ELSE sqrt(l_discount - 0.05) END AS v
FROM lineitem
""")
def q_nan_to_null(spark, sf):
    li = SI.table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", nan_to_null(F.sqrt(F.col("l_discount") - F.lit(0.05))).alias("v"))


@register("projection_rename", "SELECT c_custkey AS id, c_name AS name FROM customer")
def q_projection_rename(spark, sf):
    c = SI.table(spark, sf, "customer")
    return c.select(*c.columns[:2]).toDF("id", "name")


@register("dropna_subset", """
SELECT o.o_orderkey, d.lang AS language FROM orders o LEFT JOIN documents d ON o.o_orderkey = d.doc_id
WHERE d.text IS NOT NULL
""")
def q_dropna_subset(spark, sf):
    o, d = SI.table(spark, sf, "orders"), SI.table(spark, sf, "documents")
    j = o.join(d, o.o_orderkey == d.doc_id, "left").select("o_orderkey", "text", F.col("lang").alias("language"))
    return j.dropna(subset=["text"]).select("o_orderkey", "language")


SEG_RE = "^[a-zA-Z]+://[^/]+/(?:[^/?#]*/)*([^/?#]*)"
PAGE_RE = "[?&]page=([^&#]*)"


@register("coerce_numeric", f"""
SELECT page_id, TRY_CAST(trim(regexp_extract(url, '{SEG_RE}', 1)) AS DOUBLE) AS segment_num,
       TRY_CAST(trim(regexp_extract(url, '{PAGE_RE}', 1)) AS DOUBLE) AS page_num
FROM pages
""")
def q_coerce_numeric(spark, sf):
    pg = SI.table(spark, sf, "pages")
    return pg.select("page_id", coerce_double(F.regexp_extract("url", SEG_RE, 1)).alias("segment_num"),
                     coerce_double(F.regexp_extract("url", PAGE_RE, 1)).alias("page_num"))


@register("coerce_date", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day, CAST(NULL AS DATE) AS priority_day FROM orders
""")
def q_coerce_date(spark, sf):
    o = SI.table(spark, sf, "orders")
    fmts = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss")
    return o.select("o_orderkey", try_date(F.col("o_orderdate").cast("string"), fmts).alias("order_day"),
                    try_date(F.col("o_orderpriority"), fmts).alias("priority_day"))


@register("array_join", """
SELECT page_id, array_to_string(regexp_extract_all(html, 'href="([^"]*)"', 1), ',') AS links FROM pages
""")
def q_array_join(spark, sf):
    pg = SI.table(spark, sf, "pages")
    return pg.select("page_id", F.array_join(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1), ",")
                     .alias("links"))


@register("date_formats", """
SELECT o_orderkey,
       strftime(date_trunc('month', o_orderdate), '%Y%m%d') || '000000' AS gdelt_start,
       strftime(last_day(o_orderdate), '%Y%m%d') || '235959' AS gdelt_end,
       strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS guardian_from,
       strftime(o_orderdate, '%Y-%m') AS month_label
FROM orders
""")
def q_date_formats(spark, sf):
    o = SI.table(spark, sf, "orders")
    m = F.trunc("o_orderdate", "month")
    return o.select("o_orderkey", format_compact_datetime(m).alias("gdelt_start"),
                    format_compact_datetime(F.last_day("o_orderdate"), end_of_day=True).alias("gdelt_end"),
                    F.date_format(m, "yyyy-MM-dd").alias("guardian_from"),
                    F.date_format("o_orderdate", "yyyy-MM").alias("month_label"))


@register("format_metrics", f"""
WITH {PMT},
c AS (SELECT target_class, COUNT(*) AS n, min(target_pct_change_next_month) AS lo FROM pmt GROUP BY 1)
SELECT upper(substr(target_class, 1, 1)) || lower(substr(target_class, 2)) AS label, n,
       printf('%.2f%%', n / SUM(n) OVER () * 100.0) AS share, printf('%.3f', lo) AS min_change
FROM c
""")
def q_format_metrics(spark, sf):
    pmt = ppi_model_table(spark, sf)
    c = pmt.groupBy("target_class").agg(F.count(F.lit(1)).alias("n"),
                                        F.min("target_pct_change_next_month").alias("lo"))
    w = Window.partitionBy()  # one row per class
    return c.select(capitalize("target_class").alias("label"), "n",
                    format_percent(F.col("n") / F.sum("n").over(w)).alias("share"),
                    format_fixed("lo", 3).alias("min_change"))


from . import catalog_ml, catalog_tables  # noqa: E402,F401
