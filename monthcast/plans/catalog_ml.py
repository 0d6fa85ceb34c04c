"""ML fits and streaming entries. No SQL oracle (iterative fits, stateful
streams): the driver checks rows only; pytest covers the semantics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators import ml as ML
from ..session import scratch_path
from ..sinks.tables import PartitionedUpsertTable
from .. import schemas
from ..sources import payloads as P
from ..streaming.news_stream import (file_stream, land, stream_first_seen, stream_payload_upsert, stream_period_counts,
                                     stream_upsert)
from . import oracle_sql as Q
from . import standins as SI
from .catalog import register
from .catalog_sources import PMT, TEST_SIZE_MONTHS, evaluated, ppi_model_table
from .sizing import materialize

FEATURES = ["ppi_value", "ppi_pct_change", "ppi_lag_1", "ppi_pct_change_lag_1", "ppi_ma_3", "ppi_std_3"]
SCORE_COLS = ["month", "target_class", "predicted", "proba_low", "proba_medium", "proba_high"]


@register("logistic_regression_scores")
def q_logistic_regression_scores(spark, sf):
    _, _, scored = ML.train_candidates(materialize(ppi_model_table(spark, sf)), FEATURES, TEST_SIZE_MONTHS,
                                       candidates=["logistic_regression"])
    return scored.select(*SCORE_COLS)


@register("gradient_boosting_scores")
def q_gradient_boosting_scores(spark, sf):
    _, _, scored = ML.train_candidates(materialize(ppi_model_table(spark, sf)), FEATURES, TEST_SIZE_MONTHS,
                                       candidates=["gradient_boosting"])
    return scored.select(*SCORE_COLS)


@register("latest_prediction")
def q_latest_prediction(spark, sf):
    """Fit both candidates, keep the best by macro F1 (earliest wins ties),
    refit-free scoring of the latest labelled month."""
    table = materialize(ppi_model_table(spark, sf))
    results, models, _ = ML.train_candidates(table, FEATURES, TEST_SIZE_MONTHS)
    best = M.select_best(results, "macro_f1").first()["model"]
    path = scratch_path(spark, "latest-model")
    ML.save_model(models[best], path)
    latest = table.orderBy(F.col("month").desc()).limit(1)
    scored = ML.score(ML.load_model(path), latest)
    return scored.select("month", F.col("predicted").alias("predicted_next_month_pressure"),
                         "proba_low", "proba_medium", "proba_high")


# Fixed stand-in coefficients on scaled features, a row for each class.
FIXED_CLASSES = ["high", "low", "medium"]
FIXED_COEFFICIENTS = [[0.5, -0.25, 0.125, 0.75, -0.5, 0.25], [-0.5, 0.5, 0.25, -0.75, 0.375, -0.125], [0.0, -0.25, -0.375, 0.0, 0.125, -0.125]]
FIXED_INTERCEPTS = [0.1, -0.2, 0.05]


def _fixed_sql() -> str:
    stats = ", ".join(f"quantile_cont({c}, 0.5) AS md_{c}" for c in FEATURES)
    filled = ", ".join(f"coalesce(CAST({c} AS DOUBLE), md_{c}) AS {c}" for c in FEATURES)
    moments = ", ".join(f"avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}" for c in FEATURES)
    scaled = [f"(({c} - mu_{c}) / (CASE WHEN sd_{c} = 0 THEN 1 ELSE sd_{c} END))" for c in FEATURES]
    z = ", ".join(f"{b} + {' + '.join(f'{w} * {x}' for w, x in zip(row, scaled, strict=True))} AS z_{c}"
                  for c, row, b in zip(FIXED_CLASSES, FIXED_COEFFICIENTS, FIXED_INTERCEPTS, strict=True))
    top = "greatest(" + ", ".join(f"z_{c}" for c in FIXED_CLASSES) + ")"
    total = " + ".join(f"exp(z_{c})" for c in FIXED_CLASSES)
    return f"""
WITH {PMT},
med AS (SELECT {stats} FROM train),
tfill AS (SELECT {filled} FROM train, med),
mom AS (SELECT {moments} FROM tfill),
rows AS (SELECT month, target_class, {filled} FROM pall, med),
z AS (SELECT month, target_class, {z} FROM rows, mom)
SELECT month, target_class, CASE {" ".join(f"WHEN z_{c} = {top} THEN '{c}'" for c in FIXED_CLASSES)} END AS predicted,
       {", ".join(f"round(exp(z_{c}) / ({total}), 6) AS proba_{c}" for c in FIXED_CLASSES)}
FROM z"""


@register("saved_model_scores", _fixed_sql())
def q_saved_model_scores(spark, sf):
    """A model with fixed coefficients, saved, loaded and applied to every
    month: those with missing features, and the newest, whose class isn't known."""
    train = evaluated(spark, sf).where(~F.col("is_test"))
    path = scratch_path(spark, "fixed-model")
    ML.save_model(ML.logistic_from_coefficients(train, FEATURES, FIXED_CLASSES, FIXED_COEFFICIENTS, FIXED_INTERCEPTS), path)
    scored = ML.score(ML.load_model(path), ppi_model_table(spark, sf, dropna=False))
    return scored.select("month", "target_class", "predicted", *[F.round(f"proba_{c}", 6).alias(f"proba_{c}") for c in FIXED_CLASSES])


@register("logistic_optimality", f"""
WITH {PMT}
SELECT DISTINCT target_class AS class, feature, CAST(0.0 AS DOUBLE) AS gradient
FROM train, (VALUES {", ".join(f"('{f}')" for f in [*FEATURES, "(intercept)"])}) v(feature)
""")
def q_logistic_optimality(spark, sf):
    """The gradient of the fitted logistic regression's objective over the
    training months: zero in every coefficient."""
    train = materialize(evaluated(spark, sf).where(~F.col("is_test")).drop("predicted"))
    out = ML.logistic_gradient(ML.fit_logistic(train, FEATURES, scale=True), train)
    return out.withColumn("gradient", F.abs(F.round("gradient", 2)))


@register("stream_news_upsert", f"""
WITH {Q.RAW_NEWS}
SELECT url, doc_id, seen_date FROM raw_news WHERE url IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY url ORDER BY seen_date DESC NULLS LAST, doc_id DESC NULLS LAST) = 1
""")
def q_stream_news_upsert(spark, sf):
    """Raw news landed as time-ordered files, loaded in four micro-batches
    with a keyed upsert into a month-partitioned table (each batch rewrites
    only the months it touches)."""
    from ..functions.dates import parse_timestamps
    raw = SI.raw_news(spark, sf)
    landing = scratch_path(spark, "news-landing")
    files = land(raw, landing, ["seen_date", "doc_id"], ordered=True)
    root = scratch_path(spark, "raw-news-table")
    month = F.coalesce(F.date_format(parse_timestamps("seen_date"), "yyyy-MM"), F.lit("unknown"))
    stream_upsert(file_stream(spark, landing, raw.schema, files_per_trigger=files), root, ["url"], ["seen_date", "doc_id"],
                  checkpoint=scratch_path(spark, "news-ckpt"), query_name="raw_news_upsert",
                  partition_col="load_month", part_value=month)
    return PartitionedUpsertTable(spark, root, ["url"], "load_month").read().select("url", "doc_id", "seen_date")


@register("stream_window_counts", """
SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
       event_type, COUNT(*) AS n, round(SUM(value), 6) AS total
FROM events GROUP BY ALL
""")
def q_stream_window_counts(spark, sf):
    """Daily event counts per type from a file stream; each micro-batch adds
    to the months it touches, in whatever order the files come."""
    ev = SI.table(spark, sf, "events")
    landing = scratch_path(spark, "events-landing")
    files = land(ev, landing, ["event_id"])
    root = scratch_path(spark, "event-counts")
    table = stream_period_counts(file_stream(spark, landing, ev.schema, files_per_trigger=files), "ts", ["event_type"], "value", root,
                                 checkpoint=scratch_path(spark, "events-ckpt"), query_name="event_counts")
    start = F.col("window_start").cast("timestamp_ntz")
    return table.read().select(start.alias("window_start"), (start + F.expr("INTERVAL 1 DAY")).alias("window_end"),
                               "event_type", "n", F.round("total", 6).alias("total"))


@register("stream_payload_upsert", """
SELECT 'https://events.example/' || CAST(event_id AS VARCHAR) AS url, event_type AS title,
       'user' || CAST(user_id AS VARCHAR) AS source, strftime(ts, '%Y%m%dT%H%M%SZ') AS seen_date,
       coalesce(json_extract_string(props, '$.k'), '') AS social_image
FROM events
""")
def q_stream_payload_upsert(spark, sf):
    """GDELT-layout JSON payloads (built from ``events``) landed as text
    files, streamed with the declared schema, flattened and upserted by url."""
    from .catalog_sources import _gdelt_payloads
    landing = scratch_path(spark, "payload-landing")
    files = land(_gdelt_payloads(spark, sf), landing, ["payload"], fmt="text")
    root = scratch_path(spark, "payload-table")
    stream_payload_upsert(spark, landing, schemas.GDELT_PAYLOAD, P.flatten_gdelt, root,
                          checkpoint=scratch_path(spark, "payload-ckpt"), seq_cols=["seen_date", "title"],
                          part_value=F.substring("seen_date", 1, 6), query_name="gdelt_payload_upsert",
                          files_per_trigger=files)
    return PartitionedUpsertTable(spark, root, ["url"], "load_month").read().select("url", "title", "source", "seen_date", "social_image")


@register("stream_monthly_counts", f"""
WITH {Q.RAW_NEWS}
SELECT CAST(date_trunc('month', try_strptime(seen_date, '%Y-%m-%dT%H:%M:%SZ')) AS DATE) AS window_start,
       CAST(date_trunc('month', try_strptime(seen_date, '%Y-%m-%dT%H:%M:%SZ')) + INTERVAL 1 MONTH AS DATE) AS window_end,
       language, COUNT(*) AS n, CAST(SUM(length(title)) AS BIGINT) AS total
FROM raw_news GROUP BY ALL
""")
def q_stream_monthly_counts(spark, sf):
    """Landed raw articles, streamed in four micro-batches; article count
    and total title length per calendar month and language, each batch
    merging only the months it touched."""
    from ..functions.dates import parse_timestamps
    raw = SI.raw_news(spark, sf)
    landing = scratch_path(spark, "monthly-landing")
    files = land(raw, landing, ["doc_id"])
    stream = file_stream(spark, landing, raw.schema, files_per_trigger=files).select(
        parse_timestamps("seen_date").alias("published_at"), "language",
        F.length("title").cast("long").alias("title_len"))
    table = stream_period_counts(stream, "published_at", ["language"], "title_len",
                                 scratch_path(spark, "monthly-counts"), checkpoint=scratch_path(spark, "monthly-ckpt"),
                                 period="month", query_name="monthly_counts")
    start = F.col("window_start").cast("date")
    return table.read().select(start.alias("window_start"), F.add_months(start, 1).alias("window_end"), "language", "n", "total")


@register("stream_distinct_sources", f"""
WITH {Q.RAW_NEWS}
SELECT CAST(date_trunc('month', try_strptime(seen_date, '%Y-%m-%dT%H:%M:%SZ')) AS DATE) AS month,
       COUNT(*) AS n, COUNT(DISTINCT source) AS sources
FROM raw_news GROUP BY 1
""")
def q_stream_distinct_sources(spark, sf):
    """Distinct sources per month from sketches that each micro-batch adds
    to (exact for few values, within 2 % for many)."""
    from ..functions.dates import parse_timestamps
    raw = SI.raw_news(spark, sf)
    landing = scratch_path(spark, "sources-landing")
    files = land(raw.select("seen_date", "source"), landing, ["seen_date", "source"], batches=3)
    stream = file_stream(spark, landing, raw.select("seen_date", "source").schema, files_per_trigger=files).select(
        parse_timestamps("seen_date").alias("published_at"), "source", F.lit(1).cast("long").alias("one"))
    table = stream_period_counts(stream, "published_at", [], "one", scratch_path(spark, "source-sketches"),
                                 checkpoint=scratch_path(spark, "sources-ckpt"), period="month", distinct_col="source",
                                 query_name="distinct_sources")
    return table.read().select(F.col("window_start").cast("date").alias("month"), "n", F.hll_sketch_estimate("sketch").alias("sources"))


@register("stream_first_seen", f"""
WITH {Q.RAW_NEWS}
SELECT DISTINCT title, url, try_strptime(seen_date, '%Y-%m-%dT%H:%M:%SZ') AS published_at FROM raw_news
""")
def q_stream_first_seen(spark, sf):
    """Raw news landed in time order, every article in two copies, appended
    once each: the batch de-duplication as a stream over watermark state."""
    from ..functions.dates import parse_timestamps
    raw = SI.raw_news(spark, sf).fillna("", subset=["title", "source", "language"])
    landing = scratch_path(spark, "first-seen-landing")
    files = land(raw.unionByName(raw), landing, ["seen_date", "doc_id"], ordered=True)
    stream = file_stream(spark, landing, raw.schema, files_per_trigger=files).withColumn("published_at", parse_timestamps("seen_date"))
    out = scratch_path(spark, "first-seen")
    # files are listed in no order of their rows' times: the delay spans the landed years
    late = stream_first_seen(stream, ["title", "url", "published_at"], "published_at", "3650 days", out, scratch_path(spark, "first-seen-ckpt"))
    if late:
        raise RuntimeError(f"{late} rows came later than the watermark")
    return spark.read.parquet(out).select("title", "url", F.col("published_at").cast("timestamp_ntz").alias("published_at"))
