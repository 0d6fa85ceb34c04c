"""End-to-end batch run: every stage is a Spark job whose output is written
as a table under ``out_root`` (a shared folder), and the next stage reads
that table back. Writing cuts the lineage, so a lost executor only costs the
current stage, and each stage can be re-run on its own.

Stages: series -> indicators -> raw news upsert (month-partitioned, only
touched months rewritten) -> clean news (partitioned by month) -> model table -> candidate fits + metrics -> latest prediction ->
report extracts, with a row-count summary at the end.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_KEYWORDS, MODEL_CANDIDATES, RAW_NEWS_KEYS, TEST_SIZE_MONTHS
from ..operators import metrics as M
from ..operators import ml as ML
from ..operators import news as N
from ..operators import report as R
from ..functions.dates import parse_timestamps
from ..sinks.tables import PartitionedUpsertTable, export_csv, export_json, replace
from ..sources.series import assert_guard, table_guard
from .feature_table import build_feature_table, feature_columns


@dataclass
class RunInputs:
    series: DataFrame                      # (date, ppi_value)
    indicators: DataFrame | None           # (month, <indicator>...)
    raw_news_batch: DataFrame              # raw_news layout (+ optional id / sequence columns)
    lexicon: DataFrame
    keywords: Sequence[str] = tuple(DEFAULT_KEYWORDS)
    sentiment_rules: dict = field(default_factory=dict)
    news_seq: Sequence[str] = ("seen_date",)
    id_col: str | None = None


def _write_read(spark: SparkSession, df: DataFrame, path: str, partition_by: Sequence[str] = (), counted: Observation | None = None) -> DataFrame:
    """The stage's table, written and read back; ``counted`` gets its rows from
    the write itself."""
    if counted is not None:
        df = df.observe(counted, F.count(F.lit(1)).alias("rows"))
    replace(df, path, partition_by=partition_by)
    return spark.read.parquet(path)


def run_all(spark: SparkSession, inputs: RunInputs, out_root: str, batch_id: str,
            candidates: Sequence[str] = MODEL_CANDIDATES, test_size: int = TEST_SIZE_MONTHS) -> dict:
    out = out_root.rstrip("/")
    rows = {stage: Observation(stage) for stage in ("fred_series", "raw_news", "clean_news", "model_table")}
    series = _write_read(spark, inputs.series, f"{out}/fred_series", counted=rows["fred_series"])
    assert_guard(table_guard(series, "fred_series", min_rows=1, min_columns=2))
    indicators = None
    if inputs.indicators is not None:
        indicators = _write_read(spark, inputs.indicators, f"{out}/fred_indicators")

    # raw news: month-partitioned, each batch rewrites only the months it touches
    raw_table = PartitionedUpsertTable(spark, f"{out}/raw_news", RAW_NEWS_KEYS, "load_month")
    load_month = F.coalesce(F.date_format(parse_timestamps("seen_date"), "yyyy-MM"), F.lit("unknown"))
    upsert = raw_table.upsert(inputs.raw_news_batch, batch_id, load_month, seq_col=list(inputs.news_seq))
    # counted as it is read for the next stage
    raw = raw_table.read().drop("load_month").observe(rows["raw_news"], F.count(F.lit(1)).alias("rows"))

    clean = _write_read(spark, N.clean_news(raw), f"{out}/clean_news", partition_by=["month"], counted=rows["clean_news"])
    rules = dict(inputs.sentiment_rules)
    if inputs.id_col:
        rules["id_col"] = inputs.id_col
    model_table = _write_read(spark, build_feature_table(series, clean, inputs.lexicon, indicators,
                                                         keywords=list(inputs.keywords), **rules),
                              f"{out}/model_table", counted=rows["model_table"])
    export_csv(model_table.orderBy("month"), f"{out}/exports/model_table_csv")
    n_rows = rows["model_table"].get["rows"]
    if n_rows <= test_size + 6:
        raise ValueError(f"{n_rows} model rows are not enough to hold out {test_size} months")

    feats = feature_columns(model_table)
    results, models, scored = ML.train_candidates(model_table, feats, test_size, candidates=list(candidates))
    best = M.select_best(results, "macro_f1").first()["model"]
    # long form, every candidate; what belongs to the whole run has no model's figures in it
    figures = M.evaluation(scored, "target_class", "predicted")
    train = M.class_distribution(model_table.join(scored.select("month").distinct(), "month", "left_anti"), "target_class")
    run = [("best_model", None, best), ("selection_metric", None, "macro_f1"), ("n_rows_total", None, str(n_rows)),
           ("feature_count", None, str(len(feats)))]
    export_json(figures.withColumn("is_best", F.col("model") == best), f"{out}/metrics/train_metrics")
    export_json(spark.createDataFrame(run, "metric string, label string, value string")
                .unionByName(train.select(F.lit("train_class_distribution").alias("metric"), F.col("target_class").alias("label"),
                                          F.col("count").cast("string").alias("value")))
                .unionByName(scored.select("month").distinct().select(F.lit("test_month").alias("metric"), F.lit(None).cast("string").alias("label"),
                                                                      F.col("month").cast("string").alias("value"))),
                f"{out}/metrics/run")
    export_json(figures.where((F.col("metric") == "confusion_matrix") & (F.col("model") == best))
                .select("model", F.col("label").alias("actual"), F.col("predicted_label").alias("predicted"), F.col("value").cast("long").alias("n")),
                f"{out}/metrics/confusion_matrix")
    models[best].write().overwrite().save(f"{out}/models/{best}")

    latest = R.latest_row(model_table)
    prediction = ML.score(ML.load_model(f"{out}/models/{best}"), latest).select(
        "month", F.col("predicted").alias("predicted_next_month_pressure"), "proba_low", "proba_medium", "proba_high")
    export_csv(prediction, f"{out}/predictions/latest_prediction")

    export_json(R.recent_articles(clean), f"{out}/docs/news_articles")
    export_json(R.news_signal_trend(model_table), f"{out}/docs/news_signal_trend")
    export_json(R.external_indicator_trend(model_table), f"{out}/docs/external_indicators")
    counts = {stage: seen.get["rows"] for stage, seen in rows.items()}
    return {"best_model": best, "upsert": upsert, "rows": counts,
            "prediction": prediction.first().asDict()}
