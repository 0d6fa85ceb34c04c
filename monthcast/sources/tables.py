"""Table scans: document tables sorted, relational tables with a declared
schema (missing -> empty), feature-table and artifact scans."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import METRICS, PREDICTION


def scan_sorted(df: DataFrame, sort_by: str | None = None, drop: tuple[str, ...] = ("_id",)) -> DataFrame:
    """Drop storage ids; sort ascending with missing values last."""
    out = df.drop(*[c for c in drop if c in df.columns])
    if sort_by and sort_by in out.columns:
        out = out.orderBy(F.col(sort_by).asc_nulls_last())
    return out


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Read ``path`` with ``schema``; a missing table gives an empty frame.
    Any other failure is raised."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def _feature_type(c: str) -> str:
    """Declared type of a model-table column."""
    if c == "month":
        return "date"
    if c == "target_class":
        return "string"
    return "bigint" if c in ("article_count", "unique_sources") or c.startswith("kw_") else "double"


def read_feature_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Model table: ``month`` as DATE, sorted by month. CSV columns are read as
    text and cast to their declared types; nothing is inferred."""
    if fmt != "csv":
        df = spark.read.format(fmt).load(path)
        return df.withColumn("month", F.to_date(F.col("month").cast("string"))).orderBy("month")
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return df.select(*[F.col(f"`{c}`").try_cast(_feature_type(c)).alias(c) for c in df.columns]).orderBy("month")


def read_metrics_json(spark: SparkSession, path: str, schema: T.StructType = METRICS) -> DataFrame:
    """Metrics artifact as ``export_json`` writes it: one record a line."""
    return spark.read.schema(schema).json(path)


def read_prediction(spark: SparkSession, path: str) -> DataFrame:
    """Prediction artifact (CSV with header) with the declared schema."""
    return spark.read.schema(PREDICTION).option("header", True).csv(path)
