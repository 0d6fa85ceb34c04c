"""Series scans: CSV by position or by name, typed and cleaned; table guards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import try_date
from ..functions.numeric import coerce_double

DATE_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd", "MM/dd/yyyy", "yyyy-MM")


def clean_series(df: DataFrame, value_name: str, date_formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """First two columns by position -> (date, value_name), coerced; rows
    with an unparseable date or value are dropped."""
    if len(df.columns) < 2:
        raise ValueError(f"series source needs at least two columns, got {df.columns}")
    first, second = df.columns[0], df.columns[1]
    out = df.select(try_date(F.col(first), date_formats).alias("date"),
                    coerce_double(F.col(second)).alias(value_name))
    return out.dropna(subset=["date", value_name])


def read_series_csv(spark: SparkSession, path: str, value_name: str) -> DataFrame:
    """CSV with a header; every column read as string (no inference)."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return clean_series(raw, value_name)


def read_named_series(spark: SparkSession, path: str, date_col: str, value_col: str, value_name: str,
                      fmt: str = "csv") -> DataFrame:
    """Second layout: named columns (e.g. ``Date``/``GSCPI``), CSV or Parquet."""
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    raw = reader.format(fmt).load(path)
    return clean_series(raw.select(date_col, value_col), value_name)


def table_guard(df: DataFrame, table: str, min_rows: int = 1, min_columns: int = 1) -> DataFrame:
    """One row (table, rows, columns, ok): ``ok`` when the table has enough
    columns and more than ``min_rows - 1`` rows. Lazy; ``assert_guard``
    turns it into an error."""
    n_cols = len(df.columns)
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(table).alias("table"), "rows", F.lit(n_cols).alias("columns"),
        ((F.col("rows") >= F.lit(min_rows)) & F.lit(n_cols >= min_columns)).alias("ok"))


def assert_guard(guard: DataFrame) -> None:
    row = guard.first()
    if row is None or not row["ok"]:
        raise ValueError(f"table guard failed: {row.asDict() if row else 'no row'}")
