"""Calendar windows, window assignment, caps and term filters on articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import GUARDIAN_PAGE_SIZE_CAP, NEWSAPI_PAGE_SIZE_CAP


def month_windows(bounds: DataFrame, start_col: str = "start", end_col: str = "end") -> DataFrame:
    """(window_start, window_end) month windows covering every row's
    [start, end] range; ``end`` may be ``current_date()``."""
    seq = F.sequence(F.trunc(F.col(start_col), "month"), F.trunc(F.col(end_col), "month"),
                     F.expr("INTERVAL 1 MONTH"))
    return (bounds.select(F.explode(seq).alias("window_start"))
                  .select("window_start", F.last_day("window_start").alias("window_end")).distinct())


def assign_month_windows(articles: DataFrame, windows: DataFrame, ts_col: str = "published_at") -> DataFrame:
    """Article -> its month window. Monthly windows do not overlap, so the
    range condition ``start <= ts < end + 1 day`` equals an equi-join on
    ``trunc(ts, 'month')``. The window table is calendar-sized: Spark
    broadcasts it from its statistics, or splits a month that holds a third of
    all articles (skew join)."""
    a = articles.drop("window_start", "window_end").withColumn("__m", F.trunc(F.col(ts_col), "month"))
    return a.join(windows, a["__m"] == windows["window_start"], "inner").drop("__m")


def assign_windows_range(articles: DataFrame, windows: DataFrame, ts_col: str = "published_at") -> DataFrame:
    """General (possibly overlapping) windows ``start <= ts < end + 1 day``.

    Bucketed range join: each window is exploded into the month buckets it
    spans, articles join their own month bucket with an equi-join (no
    nested-loop join), and the exact range predicate filters the candidates.
    The join strategy is left to Spark, which knows the windows' size.
    """
    spans = F.sequence(F.trunc(F.col("window_start"), "month"), F.trunc(F.col("window_end"), "month"),
                       F.expr("INTERVAL 1 MONTH"))
    w = windows.select("*", F.explode(spans).alias("__b"))
    a = articles.drop("window_start", "window_end").withColumn("__b", F.trunc(F.col(ts_col), "month"))
    cond = (F.col(ts_col) >= F.col("window_start").cast("timestamp_ntz")) & (
        F.col(ts_col) < F.date_add(F.col("window_end"), 1).cast("timestamp_ntz"))
    return a.join(w, "__b", "inner").where(cond).drop("__b")


def per_window_cap(max_records: int, max_pages: int, page_cap: int = GUARDIAN_PAGE_SIZE_CAP) -> int:
    return min(max_records, page_cap) * max(1, max_pages)


def cap_per_window(df: DataFrame, n: int, window_col: str = "window_start",
                   ts_col: str = "published_at", tiebreak: str = "url") -> DataFrame:
    """Newest ``n`` rows per window. The ``row_number <= n`` filter lets
    Spark insert a partial per-partition group limit before the shuffle, so
    a hot window ships at most n rows per map task."""
    w = Window.partitionBy(window_col).orderBy(F.col(ts_col).desc(), F.col(tiebreak).asc())
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def cap_recent(df: DataFrame, max_records: int, max_pages: int = 1, ts_col: str = "published_at",
               tiebreak: str = "url", page_cap: int = NEWSAPI_PAGE_SIZE_CAP) -> DataFrame:
    """Global newest-first cap over a paged source (distributed top-k)."""
    n = min(max_records, page_cap) * max(1, max_pages)
    return df.orderBy(F.col(ts_col).desc(), F.col(tiebreak).asc()).limit(n)


def recent_lookback(df: DataFrame, ts_col: str, lookback_days: int, now: Column) -> DataFrame:
    """Rows since ``midnight(now) - max(1, lookback_days)`` days."""
    days = max(1, int(lookback_days))
    start = F.date_sub(F.to_date(now), days).cast("timestamp_ntz")
    return df.where(F.col(ts_col) >= start)
