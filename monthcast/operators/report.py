"""Dashboard / API extracts: recent articles, trends, latest row, stage
counts. Each is a top-k (TakeOrderedAndProject) or a tiny aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import (API_ARTICLES_DEFAULT_LIMIT, API_ARTICLES_MAX_LIMIT, API_COLUMNS, ARTICLE_COLUMNS,
                      RECENT_ARTICLES_LIMIT, TREND_MONTHS)
from ..functions.dates import parse_timestamps
from ..functions.formatting import format_fixed


def recent_articles(clean: DataFrame, n: int = RECENT_ARTICLES_LIMIT,
                    columns: Sequence[str] = ARTICLE_COLUMNS, tiebreak: Sequence[str] = ("url", "title")) -> DataFrame:
    """Newest ``n`` articles, newest first, dates as ``yyyy-MM-dd``, NULL
    text as ''. Missing timestamps sort first (a reversed ascending tail)."""
    cols = [c for c in columns if c in clean.columns]
    order = [F.col("published_at").desc_nulls_first()] + [F.col(c).desc_nulls_first() for c in tiebreak]
    top = clean.orderBy(*order).limit(n)
    out = top.select(*[F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit("")).alias(c)
                       if c in ("published_at", "seen_date", "month") else F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                       for c in cols])
    return out


def recent_raw_articles(raw: DataFrame, n: int = 50, tiebreak: Sequence[str] = ("url",)) -> DataFrame:
    """Raw table by the ``seen_date`` string, newest first, NULL dates first."""
    cols = [c for c in API_COLUMNS if c in raw.columns]
    order = [F.col("seen_date").desc_nulls_first()] + [F.col(c).desc_nulls_first() for c in tiebreak]
    return raw.orderBy(*order).limit(n).select(*cols)


def api_articles(clean: DataFrame | None, raw: DataFrame | None, limit: int = API_ARTICLES_DEFAULT_LIMIT,
                 cleaned: bool = True, tiebreak: Sequence[str] = ("url", "title")) -> DataFrame:
    """The article listing endpoint: ``limit`` in 1..500, cleaned or raw
    table, newest first (missing dates first), the preferred columns that
    exist, every date column rendered ``yyyy-MM-dd`` ('' when missing or
    unparseable) and other NULLs as ''."""
    if not 1 <= int(limit) <= API_ARTICLES_MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {API_ARTICLES_MAX_LIMIT}")
    df = clean if cleaned else raw
    sort_col = "published_at" if cleaned else "seen_date"
    cols = [c for c in API_COLUMNS if c in df.columns]
    order = [F.col(sort_col).desc_nulls_first()] + [F.col(c).desc_nulls_first() for c in tiebreak if c in df.columns]
    top = df.orderBy(*order).limit(int(limit))

    def render(c: str):
        if c in ("published_at", "seen_date", "month"):
            as_ts = parse_timestamps(F.col(c).cast("string")) if c == "seen_date" else F.col(c)
            return F.coalesce(F.date_format(as_ts, "yyyy-MM-dd"), F.lit("")).alias(c)
        return F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return top.select(*[render(c) for c in cols])


def last_months(df: DataFrame, n: int = TREND_MONTHS, order_col: str = "month") -> DataFrame:
    """Last ``n`` rows by month (distributed top-k)."""
    return df.orderBy(F.col(order_col).desc()).limit(n)


def news_signal_trend(model_table: DataFrame, n: int = TREND_MONTHS) -> DataFrame:
    """Month (yyyy-MM), article count, sentiment, and bar widths:
    volume = min(100, count / max(max count, 1) * 100),
    sentiment = min(100, |s| * 100), class by sign. The max runs over the
    n-row extract only."""
    tail = last_months(model_table.select("month", "article_count", "avg_sentiment"), n)
    w = Window.partitionBy()  # the <= n-row extract
    cnt = F.coalesce(F.col("article_count").cast("int"), F.lit(0))
    s = F.coalesce(F.col("avg_sentiment").cast("double"), F.lit(0.0))
    out = tail.select(F.col("month").alias("_m"), F.date_format("month", "yyyy-MM").alias("month"),
                      cnt.alias("article_count"), s.alias("avg_sentiment"))
    max_count = F.greatest(F.max("article_count").over(w), F.lit(1))
    return out.select(
        "month", "article_count", "avg_sentiment",
        F.least(F.lit(100.0), F.col("article_count") / max_count * F.lit(100.0)).alias("volume_width"),
        F.least(F.lit(100.0), F.abs(F.col("avg_sentiment")) * F.lit(100.0)).alias("sentiment_width"),
        F.when(F.col("avg_sentiment") >= 0, F.lit("sentiment-positive"))
         .otherwise(F.lit("sentiment-negative")).alias("sentiment_class"))


def external_indicator_trend(model_table: DataFrame, cols: Sequence[str] = ("gscpi", "wti_oil_price"),
                             n: int = TREND_MONTHS) -> DataFrame:
    """Last n months of the indicator levels; numbers stay numeric (NULL
    when missing) plus a 2-decimal display text (``N/A`` when missing)."""
    present = [c for c in cols if c in model_table.columns]
    tail = last_months(model_table.select("month", *present), n)
    return tail.select(F.date_format("month", "yyyy-MM").alias("month"),
                       *[F.col(c).cast("double").alias(c) for c in present],
                       *[format_fixed(c, 2).alias(f"{c}_text") for c in present])


def latest_row(df: DataFrame, order_col: str = "month") -> DataFrame:
    return df.orderBy(F.col(order_col).desc()).limit(1)


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """(stage, rows) for each named stage output."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("stage"), "rows")
             for name, df in stages.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
