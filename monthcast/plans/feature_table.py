"""The analytic core: series + clean news + indicators -> model table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_KEYWORDS, HIGH_QUANTILE, LOW_QUANTILE, NOT_FEATURES
from ..operators import labels as L
from ..operators import news as N
from ..operators import series as S

PPI_FEATURES = ["ppi_lag_1", "ppi_pct_change_lag_1", "ppi_ma_3", "ppi_std_3"]


def monthly_series(series: DataFrame, date_col: str = "date", value_col: str = "ppi_value",
                   keys: Sequence[str] = ()) -> DataFrame:
    """Typed, de-duplicated (keys..., month, ppi_value) rows of the target series."""
    clean = series.where(F.col(date_col).isNotNull() & F.col(value_col).isNotNull())
    return S.distinct_series(clean.select(*keys, F.trunc(F.col(date_col), "month").alias("month"),
                                          F.col(value_col).alias("ppi_value")),
                             cols=[*keys, "month", "ppi_value"])


def build_feature_table(series: DataFrame, clean_news: DataFrame, lexicon: DataFrame,
                        indicators: DataFrame | None = None,
                        keywords: Sequence[str] = DEFAULT_KEYWORDS,
                        low_q: float = LOW_QUANTILE, high_q: float = HIGH_QUANTILE,
                        keep_unlabelled: bool = False, keys: Sequence[str] = (),
                        holdout: int = 0, fill_limit: int | None = None, **sentiment_rules) -> DataFrame:
    """One row per (series key, month) with 30-ish features, the next-month
    change and its class. Everything after the article aggregates is
    month-level; with ``keys`` (a panel of series) every window, forward fill
    and quantile cut runs per key, so the window stages partition by key.
    The news and indicator months are shared by all series. ``holdout``: the
    class cuts come from all but that many last months; ``fill_limit``: months
    that an indicator's last value is carried over; ``keep_unlabelled``: the
    newest month, whose class isn't known yet, stays."""
    keys = list(keys)
    ppi = monthly_series(series, keys=keys)
    news = N.monthly_news_features(clean_news, lexicon, keywords, **sentiment_rules)
    df = ppi.join(news, "month", "left")
    indicator_cols: list[str] = []
    if indicators is not None:
        indicator_cols = [c for c in indicators.columns if c != "month"]
        df = S.forward_fill(df.join(indicators, "month", "left"), indicator_cols, keys=keys, limit=fill_limit)
    news_cols = [c for c in df.columns if c not in {"month", "ppi_value", *indicator_cols, *keys}]
    df = df.fillna(0, subset=news_cols)
    df = S.series_features(df, "ppi_value", "ppi", keys=keys)
    df = S.indicator_features(df, indicator_cols, keys=keys)
    df = S.target_lead(df, "ppi_pct_change", keys=keys)
    df = L.add_target_class(df, low_q=low_q, high_q=high_q, keys=keys, holdout=holdout)
    required = [*PPI_FEATURES, *indicator_cols] + ([] if keep_unlabelled else ["target_class"])
    return df.dropna(subset=required)


def feature_columns(model_table: DataFrame) -> list[str]:
    """Model inputs: every column except the key and the targets."""
    skip = {*NOT_FEATURES} | {f.name for f in model_table.schema.fields if f.dataType.simpleString() == "string"}
    return [c for c in model_table.columns if c not in skip]
