"""Quantile cuts and three-way class labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import CLASS_LABELS, HIGH_QUANTILE, LOW_QUANTILE


def quantile_cuts(df: DataFrame, col: str = "target_pct_change_next_month",
                  low_q: float = LOW_QUANTILE, high_q: float = HIGH_QUANTILE,
                  keys: Sequence[str] = (), approx: bool = False) -> DataFrame:
    """Exact (linear interpolation) quantile cuts over non-null values, one
    row per key. ``approx=True`` takes them from sketches, for groups whose
    values are too many to sort."""
    if approx:
        return sketch_cuts(quantile_sketches(df, col, keys), low_q, high_q, keys)
    x = F.col(col).cast("double")
    return df.where(F.col(col).isNotNull()).groupBy(*keys).agg(
        F.percentile(x, low_q).alias("low_cut"), F.percentile(x, high_q).alias("high_cut"))


#: Size of a quantile sketch: rank error about 0.3 % with probability 0.99.
SKETCH_K = 1024


def quantile_sketches(df: DataFrame, col: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys..., n, sketch): a KLL sketch of each key's non-null, non-NaN values. A
    sketch has a fixed size whatever it has seen, and sketches of parts (days,
    months, loads) are stored and merged instead of the values."""
    x = F.nanvl(F.col(col).cast("double"), F.lit(None).cast("double"))
    return df.where(x.isNotNull()).groupBy(*keys).agg(F.count(x).alias("n"), F.kll_sketch_agg_double(x, F.lit(SKETCH_K)).alias("sketch"))


def merged_sketches(sketches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Sketches of parts as one sketch per key."""
    return sketches.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(SKETCH_K)).alias("sketch"))


def sketch_cuts(sketches: DataFrame, low_q: float = LOW_QUANTILE, high_q: float = HIGH_QUANTILE, keys: Sequence[str] = ()) -> DataFrame:
    """(keys..., low_cut, high_cut) of sketches: values that occur, NULL of none."""
    cut = lambda q: F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(q)))
    return sketches.select(*keys, cut(low_q).alias("low_cut"), cut(high_q).alias("high_cut"))


def class_of(value: Column, low_cut: Column, high_cut: Column,
             labels: Sequence[str] = CLASS_LABELS) -> Column:
    """NULL stays NULL; ``<= low`` -> low, ``<= high`` -> medium, else high."""
    return (F.when(value.isNull(), F.lit(None).cast("string"))
             .when(value <= low_cut, F.lit(labels[0]))
             .when(value <= high_cut, F.lit(labels[1]))
             .otherwise(F.lit(labels[2])))


def add_target_class(df: DataFrame, col: str = "target_pct_change_next_month",
                     out: str = "target_class", low_q: float = LOW_QUANTILE,
                     high_q: float = HIGH_QUANTILE, keys: Sequence[str] = (),
                     with_cuts: bool = False, holdout: int = 0, order: str = "month") -> DataFrame:
    """Label every row from cuts computed over all labelled rows of its key,
    or, with ``holdout``, over all but the last that many of them by ``order``
    (so that the classes of a test period don't shape the cuts).

    The cuts are window aggregates over the key's partition, so no join (and
    no cross join) is needed; the data was already partitioned by key for
    the lag/lead windows, so this adds no shuffle.
    """
    w = Window.partitionBy(*keys)
    x = F.col(col).cast("double")
    if holdout:
        # labelled rows from here on, this one included
        left = F.count(x).over(w.orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow))
        df = df.withColumn("__fit", F.when(left > holdout, x))
        x = F.col("__fit")
    low = F.percentile(x, low_q).over(w)
    high = F.percentile(x, high_q).over(w)
    out_df = df.withColumns({"low_cut": low, "high_cut": high})
    out_df = out_df.withColumn(out, class_of(F.col(col), F.col("low_cut"), F.col("high_cut")))
    return out_df.drop("__fit") if with_cuts else out_df.drop("low_cut", "high_cut", "__fit")
