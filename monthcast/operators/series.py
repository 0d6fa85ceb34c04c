"""Monthly series operators: monthly means, multi-source joins, forward fill,
change / lag / rolling features and the next-period target.

Every window takes ``keys``: a panel of many series partitions by key and
scales out. With ``keys=()`` the series is one calendar of months (one row
per month, so at most 12 rows per year however large the raw input was) and
the window runs in a single partition by design; always aggregate to months
*before* calling these.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import nan_to_null, safe_pct_change


def _window(keys: Sequence[str], order: str):
    return Window.partitionBy(*keys).orderBy(F.col(order).asc())


def monthly_mean(df: DataFrame, ts_col: str, value_col: str, out_col: str,
                 keys: Sequence[str] = (), exact_scale: int | None = None) -> DataFrame:
    """Mean of a higher-frequency series per calendar month.

    NULL timestamps and values are skipped (NaN counts as missing). With
    ``exact_scale`` the sum is taken in DECIMAL(38, scale) so the result does
    not depend on summation order (money-like inputs).
    """
    month = F.trunc(F.col(ts_col), "month").alias("month")
    value = nan_to_null(F.col(value_col))
    if exact_scale is None:
        agg = F.avg(value)
    else:
        agg = F.sum(value.cast(f"decimal(18,{exact_scale})")).cast("double") / F.count(value)
    return (df.where(F.col(ts_col).isNotNull())
              .groupBy(*keys, month)
              .agg(agg.alias(out_col)))


def outer_join_all(frames: Sequence[DataFrame], on: Sequence[str] = ("month",)) -> DataFrame:
    """N-way full outer equi-join on ``on`` with the key coalesced.

    Each input is one row per key (monthly aggregates), so the joins are
    between small tables; AQE turns them into broadcast joins at run time.
    """
    on = list(on)
    return reduce(lambda a, b: a.join(b, on=on, how="full"), frames)


def forward_fill(df: DataFrame, cols: Sequence[str], order: str = "month",
                 keys: Sequence[str] = (), limit: int | None = None) -> DataFrame:
    """Carry the last non-null value forward, over at most ``limit`` rows
    without one (default: any number)."""
    if limit is not None and limit < 0:
        raise ValueError("limit must not be negative")
    w = _window(keys, order).rowsBetween(Window.unboundedPreceding if limit is None else -limit, Window.currentRow)
    return df.withColumns({c: F.last(F.col(c), ignorenulls=True).over(w) for c in cols})


def left_join_ffill(base: DataFrame, indicators: DataFrame, on: str = "month",
                    keys: Sequence[str] = ()) -> DataFrame:
    """Left join indicators onto the base series, then forward-fill them."""
    cols = [c for c in indicators.columns if c not in {on, *keys}]
    joined = base.join(indicators, on=[*keys, on], how="left")
    return forward_fill(joined, cols, order=on, keys=keys)


def pct_change(value: str, keys: Sequence[str] = (), order: str = "month") -> Column:
    """Percent change against the previous row, nulls padded forward first.

    A zero previous value gives NULL (not infinity).
    """
    filled = F.last(F.col(value), ignorenulls=True).over(
        _window(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # lag of the padded value == last non-null strictly before this row
    prev_filled = F.last(F.col(value), ignorenulls=True).over(
        _window(keys, order).rowsBetween(Window.unboundedPreceding, -1))
    return safe_pct_change(filled, prev_filled)


def series_features(df: DataFrame, value: str = "ppi_value", prefix: str = "ppi",
                    keys: Sequence[str] = (), order: str = "month") -> DataFrame:
    """Change, lag, lagged change, 3-row rolling mean / sample std of the
    previous rows (NULL until three values exist)."""
    w = _window(keys, order)
    frame = w.rowsBetween(-3, -1)
    pct = f"{prefix}_pct_change"
    out = df.withColumn(pct, pct_change(value, keys, order))
    n_prev = F.count(F.col(value)).over(frame)
    return out.withColumns({
        f"{prefix}_lag_1": F.lag(F.col(value), 1).over(w),
        f"{prefix}_pct_change_lag_1": F.lag(F.col(pct), 1).over(w),
        f"{prefix}_ma_3": F.when(n_prev == 3, F.avg(F.col(value)).over(frame)),
        f"{prefix}_std_3": F.when(n_prev == 3, F.stddev_samp(F.col(value)).over(frame)),
    })


def month_number(month: str | Column) -> Column:
    """Months since year 0: neighbouring calendar months differ by one."""
    return F.year(month) * 12 + F.month(month)


def dense_months(df: DataFrame, keys: Sequence[str] = (), order: str = "month") -> DataFrame:
    """All rows of ``df`` and one more, with nulls, for every calendar month
    without a row between a key's first and last. Rows without a month stay."""
    ends = df.where(F.col(order).isNotNull()).groupBy(*keys).agg(F.min(order).alias("__from"), F.max(order).alias("__to"))
    months = ends.select(*keys, F.explode(F.sequence(F.trunc("__from", "month"), F.trunc("__to", "month"), F.expr("INTERVAL 1 MONTH"))).alias("__month"))
    same = month_number(order) == month_number("__month")
    for k in keys:
        same = same & df[k].eqNullSafe(months[k])
    gaps = months.join(df, same, "left_anti").select(*keys, F.col("__month").cast(df.schema[order].dataType).alias(order))
    return df.unionByName(gaps, allowMissingColumns=True)


def calendar_series_features(df: DataFrame, value: str = "ppi_value", prefix: str = "ppi",
                             keys: Sequence[str] = (), order: str = "month") -> DataFrame:
    """``series_features`` by calendar: a lag is the month before, not the row
    before, and the rolling figures are of the three months before; NULL where
    one of those has no value. Of several rows of one month the largest value
    counts. Range frames over the month's number, so gaps need no filling."""
    w = Window.partitionBy(*keys).orderBy("__m")
    before, three = w.rangeBetween(-1, -1), w.rangeBetween(-3, -1)
    pct = f"{prefix}_pct_change"
    out = df.withColumn("__m", month_number(order))
    out = out.withColumn(f"{prefix}_lag_1", F.max(F.col(value)).over(before))
    out = out.withColumn(pct, safe_pct_change(F.col(value), F.col(f"{prefix}_lag_1")))
    n_prev = F.size(F.collect_set(F.when(F.col(value).isNotNull(), F.col("__m"))).over(three))
    return out.withColumns({
        f"{prefix}_pct_change_lag_1": F.max(F.col(pct)).over(before),
        f"{prefix}_ma_3": F.when(n_prev == 3, F.avg(F.col(value)).over(three)),
        f"{prefix}_std_3": F.when(n_prev == 3, F.stddev_samp(F.col(value)).over(three)),
    }).drop("__m")


def indicator_features(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (),
                       order: str = "month") -> DataFrame:
    """``<c>_pct_change``, ``<c>_lag_1``, ``<c>_pct_change_lag_1`` per indicator."""
    w = _window(keys, order)
    out = df.withColumns({f"{c}_pct_change": pct_change(c, keys, order) for c in cols})
    return out.withColumns({
        **{f"{c}_lag_1": F.lag(F.col(c), 1).over(w) for c in cols},
        **{f"{c}_pct_change_lag_1": F.lag(F.col(f"{c}_pct_change"), 1).over(w) for c in cols},
    })


def target_lead(df: DataFrame, source: str = "ppi_pct_change",
                out: str = "target_pct_change_next_month", keys: Sequence[str] = (),
                order: str = "month") -> DataFrame:
    """Next row's change as the supervised target."""
    return df.withColumn(out, F.lead(F.col(source), 1).over(_window(keys, order)))


def distinct_series(df: DataFrame, cols: Sequence[str] = ("month", "ppi_value")) -> DataFrame:
    """Distinct (month, value) pairs; two values in one month stay two rows."""
    return df.select(*cols).distinct()
