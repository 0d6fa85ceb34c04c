import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from monthcast.operators import labels as L
from monthcast.operators import series as S


def months(n, start=(2020, 1)):
    y, m = start
    out = []
    for _ in range(n):
        out.append(dt.date(y, m, 1))
        m += 1
        if m > 12:
            y, m = y + 1, 1
    return out


def frame(spark, values, name="v"):
    rows = list(zip(months(len(values)), values))
    return spark.createDataFrame(rows, f"month date, {name} double")


def col(df, c):
    return [r[c] for r in df.orderBy("month").collect()]


def test_pct_change_pads_and_null_divisor(spark):
    df = frame(spark, [None, 1.0, 0.0, 2.0, None, -3.0])
    out = df.withColumn("p", S.pct_change("v"))
    got = col(out, "p")
    assert got[0] is None and got[1] is None
    assert got[2] == pytest.approx(-100.0)
    assert got[3] is None  # 2 / 0: NULL, not infinity
    assert got[4] == pytest.approx(0.0)  # padded value over itself
    assert got[5] == pytest.approx(-250.0)


def test_rolling_mean_std_previous_three(spark):
    df = frame(spark, [1.0, 2.0, 4.0, 7.0, 11.0, 5.0], "ppi_value")
    out = S.series_features(df)
    ma, sd = col(out, "ppi_ma_3"), col(out, "ppi_std_3")
    assert ma[:3] == [None, None, None] and sd[:3] == [None, None, None]
    assert ma[3:] == pytest.approx([2.333333, 4.333333, 7.333333], abs=1e-6)
    assert sd[3:] == pytest.approx([1.527525, 2.516611, 3.511885], abs=1e-6)
    assert col(out, "ppi_lag_1")[1:] == [1.0, 2.0, 4.0, 7.0, 11.0]


def test_quantile_cuts_linear(spark):
    df = frame(spark, [1.0, 2.0, 4.0, 7.0, 11.0, 5.0], "target_pct_change_next_month")
    cuts = L.quantile_cuts(df).first()
    assert cuts["low_cut"] == pytest.approx(3.3)
    assert cuts["high_cut"] == pytest.approx(5.7)


def test_class_boundaries_go_low(spark):
    vals = [1.0, 2.0, 3.0, 4.0, None]
    df = frame(spark, vals, "t")
    out = df.withColumn("c", L.class_of(F.col("t"), F.lit(2.0), F.lit(3.0)))
    assert col(out, "c") == ["low", "low", "medium", "high", None]


def test_target_class_window_matches_cuts(spark):
    df = frame(spark, [1.0, 2.0, 4.0, 7.0, 11.0, 5.0, None], "target_pct_change_next_month")
    out = L.add_target_class(df, with_cuts=True).orderBy("month").collect()
    assert all(r["low_cut"] == pytest.approx(3.3) for r in out)
    assert [r["target_class"] for r in out] == ["low", "low", "medium", "high", "high", "medium", None]


def test_forward_fill_unbounded_and_leading_nulls(spark):
    df = frame(spark, [None, 1.0, None, None, 4.0, None])
    out = S.forward_fill(df, ["v"])
    assert col(out, "v") == [None, 1.0, 1.0, 1.0, 4.0, 4.0]


def test_monthly_mean_skips_null_and_nan(spark):
    rows = [(dt.datetime(2020, 1, 1), 1.0), (dt.datetime(2020, 1, 15), float("nan")),
            (dt.datetime(2020, 1, 20), None), (dt.datetime(2020, 1, 31), 3.0),
            (None, 100.0), (dt.datetime(2020, 2, 2), 5.0)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, x double")
    out = S.monthly_mean(df, "ts", "x", "m").orderBy("month").collect()
    assert [(r["month"], r["m"]) for r in out] == [(dt.date(2020, 1, 1), 2.0), (dt.date(2020, 2, 1), 5.0)]


def test_outer_join_all_keeps_unmatched(spark):
    a = spark.createDataFrame([(dt.date(2020, 1, 1), 1.0)], "month date, a double")
    b = spark.createDataFrame([(dt.date(2020, 2, 1), 2.0)], "month date, b double")
    out = S.outer_join_all([a, b]).orderBy("month").collect()
    assert [(r["month"].month, r["a"], r["b"]) for r in out] == [(1, 1.0, None), (2, None, 2.0)]


def test_panel_windows_do_not_cross_keys(spark):
    rows = [("a", d, v) for d, v in zip(months(3), [1.0, 2.0, 3.0])] + \
           [("b", d, v) for d, v in zip(months(3), [10.0, 20.0, 40.0])]
    df = spark.createDataFrame(rows, "k string, month date, ppi_value double")
    out = S.series_features(df, keys=["k"]).orderBy("k", "month").collect()
    assert [r["ppi_lag_1"] for r in out] == [None, 1.0, 2.0, None, 10.0, 20.0]
    assert out[5]["ppi_pct_change"] == pytest.approx(100.0)


def test_gap_month_is_positional(spark):
    rows = [(dt.date(2020, 1, 1), 1.0), (dt.date(2020, 3, 1), 2.0)]
    df = spark.createDataFrame(rows, "month date, ppi_value double")
    out = S.series_features(df).orderBy("month").collect()
    assert out[1]["ppi_lag_1"] == 1.0  # missing February is not detected (row based)


def test_distinct_pairs_keep_two_values_per_month(spark):
    rows = [(dt.date(2020, 1, 1), 1.0), (dt.date(2020, 1, 1), 1.0), (dt.date(2020, 1, 1), 2.0)]
    df = spark.createDataFrame(rows, "month date, ppi_value double")
    assert S.distinct_series(df).count() == 2


def test_lead_target(spark):
    df = frame(spark, [1.0, 2.0, 3.0], "ppi_pct_change")
    assert col(S.target_lead(df), "target_pct_change_next_month") == [2.0, 3.0, None]


def test_no_nan_leaks(spark):
    df = frame(spark, [float("nan"), 1.0, 2.0])
    from monthcast.functions.numeric import nan_to_null
    vals = col(df.withColumn("v", nan_to_null("v")), "v")
    assert vals[0] is None and not any(isinstance(v, float) and math.isnan(v) for v in vals)


def test_gaps_limits_and_training_cuts(spark):
    import datetime as dt

    from monthcast.operators import labels as L
    from monthcast.operators import series as S
    month = lambda m: dt.date(2024, m, 1)
    rows = [("a", month(m), float(m)) for m in (1, 2, 3, 4, 7)] + [("b", month(5), None), ("b", month(6), 2.0), (None, month(1), 1.0), ("a", None, 9.0)]
    df = spark.createDataFrame(rows, "k string, month date, ppi_value double")
    dense = S.dense_months(df, keys=["k"])
    assert dense.count() == 11 and {(r.k, r.month.month) for r in dense.where("ppi_value is null").collect()} == {("a", 5), ("a", 6), ("b", 5)}
    filled = {r.month.month: r.ppi_value for r in S.forward_fill(dense.where("k = 'a' and month is not null"), ["ppi_value"], limit=1).collect()}
    assert filled == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: None, 7: 7}
    out = {r.month.month: r for r in S.calendar_series_features(df.where("k = 'a' and month is not null"), keys=["k"]).collect()}
    assert out[4].ppi_ma_3 == 2.0 and out[4].ppi_std_3 == 1.0 and out[4].ppi_lag_1 == 3.0
    assert out[7].ppi_lag_1 is None and out[7].ppi_pct_change is None and out[7].ppi_ma_3 is None
    cuts = [(f"{y}", dt.date(y, 1, 1), float(y - 2000)) for y in range(2000, 2010)] + [("x", dt.date(2010, 1, 1), None)]
    vals = spark.createDataFrame(cuts, "n string, month date, v double")
    both = {h: L.add_target_class(vals, "v", low_q=0.5, high_q=0.5, holdout=h, with_cuts=True).where("n = '2000'").first().low_cut for h in (0, 4)}
    assert both == {0: 4.5, 4: 2.5}


def test_fixed_decimals_beyond_a_trillion(spark):
    import random

    from pyspark.sql import functions as F

    from monthcast.functions.formatting import format_fixed
    rng = random.Random(6)
    xs = [1e12 + 0.125, 999999999999.125, -1e12 - 0.375, 2.0 ** 52 + 0.5, 2.0 ** 52 + 1.5, 1e15 + 0.9995, 9e15, 2.0 ** 40 - 0.0005, 2.0 ** 62, 1099511627775.9999, 0.125, -0.0]
    xs += [rng.uniform(1e12, 1e16) for _ in range(200)] + [rng.randrange(2 ** 40, 2 ** 44) + rng.randrange(1, 8192) / 8192 for _ in range(200)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for d in (0, 2, 3):
        got = df.select(format_fixed(F.col("x"), d).alias("t")).collect()
        bad = [(x, r.t, f"{x:.{d}f}") for x, r in zip(xs, got, strict=True) if r.t != f"{x:.{d}f}" and x != 0]
        assert not bad, bad[:5]
