import threading

import numpy as np
import pytest

from monthcast.operators import labels as L
from monthcast.operators import ml as ML


def numpy_balanced_logistic(X, y, classes, C=1.0, iters=20000, lr=0.05):
    """Minimise 0.5*||W||^2 + C * sum_i s_i * CE_i (intercepts unpenalised) by
    full-batch gradient descent; s_i = n / (k * n_class)."""
    n, d = X.shape
    k = len(classes)
    Y = np.zeros((n, k))
    for i, c in enumerate(y):
        Y[i, classes.index(c)] = 1.0
    counts = Y.sum(axis=0)
    s = (n / (k * counts))[Y.argmax(axis=1)]
    W, b = np.zeros((d, k)), np.zeros(k)
    for _ in range(iters):
        Z = X @ W + b
        Z -= Z.max(axis=1, keepdims=True)
        P = np.exp(Z)
        P /= P.sum(axis=1, keepdims=True)
        G = (P - Y) * s[:, None] * C
        W -= lr * (X.T @ G + W) / n
        b -= lr * G.sum(axis=0) / n
    Z = X @ W + b
    P = np.exp(Z - Z.max(axis=1, keepdims=True))
    return P / P.sum(axis=1, keepdims=True)


def test_logistic_matches_balanced_c1_objective(spark):
    rng = np.random.default_rng(42)
    n = 45
    X = rng.normal(size=(n, 2))
    labels = ["high", "low", "medium"]  # alphabetical = MLlib label order
    y = [labels[i] for i in np.digitize(X[:, 0] + 0.7 * rng.normal(size=n), [-0.5, 0.6])]
    y = y[:40] + ["high"] * 5  # unbalanced classes so the weights matter
    rows = [(float(a), float(b), c) for (a, b), c in zip(X, y)]
    df = spark.createDataFrame(rows, "f1 double, f2 double, target_class string")
    model = ML.fit_logistic(df, ["f1", "f2"], max_iter=2000)
    got = ML.score(model, df).collect()
    ref = numpy_balanced_logistic(X, y, labels)
    for r, p in zip(got, ref):
        assert [r["proba_high"], r["proba_low"], r["proba_medium"]] == pytest.approx(list(p), abs=2e-3)


def test_approx_quantile_option_close(spark):
    rows = [(float(i),) for i in range(1000)]
    df = spark.createDataFrame(rows, "target_pct_change_next_month double")
    exact = L.quantile_cuts(df).first()
    approx = L.quantile_cuts(df, approx=True).first()
    assert exact["low_cut"] == pytest.approx(329.67)
    assert abs(approx["low_cut"] - exact["low_cut"]) <= 2 and abs(approx["high_cut"] - exact["high_cut"]) <= 2


def test_sketches_of_parts_merge_with_bounded_rank_error(spark):
    """Sketches of 30 parts of 90,000 skewed values, merged: true ranks of the
    cuts within 1 %; nulls and NaN count for nothing, empty groups are absent."""
    from pyspark.sql import functions as F
    df = spark.range(90_000).select((F.col("id") % 30).alias("part"), (F.col("id") % 2).alias("k"),
                                    F.exp(F.pmod(F.xxhash64("id"), F.lit(1000)) / 100.0).alias("v"))
    odd = spark.createDataFrame([(0, 0, None), (0, 0, float("nan")), (0, 7, None)], "part long, k long, v double")
    parts = L.quantile_sketches(df.unionByName(odd), "v", ["k", "part"])
    merged = L.merged_sketches(parts, ["k"])
    assert {r.k: r.n for r in merged.collect()} == {0: 45_000, 1: 45_000}
    cuts = L.sketch_cuts(merged, 0.1, 0.9, ["k"])
    ranks = df.join(cuts, "k").groupBy("k").agg(F.avg((F.col("v") <= F.col("low_cut")).cast("double")).alias("a"),
                                                F.avg((F.col("v") <= F.col("high_cut")).cast("double")).alias("b"))
    assert all(abs(r.a - 0.1) <= 0.01 and abs(r.b - 0.9) <= 0.01 for r in ranks.collect())
    nothing = df.withColumnRenamed("v", "target_pct_change_next_month").limit(0)
    assert L.quantile_cuts(nothing, approx=True).collect() == L.quantile_cuts(nothing).collect()


def test_fits_run_on_as_many_partitions_as_rows_fill(spark, monkeypatch):
    """Few rows in many partitions are fitted in one, prepared once; the same
    models come out of more partitions, which more rows fill."""
    rows = [(float(i), float(i % 7), ["low", "medium", "high"][i // 10 % 3]) for i in range(30)]
    df = spark.createDataFrame(rows, "f1 double, f2 double, target_class string").repartition(9, "f1").cache()
    seen, fits = [], {}
    for name, fit in (("gbt", ML.OneVsRest.fit), ("logistic", ML.LogisticRegression.fit)):
        cls = ML.OneVsRest if name == "gbt" else ML.LogisticRegression
        monkeypatch.setattr(cls, "fit", lambda self, data, *a, f=fit: (seen.append((data.rdd.getNumPartitions(), sorted(data.columns))), f(self, data, *a))[1])
    for most in (50_000, 5):
        monkeypatch.setattr(ML, "ROWS_PER_PARTITION", most)
        for name, model in (("gbt", ML.fit_gbt(df, ["f1", "f2"], max_iter=2)), ("logistic", ML.fit_logistic(df, ["f1", "f2"], max_iter=50))):
            fits[name, most] = [tuple(r) for r in ML.score(model, df).select("predicted", "proba_low", "proba_medium", "proba_high").orderBy("f1").collect()]
    assert seen == [(n, c) for n in (1, 6) for c in (["features", "label_idx"], ["features", "label_idx", "weight"])]
    for name in ("gbt", "logistic"):
        for a, b in zip(fits[name, 50_000], fits[name, 5], strict=True):
            assert a[0] == b[0] and a[1:] == pytest.approx(b[1:], abs=1e-6)


def test_candidates_are_fitted_side_by_side(spark, monkeypatch):
    """Each fit waits for the other to begin. Results, models and scored rows
    are those of each candidate alone, in the order asked for; the caller's
    local properties hold in both fits."""
    rows = [(i, float(i), float(i % 7), ["low", "medium", "high"][i // 4 % 3]) for i in range(40)]
    df = spark.createDataFrame(rows, "month int, f1 double, f2 double, target_class string")
    names, features = ["gradient_boosting", "logistic_regression"], ["f1", "f2"]
    cols = ["model", "month", "predicted", "proba_low", "proba_medium", "proba_high"]

    def scores(scored):
        return [tuple(r) for r in scored.select(*cols).orderBy("model", "month").collect()]

    alone = {n: ML.train_candidates(df, features, 8, candidates=[n], max_iter=3) for n in names}
    begun, seen = threading.Barrier(2, timeout=60), []
    for name in ("fit_gbt", "fit_logistic"):
        def waiting(*a, fit=getattr(ML, name), **k):
            seen.append(spark.sparkContext.getLocalProperty("monthcast.test"))
            begun.wait()
            return fit(*a, **k)
        monkeypatch.setattr(ML, name, waiting)
    spark.sparkContext.setLocalProperty("monthcast.test", "own")
    try:
        results, models, scored = ML.train_candidates(df, features, 8, candidates=names, max_iter=3)
    finally:
        spark.sparkContext.setLocalProperty("monthcast.test", None)
    assert seen == ["own", "own"] and list(models) == names
    assert [tuple(r)[0:2] for r in results.collect()] == [(n, i) for i, n in enumerate(names)]
    assert [tuple(r)[2:] for r in results.collect()] == [tuple(alone[n][0].first())[2:] for n in names]
    assert scores(scored) == [r for n in names for r in scores(alone[n][2])]
    with pytest.raises(ValueError, match="no such candidate"):
        ML.train_candidates(df, features, 8, candidates=["other"])
