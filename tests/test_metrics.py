import datetime as dt

import pytest

from monthcast.operators import metrics as M

LABELS = ["low", "medium", "high"]
MATRIX = [[1, 0, 0], [1, 1, 0], [0, 8, 1]]


def expanded(spark):
    rows = []
    for i, a in enumerate(LABELS):
        for j, p in enumerate(LABELS):
            rows += [(a, p)] * MATRIX[i][j]
    return spark.createDataFrame(rows, "y string, p string")


def test_confusion_matrix_zero_filled(spark):
    cm = {(r["actual"], r["predicted"]): r["n"] for r in M.confusion_matrix(expanded(spark), "y", "p").collect()}
    assert len(cm) == 9
    assert [[cm[(a, p)] for p in LABELS] for a in LABELS] == MATRIX


def test_accuracy_and_f1_goldens(spark):
    df = expanded(spark)
    assert M.accuracy(df, "y", "p").first()[0] == pytest.approx(0.25)
    assert M.macro_f1(df, "y", "p").first()[0] == pytest.approx(0.3494949494949495)
    rep = {r["label"]: r for r in M.classification_report(df, "y", "p").collect()}
    assert rep["weighted avg"]["f1"] == pytest.approx(0.23585858585858585)
    assert rep["macro avg"]["f1"] == pytest.approx(0.3494949494949495)
    assert rep["high"]["support"] == 9


def test_macro_f1_only_present_labels_report_all(spark):
    df = spark.createDataFrame([("low", "low"), ("medium", "low")], "y string, p string")
    assert M.macro_f1(df, "y", "p").first()[0] == pytest.approx((2 / 3 + 0) / 2)
    rep = {r["label"]: r for r in M.classification_report(df, "y", "p").collect()}
    assert rep["high"]["f1"] == 0.0 and rep["macro avg"]["f1"] == pytest.approx((2 / 3) / 3)


def test_split_last_n_rows(spark):
    rows = [(dt.date(2020, m, 1), m) for m in range(1, 13)]
    df = spark.createDataFrame(rows, "month date, v int")
    out = {r["v"]: r["is_test"] for r in M.chronological_split(df, 3).collect()}
    assert [v for v, t in sorted(out.items()) if t] == [10, 11, 12]


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",)], "y string")
    w = {r["y"]: r["weight"] for r in M.class_weights(df, "y").collect()}
    assert w["a"] == pytest.approx(4 / (2 * 3)) and w["b"] == pytest.approx(4 / (2 * 1))


def test_select_best_first_wins_ties(spark):
    res = spark.createDataFrame([("lr", 0, 0.5), ("gb", 1, 0.5), ("x", 2, None)],
                                "model string, position int, macro_f1 double")
    assert M.select_best(res, "macro_f1").first()["model"] == "lr"


def test_class_distribution_sum(spark):
    df = expanded(spark)
    dist = M.class_distribution(df, "y").collect()
    assert sum(r["count"] for r in dist) == 12 and dist[0]["y"] == "high"


def test_evaluation_reproduces_a_published_report(spark):
    """The figures of a 12-row holdout from its confusion matrix."""
    matrix = {("low", "low"): 1, ("medium", "low"): 1, ("medium", "medium"): 1, ("high", "medium"): 8, ("high", "high"): 1}
    rows = [("m", y, p) for (y, p), n in matrix.items() for _ in range(n)] + [("m", None, "low"), ("m", "low", None), ("n", "low", "x")]
    df = spark.createDataFrame(rows, "model string, y string, p string")
    out = {(r.model, r.metric, r.label, r.predicted_label): r.value for r in M.evaluation(df, "y", "p").collect()}
    got = lambda metric, label=None, predicted=None, model="m": out[(model, metric, label, predicted)]
    assert got("n_rows_test") == 12 and got("accuracy") == 0.25
    assert got("macro_f1") == pytest.approx(0.3494949494949495) == got("f1-score", "macro avg")
    assert got("precision", "macro avg") == pytest.approx(0.5370370370370371) == got("recall", "macro avg")
    assert got("precision", "weighted avg") == pytest.approx(0.8101851851851851) and got("f1-score", "weighted avg") == pytest.approx(0.23585858585858585)
    assert got("precision", "medium") == pytest.approx(1 / 9) and got("recall", "medium") == 0.5 and got("support", "high") == 9
    for y in ("low", "medium", "high"):
        for p in ("low", "medium", "high"):
            assert got("confusion_matrix", y, p) == matrix.get((y, p), 0)
    assert got("predicted_class_distribution", "medium") == 9 and got("test_class_distribution", "high") == 9
    # a label outside the fixed ones counts for the overall macro F1 alone
    assert got("macro_f1", model="n") == 0 and got("support", "low", model="n") == 1 and got("predicted_class_distribution", "x", model="n") == 1
    assert M.evaluation(df.limit(0), "y", "p").count() == 0


def test_split_numbers_only_the_rows_at_the_cut(spark):
    df = spark.createDataFrame([(1, "a")] * 5 + [(2, "b")] * 4 + [(3, "c"), (None, "d")], "month int, v string")
    for size in (0, 1, 3, 5, 8, 11, 20):
        got = M.chronological_split(df, size).collect()
        taken = sorted((r.month for r in got if r.is_test), key=lambda x: (x is None, -(x or 0)))
        assert len(got) == 11 and taken == ([3] + [2] * 4 + [1] * 5 + [None])[:size]
    plan = M.chronological_split(spark.range(100).withColumnRenamed("id", "month"), 3)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Union") == 1
