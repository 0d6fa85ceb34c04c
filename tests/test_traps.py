"""Inputs that the driver's tables don't hold."""
import math

import pytest

from monthcast.functions.formatting import format_fixed, format_percent
from monthcast.functions.numeric import coerce_double
from monthcast.operators import metrics as M
from monthcast.operators import sentiment as S


def test_fixed_decimals_of_exact_values(spark):
    values = [0.125, 1.005, 2.675, 0.5, 1.5, 2.5, -0.125, -0.001, 0.0, 1e-9, 123456.789, 0.045, 0.055, 1e15, 99.995, 0.285, 1.115,
              *[i / 1000 for i in range(0, 3000, 5)], *[i / 8 for i in range(50)]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    for d in (0, 2, 3):
        got = {r.i: r.t for r in df.select("i", format_fixed("x", d).alias("t")).collect()}
        assert [got[i] for i in range(len(values))] == [f"{v:.{d}f}" for v in values]
    got = {r.i: r.t for r in df.select("i", format_percent("x").alias("t")).collect()}
    assert [got[i] for i in range(len(values))] == [f"{v * 100:.2f}%" for v in values]


def test_missing_prints_na(spark):
    df = spark.createDataFrame([(None,), ("abc",), ("nan",)], "x string")
    assert [tuple(r) for r in df.select(format_fixed("x", 2), format_percent("x")).collect()] == [
        ("N/A", "N/A"), ("N/A", "N/A"), ("nan", "nan%")]


def test_only_numbers_become_numbers(spark):
    texts = ["10d", "5F", "0x1p3", "1e3", " 7.5 ", ".5", "5.", "-2", "NaN", "", ".", "1,0", "inf", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(coerce_double("t")).collect()]
    assert got == [None, None, None, 1000.0, 7.5, 0.5, 5.0, -2.0, None, None, None, None, math.inf, None]


@pytest.mark.parametrize("months", [[1, 2, 3, 3], [3, 3, 3, 3], [1], [], [None, 2, 2]])
def test_split_takes_exactly_n_rows(spark, months):
    rows = [(m, float(i // 2)) for i, m in enumerate(months)]
    out = M.chronological_split(spark.createDataFrame(rows, "month int, x double"), 2).collect()
    assert len(out) == len(rows) and sum(r.is_test for r in out) == min(2, len(rows))
    taken = sorted((r.month or 0 for r in out if r.is_test), reverse=True)
    assert taken == sorted((m or 0 for m in months), reverse=True)[:2]


def test_contrast_is_searched_once_per_text(spark):
    df = spark.createDataFrame([(1, "good but bad")], "id long, t string")
    plan = S.score_all(df, "t", "id", S.lexicon_frame(spark))._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Generate")]
    assert "array_position" not in above and "array_position" in plan


def test_saved_model_scores_raw_and_unlabelled_rows(spark):
    from monthcast.operators import ml as ML
    from monthcast.session import scratch_path
    rows = [(float(i), None if i % 5 == 0 else float(i % 7), None, ["low", "medium", "high"][i % 3] if i % 4 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "a double, b double, empty double, target_class string")
    for model in (ML.fit_logistic(df, ["a", "b", "empty"], max_iter=50, scale=True), ML.fit_gbt(df, ["a", "b", "empty"], max_iter=2)):
        path = scratch_path(spark, "trap-model")
        ML.save_model(model, path)
        loaded = ML.load_model(path)
        assert ML.model_features(loaded) == ["a", "b"] and ML.class_names(loaded) == ["high", "low", "medium"]
        one, two = ML.score(model, df).collect(), ML.score(loaded, df).collect()
        assert len(one) == 40 and one == two and all(r.predicted in ML.class_names(model) for r in one)
        assert all(r.proba_low + r.proba_medium + r.proba_high == pytest.approx(1) for r in one)


def test_partition_values_keep_their_type_and_a_cut_swap_is_finished(spark):
    from pyspark.sql import functions as F

    from monthcast.session import scratch_path
    from monthcast.sinks.tables import PartitionedUpsertTable
    path = scratch_path(spark, "trap-upsert")
    table = PartitionedUpsertTable(spark, path, ["k"], "mm")
    new = lambda rows: spark.createDataFrame(rows, "k string, v int, m string")
    table.upsert(new([("a", 1, "01"), ("b", 1, "01"), ("c", 1, "02")]), "1", F.col("m"))
    assert table.upsert(new([("a", 2, "01")]), "2", F.col("m"))["modified"] == 1
    assert sorted((r.k, r.v, r.mm) for r in table.read().collect()) == [("a", 2, "01"), ("b", 1, "01"), ("c", 1, "02")]

    class Lost(Exception):
        pass

    class Cut(PartitionedUpsertTable):
        def swap(self):
            # the target partition is gone, the new one not there yet
            fs = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/mm_part=01")
            fs.getFileSystem(spark._jsc.hadoopConfiguration()).delete(fs, True)
            raise Lost

    with pytest.raises(Lost):
        Cut(spark, path, ["k"], "mm").upsert(new([("a", 3, "01")]), "3", F.col("m"))
    assert table.upsert(new([("a", 3, "01")]), "3", F.col("m")) == {"skipped": True, "changed": 0}
    assert sorted((r.k, r.v, r.mm) for r in table.read().collect()) == [("a", 3, "01"), ("b", 1, "01"), ("c", 1, "02")]
