from pyspark.sql import functions as F

from monthcast.operators import upsert as U
from monthcast.session import scratch_path
from monthcast.sinks.tables import PartitionedUpsertTable, PeriodCounts

SCHEMA = "url string, title string, extra string, seq int"


def test_batch_dedup_last_wins_null_dropped_empty_kept(spark):
    b = spark.createDataFrame([("a", "1", None, 1), ("a", "2", None, 2), (None, "x", None, 3), ("", "e", None, 4)],
                              SCHEMA)
    out = {r["url"]: r["title"] for r in U.dedup_keep_last(b, ["url"], "seq").collect()}
    assert out == {"a": "2", "": "e"}


def test_merge_change_kinds_and_set_semantics(spark):
    target = spark.createDataFrame([("a", "old", "keep-a"), ("b", "same", "keep-b"), ("c", "untouched", "x")],
                                   "url string, title string, extra string")
    batch = spark.createDataFrame([("a", "new", 1), ("b", "same", 1), ("d", None, 1), (None, "z", 1)],
                                  "url string, title string, seq int")
    m = U.merge_with_changes(target, batch, ["url"], seq_col="seq", drop_seq=True)
    rows = {r["url"]: r for r in m.collect()}
    assert {k: r["__change"] for k, r in rows.items()} == {"a": "modified", "b": "unchanged", "c": "untouched",
                                                          "d": "inserted"}
    assert rows["a"]["title"] == "new" and rows["a"]["extra"] == "keep-a"  # target-only field survives
    assert rows["d"]["title"] is None
    counts = U.change_counts(m).first().asDict()
    assert counts == {"inserted": 1, "modified": 1, "unchanged": 1, "untouched": 1, "changed": 2}


def test_null_overwrites(spark):
    target = spark.createDataFrame([("a", "t")], "url string, title string")
    batch = spark.createDataFrame([("a", None)], "url string, title string")
    rows = U.merge_with_changes(target, batch, ["url"]).collect()
    assert rows[0]["title"] is None and rows[0]["__change"] == "modified"


def test_upsert_idempotent(spark):
    t = PartitionedUpsertTable(spark, scratch_path(spark, "upsert-test"), ["url"], "part")
    batch = spark.createDataFrame([("a", "1", None, 1), ("b", "2", None, 1), ("a", "3", None, 2)], SCHEMA)
    first = t.upsert(batch, "b1", F.lit("x"), seq_col="seq")
    assert first["changed"] == 2
    again = t.upsert(batch, "b2", F.lit("x"), seq_col="seq")
    assert again["changed"] == 0 and again["unchanged"] == 2
    assert t.upsert(batch, "b2", F.lit("x"), seq_col="seq")["skipped"]
    assert {r["url"]: r["title"] for r in t.read().collect()} == {"a": "3", "b": "2"}
    assert t.upsert(batch.limit(0), "b3", F.lit("x"), seq_col="seq")["changed"] == 0 and t.read().count() == 2


def test_duplicate_audit_and_cleanup_ignore_empty_and_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("", 4), ("", 5), (None, 6), (None, 7), ("b", 8)],
                               "url string, id int")
    audit = U.duplicate_key_audit(df, ["url"], "id").collect()
    assert [(r["url"], r["n"], r["keep"], r["n_extra"]) for r in audit] == [("a", 3, 1, 2)]
    kept = sorted(r["id"] for r in U.dedup_keep_first_by_key(df, ["url"], "id").collect())
    assert kept == [1, 4, 5, 6, 7, 8]


def test_partitioned_upsert_rewrites_only_touched_partitions(spark):
    import glob
    import os
    path = scratch_path(spark, "part-upsert")
    t = PartitionedUpsertTable(spark, path, ["url"], "month")
    schema = "url string, title string, m string, seq int"
    first = spark.createDataFrame([("a", "1", "2024-01", 1), ("b", "2", "2024-02", 1), ("c", "3", "2024-03", 1)], schema)
    assert t.upsert(first, "b1", F.col("m"), seq_col="seq")["inserted"] == 3
    files = lambda: {p: os.path.getmtime(p) for p in glob.glob(f"{path}/month_part=*/*.parquet")}
    before = files()
    # 'a' moves to a new month, its old one is left without rows; 'd' is new
    second = spark.createDataFrame([("a", "1b", "2024-05", 2), ("d", "4", "2024-02", 2)], schema)
    r2 = t.upsert(second, "b2", F.col("m"), seq_col="seq")
    assert (r2["inserted"], r2["modified"], r2["partitions_rewritten"]) == (1, 1, 3)
    rows = {r["url"]: (r["title"], r["month"]) for r in t.read().collect()}
    assert rows == {"a": ("1b", "2024-05"), "b": ("2", "2024-02"), "c": ("3", "2024-03"), "d": ("4", "2024-02")}
    after = files()
    assert all(after.get(p) == at for p, at in before.items() if "2024-03" in p) and any("2024-03" in p for p in before)


def test_null_empty_and_moving_partitions_lose_no_row(spark):
    """Random batches against a dictionary; partitions are null, empty, look
    like reserved names or numbers, and rows move between them."""
    import random
    rng = random.Random(4)
    values = [None, "", "~null", "~empty", "01", "1", "a/b c", "2024-01"]
    t = PartitionedUpsertTable(spark, scratch_path(spark, "moving"), ["k"], "p")
    want = {}
    for batch in range(4):
        rows = [(f"k{rng.randrange(12)}", rng.randrange(100), rng.choice(values), batch * 100 + i) for i in range(9 if batch else 20)]
        before = set(want)
        for k, v, p, s in rows:
            want[k] = (v, p, s)
        counts = t.upsert(spark.createDataFrame(rows, "k string, v int, q string, seq int"), str(batch), F.col("q"), seq_col="seq")
        assert counts["inserted"] == len(set(want) - before)
        assert {r.k: (r.v, r.p, r.seq) for r in t.read().collect()} == want and t.read().count() == len(want)
    # a key whose partition is null both times, and one whose is empty
    two = PartitionedUpsertTable(spark, scratch_path(spark, "nulls"), ["k"], "p")
    for i, k in enumerate("abcd"):
        two.upsert(spark.createDataFrame([(k, None if i < 2 else "")], "k string, q string"), k, F.col("q"))
    assert {(r.k, r.p) for r in two.read().collect()} == {("a", None), ("b", None), ("c", ""), ("d", "")}


def test_new_columns_and_typed_partitions(spark):
    t = PartitionedUpsertTable(spark, scratch_path(spark, "typed"), ["k"], "day")
    t.upsert(spark.sql("SELECT 'a' k, 1 v, DATE'2024-01-01' d UNION ALL SELECT 'b', 2, NULL"), "1", F.col("d"))
    t.upsert(spark.sql("SELECT 'c' k, 3 v, 'new' extra, DATE'2024-01-02' d"), "2", F.col("d"))
    t.upsert(spark.sql("SELECT 'a' k, 5 v, DATE'2024-01-01' d"), "3", F.col("d"))
    assert dict(t.read().dtypes)["day"] == "date"
    assert {(r.k, r.v, r.extra, str(r.day)) for r in t.read().collect()} == {
        ("a", 5, None, "2024-01-01"), ("b", 2, None, "None"), ("c", 3, "new", "2024-01-02")}


def test_period_counts_add_up_and_replay_changes_nothing(spark):
    t = PeriodCounts(spark, scratch_path(spark, "counts"), "window_start", ["g"])
    rows = lambda *x: spark.createDataFrame([(f"{d} 00:00:00", g, n, v) for d, g, n, v in x], "window_start string, g string, n long, total long"
                                            ).withColumn("window_start", F.col("window_start").cast("timestamp"))
    batches = [rows(("2024-01-01", "x", 1, 5), ("2024-01-02", None, 2, None), ("2024-02-01", "x", 1, 1)),
               rows(("2024-01-01", "x", 2, 5), ("2024-01-02", None, 1, 7)), rows(("2024-01-02", "x", 1, 1)).limit(0)]
    for i, b in enumerate(batches):
        t.add(b, i)
        t.add(b, i)
    t.add(batches[0], 0)      # a batch that others have followed
    got = {(str(r.window_start)[:10], r.g): (r.n, r.total) for r in t.read().collect()}
    assert got == {("2024-01-01", "x"): (3, 10), ("2024-01-02", None): (3, 7), ("2024-02-01", "x"): (1, 1)}


def test_sketches_merge_within_two_percent(spark):
    t = PeriodCounts(spark, scratch_path(spark, "sketches"), "window_start", [])
    for i in range(3):
        part = spark.range(i * 20_000, i * 20_000 + 40_000).select(F.lit("2024-01-01").cast("timestamp").alias("window_start"), F.col("id").cast("string").alias("v"))
        t.add(part.groupBy("window_start").agg(F.count("*").alias("n"), F.sum(F.lit(1)).alias("total"), F.hll_sketch_agg("v", F.lit(t.SKETCH_K)).alias("sketch")), i)
    row = t.read().select("n", F.hll_sketch_estimate("sketch").alias("d")).first()
    assert row.n == 120_000 and abs(row.d - 80_000) <= 0.02 * 80_000


def test_later_row_stays_whatever_order_batches_come(spark):
    t = spark.createDataFrame([("a", 5, "t"), ("b", 1, "t"), ("c", None, "t"), ("d", 3, "t")], "url string, seq int, v string")
    b = spark.createDataFrame([("a", 4, "b", 1), ("b", 2, "b", 1), ("c", 0, "b", 1), ("d", 3, "b", 1), ("e", None, "b", 1)],
                              "url string, seq int, v string, extra int")
    out = {r.url: (r.seq, r.v, r.extra, r["__change"]) for r in U.merge_with_changes(t, b, ["url"], "seq", newer_by="seq").collect()}
    assert out == {"a": (5, "t", None, U.UNTOUCHED), "b": (2, "b", 1, U.MODIFIED), "c": (0, "b", 1, U.MODIFIED),
                   "d": (3, "b", 1, U.MODIFIED), "e": (None, "b", 1, U.INSERTED)}


def test_stored_rows_stay_in_place_until_the_merge(spark):
    """Folder names are sent to the stored rows, which are not shuffled by
    folder first; staging, batch and table are written with the table's codec."""
    import glob
    t = PartitionedUpsertTable(spark, scratch_path(spark, "in-place"), ["url"], "part")
    t.upsert(spark.createDataFrame([("a", "1", "x", 1), ("b", "2", "y", 1)], SCHEMA), "b1", F.col("extra"), seq_col="seq")
    touched = t.stored().where(F.col("url") == "a").select(t.folder).distinct()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = t.rows_of(touched)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert [r.url for r in t.rows_of(touched).collect()] == ["a"]
    for path in (t.path, t.staging, t.batch_path):
        files = glob.glob(f"{path}/**/*.parquet", recursive=True)
        assert files and all(f.endswith(".zstd.parquet") for f in files)
