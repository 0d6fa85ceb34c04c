import datetime as dt

import pytest
from pyspark.sql import functions as F

from monthcast.operators import ml as ML
from monthcast.operators import report as R
from monthcast.session import scratch_path
from monthcast.sinks.tables import PartitionedUpsertTable
from monthcast.streaming.news_stream import file_stream, stream_upsert


def test_recent_articles_null_first_and_ties(spark):
    rows = [(dt.datetime(2024, 1, 1), "a", "t1"), (dt.datetime(2024, 1, 2), "b", "t2"),
            (dt.datetime(2024, 1, 2), "c", "t3"), (None, "d", "t4")]
    df = spark.createDataFrame(rows, "published_at timestamp_ntz, url string, title string")
    out = R.recent_articles(df, 3).collect()
    assert [r["url"] for r in out] == ["d", "c", "b"] and out[0]["published_at"] == ""


def test_news_signal_trend_bars(spark):
    rows = [(dt.date(2024, m, 1), m * 10, -0.5 if m == 2 else 0.2) for m in range(1, 4)]
    df = spark.createDataFrame(rows, "month date, article_count long, avg_sentiment double")
    out = {r["month"]: r for r in R.news_signal_trend(df, 2).collect()}
    assert set(out) == {"2024-02", "2024-03"}
    assert out["2024-03"]["volume_width"] == 100.0 and out["2024-02"]["sentiment_class"] == "sentiment-negative"
    assert out["2024-02"]["sentiment_width"] == pytest.approx(50.0)


def test_median_impute_true_median(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (3.0,), (None,)], "x double")
    out = ML.median_impute(df, df, ["x"]).collect()
    assert sorted(r["x"] for r in out)[2] == 1.5


def test_standard_scale_population_and_zero_variance(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    out = ML.standard_scale(df, df, ["a", "b"]).collect()
    assert [r["a"] for r in out] == [-1.0, 1.0] and [r["b"] for r in out] == [0.0, 0.0]


def test_logistic_probabilities(spark):
    rows = [(float(i), float(i % 3), ["low", "medium", "high"][i % 3]) for i in range(30)]
    df = spark.createDataFrame(rows, "f1 double, f2 double, target_class string")
    model = ML.fit_logistic(df, ["f1", "f2"], max_iter=200)
    out = ML.score(model, df).collect()
    for r in out:
        assert r["proba_low"] + r["proba_medium"] + r["proba_high"] == pytest.approx(1.0)
    assert sum(r["predicted"] == r["target_class"] for r in out) >= 25


def test_stream_upsert_equals_batch(spark):
    rows = [(f"u{i % 5}", f"t{i}", i) for i in range(20)]
    df = spark.createDataFrame(rows, "url string, title string, seq long")
    landing = scratch_path(spark, "stream-test-landing")
    df.repartitionByRange(4, "seq").write.parquet(landing)
    root = scratch_path(spark, "stream-test-table")
    log = stream_upsert(file_stream(spark, landing, df.schema), root, ["url"], ["seq"],
                        checkpoint=scratch_path(spark, "stream-test-ckpt"), partition_col="part",
                        part_value=F.pmod("seq", F.lit(3)).cast("string"))
    assert len(log) >= 1
    got = PartitionedUpsertTable(spark, root, ["url"], "part").read()
    assert got.count() == 5
    assert got.groupBy("url").count().where(F.col("count") > 1).count() == 0


def test_model_save_load_roundtrip(spark):
    rows = [(float(i), ["low", "medium", "high"][i % 3]) for i in range(24)]
    df = spark.createDataFrame(rows, "f1 double, target_class string")
    model = ML.fit_logistic(df, ["f1"], max_iter=50)
    path = scratch_path(spark, "model-test")
    ML.save_model(model, path)
    back = ML.load_model(path)
    assert ML.model_features(back) == ["f1"] and ML.class_names(back) == ML.class_names(model)
    a = [r["predicted"] for r in ML.score(model, df).orderBy("f1").collect()]
    b = [r["predicted"] for r in ML.score(back, df).orderBy("f1").collect()]
    assert a == b


def test_prediction_artifact_scan(spark):
    from monthcast.sinks.tables import export_csv
    from monthcast.sources.tables import read_prediction
    df = spark.createDataFrame([(dt.date(2026, 3, 1), "medium", 0.05, 0.56, 0.39)],
                               "month date, predicted_next_month_pressure string, proba_low double, "
                               "proba_medium double, proba_high double")
    path = scratch_path(spark, "pred-test")
    export_csv(df, path)
    r = read_prediction(spark, path).first()
    assert r["month"] == dt.date(2026, 3, 1) and r["predicted_next_month_pressure"] == "medium"


def test_dedup_within_watermark_stream(spark):
    from monthcast.streaming.news_stream import dedup_within_watermark
    rows = [("u1", dt.datetime(2024, 1, 1, 0, 0)), ("u1", dt.datetime(2024, 1, 1, 0, 5)),
            ("u2", dt.datetime(2024, 1, 1, 0, 6))]
    df = spark.createDataFrame(rows, "url string, ts timestamp_ntz")
    landing = scratch_path(spark, "dedup-landing")
    df.coalesce(1).write.parquet(landing)
    out_path = scratch_path(spark, "dedup-out")
    stream = dedup_within_watermark(file_stream(spark, landing, df.schema), ["url"], "ts", "1 hour")
    q = (stream.writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", scratch_path(spark, "dedup-ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted(r["url"] for r in spark.read.parquet(out_path).collect())
    assert got == ["u1", "u2"]


def test_first_seen_counts_late_rows(spark):
    """Copies within the delay go, a row older than the watermark is counted."""
    from monthcast.streaming.news_stream import stream_first_seen
    day = lambda d: dt.datetime(2024, 1, d)
    files = [[("u1", day(1)), ("u1", day(1)), ("u2", day(2)), ("u4", None)], [("u3", day(20)), ("u3", day(20))], [("u9", day(20))], [("old", day(1))]]
    landing, schema = scratch_path(spark, "late-landing"), "url string, ts timestamp_ntz"
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
    out = scratch_path(spark, "late-out")
    late = stream_first_seen(file_stream(spark, landing, spark.createDataFrame([], schema).schema), ["url"], "ts", "2 days", out,
                             scratch_path(spark, "late-ckpt"))
    assert sorted(r.url for r in spark.read.parquet(out).collect()) == ["u1", "u2", "u3", "u9"] and late == 1


def test_stream_period_counts_match_batch(spark):
    from monthcast.streaming.news_stream import stream_period_counts
    rows = [(i, dt.datetime(2024, 1 + i % 2, 1 + (i % 3), i % 24), "click" if i % 2 else None, float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, event_type string, value double")
    landing = scratch_path(spark, "wc-landing")
    df.repartition(3, "event_id").write.parquet(landing)
    for period, of in (("day", lambda ts: (ts.month, ts.day)), ("month", lambda ts: (ts.month, 1))):
        table, checkpoint = scratch_path(spark, "wc-table"), scratch_path(spark, "wc-ckpt")
        for _ in range(2):      # started again: nothing is new
            counts = stream_period_counts(file_stream(spark, landing, df.schema), "ts", ["event_type"], "value", table, checkpoint, period=period)
        got = {(r.window_start.month, r.window_start.day, r.event_type): (r.n, r.total) for r in counts.read().collect()}
        expect = {}
        for i, ts, e, v in rows:
            n, t = expect.get((*of(ts), e), (0, 0.0))
            expect[(*of(ts), e)] = (n + 1, t + v)
        assert got == expect


def test_api_articles_limits_and_dates(spark):
    rows = [("2024-01-02T10:00:00Z", "a"), ("garbage", "b"), (None, "c")]
    raw = spark.createDataFrame(rows, "seen_date string, url string")
    out = R.api_articles(None, raw, limit=2, cleaned=False).collect()
    assert [(r["url"], r["seen_date"]) for r in out] == [("c", ""), ("b", "")]
    full = {r["url"]: r["seen_date"] for r in R.api_articles(None, raw, limit=500, cleaned=False).collect()}
    assert full["a"] == "2024-01-02"
    with pytest.raises(ValueError):
        R.api_articles(None, raw, limit=501, cleaned=False)


def test_stream_into_partitioned_table(spark):
    rows = [(f"u{i % 6}", f"t{i}", i, f"2024-0{1 + i % 3}") for i in range(24)]
    df = spark.createDataFrame(rows, "url string, title string, seq long, m string")
    landing = scratch_path(spark, "pstream-landing")
    df.repartitionByRange(3, "seq").write.parquet(landing)
    root = scratch_path(spark, "pstream-table")
    stream_upsert(file_stream(spark, landing, df.schema), root, ["url"], ["seq"],
                  checkpoint=scratch_path(spark, "pstream-ckpt"), partition_col="month", part_value=F.col("m"))
    got = PartitionedUpsertTable(spark, root, ["url"], "month").read()
    assert got.count() == 6 and got.groupBy("url").count().where(F.col("count") > 1).count() == 0


def test_landed_files_grow_in_number_not_in_size(spark, monkeypatch):
    from monthcast.streaming import news_stream as N
    monkeypatch.setattr(N, "FILE_ROWS", 10)
    df = spark.range(95).select(F.col("id"), (F.col("id") % 5).cast("string").alias("url"))
    path = scratch_path(spark, "land-test")
    per_trigger = N.land(df, path, ["url", "id"], ordered=True)
    files = [r.n for r in spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert sum(files) == 95 and len(files) == 10 and max(files) < 30 and per_trigger == 3
    log = stream_upsert(file_stream(spark, path, df.schema, files_per_trigger=per_trigger), scratch_path(spark, "land-table"), ["url"], ["id"],
                        checkpoint=scratch_path(spark, "land-ckpt"), partition_col="part", part_value=F.lit("x"))
    assert len(log) == 4
    assert N.land(df.limit(3), scratch_path(spark, "land-few"), ["id"]) == 1


class _Landed(Exception):
    pass


def _landing_files(spark, monkeypatch, query):
    """(rows, files, files a trigger takes) of what a stream query lands."""
    from monthcast.plans import catalog, catalog_ml
    from monthcast.streaming import news_stream as N
    monkeypatch.setattr(N, "FILE_ROWS", 20)

    def landed(df, path, *args, **options):
        per_trigger = N.land(df, path, *args, **options)
        raise _Landed(df.count(), len(spark.read.format(options.get("fmt", "parquet")).load(path).inputFiles()), per_trigger)

    monkeypatch.setattr(catalog_ml, "land", landed)
    with pytest.raises(_Landed) as e:
        catalog.queries()[query](spark, "/root/testdata/sf0.001")
    return e.value.args


def test_first_seen_lands_more_files_for_more_rows(spark, monkeypatch):
    rows, files, per_trigger = _landing_files(spark, monkeypatch, "stream_first_seen")
    assert rows > 80 and files >= 0.7 * rows / 20 and per_trigger == -(-(-(-rows // 20)) // 4)


@pytest.mark.parametrize("query", ["stream_monthly_counts", "stream_window_counts", "stream_distinct_sources"])
def test_counting_streams_land_more_files_for_more_rows(spark, monkeypatch, query):
    rows, files, per_trigger = _landing_files(spark, monkeypatch, query)
    batches = 3 if query == "stream_distinct_sources" else 4
    assert rows > 80 and files >= 0.6 * rows / 20 and per_trigger == -(-(-(-rows // 20)) // batches)


def test_payload_stream_lands_more_files_for_more_rows(spark, monkeypatch):
    rows, files, per_trigger = _landing_files(spark, monkeypatch, "stream_payload_upsert")
    assert rows > 80 and files >= 0.6 * rows / 20 and per_trigger == -(-(-(-rows // 20)) // 4)
