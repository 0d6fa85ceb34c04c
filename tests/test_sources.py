import datetime as dt
import json

from pyspark.sql import functions as F

from monthcast import schemas
from monthcast.sources import calendar as CAL
from monthcast.sources import payloads as P
from monthcast.sources.series import clean_series, table_guard


def payload_df(spark, docs):
    return spark.createDataFrame([(json.dumps(d),) for d in docs], "payload string")


def test_gdelt_flatten(spark):
    doc = {"window_start": "2024-01-01", "window_end": "2024-01-31",
           "articles": [{"title": "T", "url": "u", "domain": "d.com", "language": "English",
                         "seendate": "20240105T101500Z", "socialimage": "i", "sourcecountry": "US"}]}
    r = P.flatten_gdelt(payload_df(spark, [doc])).first().asDict()
    assert r["provider"] == "gdelt" and r["source"] == "d.com" and r["seen_date"] == "20240105T101500Z"


def test_guardian_nested_field_and_constants(spark):
    doc = {"response": {"pages": 1, "results": [
        {"webTitle": "A", "webUrl": "u1", "webPublicationDate": "2024-01-02T00:00:00Z", "fields": {"thumbnail": "t"}},
        {"webTitle": "B", "webUrl": "u2", "webPublicationDate": "2024-01-03T00:00:00Z"}]}}
    rows = {r["url"]: r for r in P.flatten_guardian(payload_df(spark, [doc])).collect()}
    assert rows["u1"]["social_image"] == "t" and rows["u2"]["social_image"] is None
    assert rows["u1"]["source"] == "The Guardian" and rows["u1"]["language"] == "en"


def test_newsapi_error_screen_and_source_fallback(spark):
    ok = {"status": "ok", "articles": [{"title": "A", "url": "u", "publishedAt": "x",
                                        "source": {"id": "sid", "name": ""}}]}
    err = {"status": "error", "message": "rate", "articles": [{"title": "B", "url": "v"}]}
    rows = P.flatten_newsapi(payload_df(spark, [ok, err])).collect()
    assert [(r["url"], r["source"]) for r in rows] == [("u", "sid")]


def test_newsdata_country_list_or_scalar(spark):
    doc = {"status": "success", "results": [
        {"title": "A", "link": "u1", "source_id": None, "source_name": "N", "language": "", "country": ["us", "gb"]},
        {"title": "B", "link": "u2", "source_id": "s", "language": "fr", "country": "de"}]}
    rows = {r["url"]: r for r in P.flatten_newsdata(payload_df(spark, [doc])).collect()}
    assert rows["u1"]["source_country"] == "us,gb" and rows["u2"]["source_country"] == "de"
    assert rows["u1"]["source"] == "N" and rows["u1"]["language"] == "en" and rows["u2"]["language"] == "fr"


def test_month_windows_and_assignment_agree(spark):
    bounds = spark.createDataFrame([(dt.date(2023, 11, 15), dt.date(2024, 2, 3))], "start date, end date")
    w = CAL.month_windows(bounds).orderBy("window_start").collect()
    assert [(r["window_start"], r["window_end"]) for r in w][0] == (dt.date(2023, 11, 1), dt.date(2023, 11, 30))
    assert len(w) == 4 and w[3]["window_end"] == dt.date(2024, 2, 29)
    arts = spark.createDataFrame([(1, dt.datetime(2023, 11, 30, 23, 59)), (2, dt.datetime(2024, 2, 29, 12)),
                                  (3, dt.datetime(2025, 1, 1))], "id int, published_at timestamp_ntz")
    windows = CAL.month_windows(bounds)
    a = sorted((r["id"], r["window_start"]) for r in CAL.assign_windows_range(arts, windows).collect())
    b = sorted((r["id"], r["window_start"]) for r in CAL.assign_month_windows(arts, windows).collect())
    assert a == b == [(1, dt.date(2023, 11, 1)), (2, dt.date(2024, 2, 1))]


def test_caps(spark):
    rows = [("w1", dt.datetime(2024, 1, d), f"u{d}") for d in range(1, 11)] + [("w2", dt.datetime(2024, 2, 1), "z")]
    df = spark.createDataFrame(rows, "window_start string, published_at timestamp_ntz, url string")
    capped = CAL.cap_per_window(df, 3)
    assert sorted(r["url"] for r in capped.where(F.col("window_start") == "w1").collect()) == ["u10", "u8", "u9"]
    assert capped.count() == 4
    assert CAL.per_window_cap(50, 3) == 150 and CAL.per_window_cap(80, 1) == 50
    assert [r["url"] for r in CAL.cap_recent(df, 2).collect()] == ["z", "u10"]


def test_series_scan_by_position(spark):
    df = spark.createDataFrame([("2020-01-01", "1.5"), ("bad", "2"), ("2020-02-01", "."), ("2020-03-01", "3")],
                               "observation_date string, SERIES string")
    out = clean_series(df, "ppi_value").orderBy("date").collect()
    assert [(r["date"], r["ppi_value"]) for r in out] == [(dt.date(2020, 1, 1), 1.5), (dt.date(2020, 3, 1), 3.0)]


def test_table_guard(spark):
    df = spark.range(5)
    g = table_guard(df, "t", min_rows=19).first()
    assert g["rows"] == 5 and g["ok"] is False


def test_read_or_empty_and_exports(spark, tmp_path):
    from monthcast import schemas
    from monthcast.sinks.tables import export_csv, export_json
    from monthcast.sources.tables import read_feature_table, read_metrics_json, read_or_empty
    missing = read_or_empty(spark, str(tmp_path / "nope"), schemas.SERIES)
    assert missing.count() == 0 and missing.columns == ["date", "ppi_value"]
    df = spark.createDataFrame([("2020-02-01", 2.0), ("2020-01-01", 1.0)], "month string, v double")
    export_csv(df, str(tmp_path / "mt"))
    back = read_feature_table(spark, str(tmp_path / "mt"), fmt="csv").collect()
    assert [r["month"] for r in back] == [dt.date(2020, 1, 1), dt.date(2020, 2, 1)]
    export_json(df, str(tmp_path / "js"))
    assert read_metrics_json(spark, str(tmp_path / "js")).count() == 2


def test_named_series_layout(spark, tmp_path):
    from monthcast.sources.series import read_named_series
    p = tmp_path / "g.csv"
    p.write_text("Date,GSCPI,Other\n2020-01-31,0.5,x\n2020-02-29,-1.2,y\nbad,1,z\n")
    out = read_named_series(spark, str(p), "Date", "GSCPI", "gscpi").orderBy("date").collect()
    assert [(r["date"], r["gscpi"]) for r in out] == [(dt.date(2020, 1, 31), 0.5), (dt.date(2020, 2, 29), -1.2)]


def test_payload_rejects(spark):
    texts = ['{"status": "ok", "articles": []}', '{"status": "error", "message": "no"}', '{"status": "error"', "", None, "[]x", '{"articles": []}']
    df = spark.createDataFrame([(t,) for t in texts], "payload string")
    got = P.reject_counts(df, schemas.NEWSAPI_PAYLOAD).first()
    assert (got.payloads, got.corrupt, got.errors, got.kept) == (7, 4, 1, 2)


def test_metrics_json_keeps_every_record_of_a_file(spark, tmp_path):
    from monthcast.sinks.tables import export_json
    from monthcast.sources.tables import read_metrics_json
    rows = [("m", "f1", "low", 0.5), ("m", "f1", None, None), ("n", "f1", "low", 0.25)]
    export_json(spark.createDataFrame(rows, schemas.METRICS).coalesce(1), str(tmp_path / "m"))
    assert sorted(map(tuple, read_metrics_json(spark, str(tmp_path / "m")).collect()), key=str) == sorted(rows, key=str)


def test_unreadable_table_is_not_an_empty_one(spark, tmp_path):
    import pytest
    from monthcast.sources.tables import read_or_empty
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "part.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        read_or_empty(spark, str(tmp_path / "t"), schemas.SERIES).collect()
