import datetime as dt

import pytest

from monthcast import schemas
from monthcast.functions.dates import parse_timestamps
from monthcast.operators import news as N
from monthcast.operators.sentiment import lexicon_frame


def raw_rows(spark, rows):
    full = [tuple(r.get(c) for c in schemas.RAW_NEWS.fieldNames()) for r in rows]
    return spark.createDataFrame(full, schemas.RAW_NEWS)


def test_parse_every_known_format(spark):
    vals = ["2023-01-05T10:00:00Z", "2024-01-05 10:00:00", "20240105T101500Z", "2024-01-05T10:00:00.123Z",
            "2024-01-05T12:00:00+02:00", "bad", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(parse_timestamps("s")).collect()]
    assert got == [dt.datetime(2023, 1, 5, 10), dt.datetime(2024, 1, 5, 10), dt.datetime(2024, 1, 5, 10, 15),
                   dt.datetime(2024, 1, 5, 10, 0, 0, 123000), dt.datetime(2024, 1, 5, 10), None, None]


def test_dedup_happens_before_language_filter(spark):
    rows = [dict(title="T", url="u", seen_date="2024-01-01T00:00:00Z", language="fr", source="s"),
            dict(title="T", url="u", seen_date="2024-01-01T00:00:00Z", language="en", source="s")]
    # same (title, url, published_at); first by seen_date then other columns: 'en' < 'fr' wins
    out = N.clean_news(raw_rows(spark, rows)).collect()
    assert len(out) == 1 and out[0]["language"] == "en"
    rows[0]["seen_date"] = "2024-01-01T00:00:00+00:00"  # sorts first, same instant: 'fr' is kept
    out = N.clean_news(raw_rows(spark, rows)).collect()
    assert out == []


def test_clean_news_columns_and_filters(spark):
    rows = [dict(title="Chip Prices UP!", url="a", seen_date="20240105T101500Z", language=None, source=None),
            dict(title="x", url="b", seen_date="not a date", language="en"),
            dict(title=None, url="c", seen_date="2024-02-01T00:00:00Z", language="English")]
    out = {r["url"]: r for r in N.clean_news(raw_rows(spark, rows)).collect()}
    assert set(out) == {"a", "c"}
    assert out["a"]["clean_text"] == "chip prices up" and out["a"]["source"] == ""
    assert out["a"]["month"] == dt.date(2024, 1, 1) and out["a"]["title_len"] == 15
    assert out["c"]["title"] == "" and out["c"]["title_len"] == 0


def test_monthly_features_and_zero_fill(spark):
    rows = [dict(title="strong growth", url="a", seen_date="2024-01-05T00:00:00Z", language="en", source="s1"),
            dict(title="weak demand", url="b", seen_date="2024-01-06T00:00:00Z", language="en", source=""),
            dict(title="ram program", url="c", seen_date="2024-03-01T00:00:00Z", language="en", source="s1")]
    clean = N.clean_news(raw_rows(spark, rows))
    feats = {r["month"]: r for r in N.monthly_news_features(clean, lexicon_frame(spark), ["ram", "growth"]).collect()}
    jan = feats[dt.date(2024, 1, 1)]
    assert jan["article_count"] == 2 and jan["unique_sources"] == 2
    assert jan["negative_share"] == pytest.approx(0.5)
    assert jan["kw_growth"] == 1 and feats[dt.date(2024, 3, 1)]["kw_ram"] == 1
    assert dt.date(2024, 2, 1) not in feats


def test_keep_first_is_deterministic_under_ties(spark):
    df = spark.createDataFrame([("k", 1, "b"), ("k", 1, "a"), ("k", 2, "0")], "k string, o int, p string")
    out = N.keep_first(df, ["k"], ["o"]).collect()
    assert [(r["k"], r["o"], r["p"]) for r in out] == [("k", 1, "a")]


def test_approx_sources_option(spark):
    rows = [dict(title=f"t{i}", url=f"u{i}", seen_date="2024-01-05T00:00:00Z", language="en", source=f"s{i % 7}")
            for i in range(50)]
    clean = N.clean_news(raw_rows(spark, rows))
    exact = N.monthly_news_features(clean, lexicon_frame(spark), ["t"]).first()["unique_sources"]
    approx = N.monthly_news_features(clean, lexicon_frame(spark), ["t"], approx_sources=True).first()["unique_sources"]
    assert exact == 7 and abs(approx - 7) <= 1


def test_keys_with_nulls_in_different_parts_stay_apart(spark):
    df = spark.createDataFrame([("a", None, 2), (None, "a", 1), ("a", None, 1), (None, None, 5), ("a", "a", 3), ("", "a", 4)],
                               "k1 string, k2 string, o int")
    want = {("a", None): (1, 2), (None, "a"): (1, 1), (None, None): (5, 5), ("a", "a"): (3, 3), ("", "a"): (4, 4)}
    for pick, at in ((N.keep_first, 0), (N.keep_last, 1)):
        assert {(r.k1, r.k2): r.o for r in pick(df, ["k1", "k2"], ["o"]).collect()} == {k: v[at] for k, v in want.items()}


def test_timestamp_rejects_are_counted(spark):
    raw = spark.createDataFrame([("2024-01-05 10:00:00",), ("bad",), (None,), ("",), ("20240105T101500Z",)], "seen_date string")
    assert N.timestamp_rejects(raw).collect() == [(5, 3, 2)]
