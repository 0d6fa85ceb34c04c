import pytest

from tests.conftest import SF

FAST = ["feature_table", "series_features", "monthly_news_features", "upsert_merge", "recent_articles",
        "classification_report", "json_payload_flatten", "window_assign_range_join", "lexicon_sentiment"]


def test_registry_consistent():
    import __spark_entry__ as E
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 60


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "target_class" in df.columns


@pytest.mark.parametrize("name", FAST)
def test_query_runs_at_smoke_scale(spark, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, SF)
    assert df.count() >= 0
