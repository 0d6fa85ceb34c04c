"""Plan-shape guards over the whole catalogue: no cartesian products or
nested-loop joins anywhere (every join is an equi-join)."""

import pytest

from tests.conftest import SF

HEAVY = {"logistic_regression_scores", "gradient_boosting_scores", "latest_prediction", "stream_news_upsert",
         "stream_window_counts", "stream_payload_upsert", "stream_monthly_counts"}


def _names():
    from monthcast.plans import catalog as E
    return sorted(k for k in E.queries() if k not in HEAVY)


@pytest.mark.parametrize("name", _names())
def test_no_nested_loop_or_cartesian(spark, name):
    from monthcast.plans import catalog as E
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name


def test_per_window_cap_is_limited_before_shuffle(spark):
    from monthcast.plans import catalog as E
    plan = E.queries()["topk_per_window"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_recent_articles_is_top_k(spark):
    from monthcast.plans import catalog as E
    plan = E.queries()["recent_articles"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
