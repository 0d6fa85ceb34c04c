from monthcast.plans import standins as SI
from monthcast.plans.workflow import RunInputs, run_all
from monthcast.session import scratch_path
from tests.conftest import SF


def test_run_all_stages(spark):
    out = scratch_path(spark, "workflow-test")
    inputs = RunInputs(series=SI.price_series(spark, SF), indicators=SI.indicators(spark, SF),
                       raw_news_batch=SI.raw_news(spark, SF), lexicon=SI.lexicon(spark),
                       keywords=SI.STANDIN_KEYWORDS, sentiment_rules=SI.sentiment_rules(),
                       news_seq=["seen_date", "doc_id"], id_col="doc_id")
    res = run_all(spark, inputs, out, batch_id="b1", candidates=["logistic_regression"])
    assert res["rows"]["model_table"] > 18
    assert res["upsert"]["changed"] == res["rows"]["raw_news"]
    p = res["prediction"]
    assert abs(p["proba_low"] + p["proba_medium"] + p["proba_high"] - 1.0) < 1e-6
    again = run_all(spark, inputs, out, batch_id="b2", candidates=["logistic_regression"])
    assert again["upsert"]["changed"] == 0
    assert spark.read.parquet(f"{out}/clean_news").count() == res["rows"]["clean_news"]
