"""``python -m monthcast <sf_dir> <out_root>``: run every stage on the
stand-in roles of the driver's tables and print the summary."""

from __future__ import annotations

import json
import sys
import uuid

from .plans import standins as SI
from .plans.workflow import RunInputs, run_all
from .session import get_session


def main(argv: list[str]) -> None:
    sf_dir, out_root = argv[0], argv[1]
    spark = get_session(profile="cluster")
    spark.sparkContext.setLogLevel("ERROR")
    raw = SI.raw_news(spark, sf_dir)
    inputs = RunInputs(series=SI.price_series(spark, sf_dir), indicators=SI.indicators(spark, sf_dir),
                       raw_news_batch=raw, lexicon=SI.lexicon(spark), keywords=SI.STANDIN_KEYWORDS,
                       sentiment_rules=SI.sentiment_rules(), news_seq=["seen_date", "doc_id"], id_col="doc_id")
    result = run_all(spark, inputs, out_root, batch_id=uuid.uuid4().hex)
    print(json.dumps(result, default=str))


if __name__ == "__main__":
    main(sys.argv[1:])
