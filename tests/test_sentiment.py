import math

import pytest

from monthcast.config import (BOOSTER_DAMPING, BOOSTER_INCREMENT, COMPOUND_ALPHA, CONTRAST_AFTER,
                              CONTRAST_BEFORE, NEGATION_SCALAR)
from monthcast.operators import sentiment as S

LEX = {"good": 1.9, "bad": -2.5, "surge": 1.9, "no": -1.2}
UP, DOWN, NEG = ["very"], ["slightly"], ["not", "never"]


def brute(text, lex=LEX):
    toks = text.split(" ") if text else [""]
    contrast = toks.index("but") if "but" in toks else -1
    total, hits = 0.0, 0
    for i, t in enumerate(toks):
        if t not in lex:
            continue
        hits += 1
        v = lex[t]
        for k in (1, 2, 3):
            if i - k < 0:
                continue
            p = toks[i - k]
            if p in lex:
                continue
            b = BOOSTER_INCREMENT if p in UP else (-BOOSTER_INCREMENT if p in DOWN else 0.0)
            b = (-b if v < 0 else b) * BOOSTER_DAMPING[k - 1]
            v = (v + b) * (NEGATION_SCALAR if p in NEG else 1.0)
        if contrast >= 0:
            v *= CONTRAST_BEFORE if i < contrast else (CONTRAST_AFTER if i > contrast else 1.0)
        total += v
    if hits == 0:
        return 0.0
    s = total / math.sqrt(total * total + COMPOUND_ALPHA)
    return round(max(-1.0, min(1.0, s)), 4)


TEXTS = ["good", "very good", "not good", "not very good", "slightly bad", "good but bad", "bad but good",
         "no good", "never slightly very surge", "", "nothing here", "good good good good good",
         "very very very bad", "the market is not so good but the outlook is very good"]


def test_matches_brute_force(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id long, t string")
    lex = spark.createDataFrame(list(LEX.items()), "token string, valence double")
    out = S.score_texts(df, "t", "id", lex, boosters_up=UP, boosters_down=DOWN, negators=NEG)
    got = {r["id"]: r["sentiment"] for r in out.collect()}
    single_pass = S.score_all(df, "t", "id", lex, boosters_up=UP, boosters_down=DOWN, negators=NEG)
    got_all = {r["id"]: r["sentiment"] for r in single_pass.collect()}
    assert len(got_all) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        assert got[i] == pytest.approx(brute(t), abs=1e-4), t
        assert got_all[i] == got[i], t
        assert -1.0 <= got[i] <= 1.0


def test_no_hits_score_zero(spark):
    df = spark.createDataFrame([(1, "nothing to see")], "id long, t string")
    out = S.score_texts(df, "t", "id", S.lexicon_frame(spark))
    assert out.first()["sentiment"] == 0.0


def test_null_texts_repeated_words_and_large_lexicons(spark):
    """Null and empty texts score 0.0; a lexicon word given twice counts twice
    as a hit of each row, as in a join; thousands of words change nothing."""
    df = spark.createDataFrame([(0, None), (1, ""), (2, "good"), (3, "w17 very w17 good")], "id long, t string")
    plain = spark.createDataFrame(list(LEX.items()), "token string, valence double")
    many = plain.unionByName(spark.createDataFrame([(f"w{i}", 0.0) for i in range(6000)] + [(None, 1.0)], "token string, valence double"))
    rules = dict(boosters_up=UP, boosters_down=DOWN, negators=NEG)
    got = {r.id: r.sentiment for r in S.score_all(df, "t", "id", many, **rules).collect()}
    assert got[0] == got[1] == 0.0 and got[2] == brute("good")
    # lexicon words among the predecessors neither boost nor negate
    assert got[3] == pytest.approx(brute("w17 very w17 good", LEX | {"w17": 0.0}), abs=1e-4)
    twice = S.score_all(df, "t", "id", plain.unionByName(plain), **rules).where("id = 2").first().sentiment
    assert twice == round(3.8 / math.sqrt(3.8 ** 2 + COMPOUND_ALPHA), 4)
    assert S.score_all(df, "t", "id", plain.limit(0), **rules).where("sentiment = 0").count() == 4


def test_too_large_a_lexicon_is_an_error(spark):
    df = spark.createDataFrame([(0, "good")], "id long, t string")
    big = spark.range(S.MAX_LEXICON + 1).selectExpr("cast(id as string) token", "1.0D valence")
    with pytest.raises(ValueError, match="lexicon"):
        S.score_all(df, "t", "id", big)


def test_no_token_is_shuffled(spark):
    """Also with an in-memory lexicon the only exchange is that of the final
    aggregate, by text, and joins are broadcast."""
    df = spark.range(1000).selectExpr("id", "concat('good very bad ', id) t")
    for lex in (S.lexicon_frame(spark), spark.range(30000).selectExpr("cast(id as string) token", "1.0D valence")):
        out = S.score_all(df, "t", "id", lex)
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        plan = plan[plan.index("== Final Plan =="): plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
        exchanges = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
        assert len(exchanges) <= 1 and all("hashpartitioning(id#" in x for x in exchanges), plan
        assert "SortMergeJoin" not in plan and "Exchange hashpartitioning(tok" not in plan and "Generate" in plan


def test_a_users_scorer_takes_the_place_of_the_rules(spark):
    """The rules as a plain Python scorer give the built-in scores on every
    row; it is made once a task and never gets more than a batch."""
    from pyspark.sql import functions as F

    texts = (TEXTS + [None]) * 40
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, t string").repartition(3)

    def make():
        made = []

        def score(part):
            assert len(part) <= 7 and not made or made[0] is score
            made.append(score)
            return [brute(t) for t in part]
        return score

    lex = spark.createDataFrame(list(LEX.items()), "token string, valence double")
    want = {r.id: r.sentiment for r in S.score_all(df, "t", "id", lex, boosters_up=UP, boosters_down=DOWN, negators=NEG).collect()}
    got = {r.id: r.sentiment for r in S.score_with(df, "t", make, batch=7).collect()}
    assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i], abs=1e-4) for i in want)
    with pytest.raises(Exception, match="scores for"):
        S.score_with(df, "t", lambda: lambda part: [0.0]).agg(F.sum("sentiment")).collect()


def test_monthly_features_with_a_users_scorer(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from monthcast.operators import news as N
    rows = [(i, t or "", t, dt.date(2024, 1 + i % 2, 1), len(t or ""), "s") for i, t in enumerate(TEXTS)]
    clean = spark.createDataFrame(rows, "id long, title string, clean_text string, month date, title_len int, source string")
    lex = spark.createDataFrame(list(LEX.items()), "token string, valence double")
    rules = dict(boosters_up=UP, boosters_down=DOWN, negators=NEG)
    one = N.monthly_news_features(clean, lex, ["the"], id_col="id", **rules).orderBy("month").collect()
    two = N.monthly_news_features(clean, lex, ["the"], id_col="id", make_scorer=lambda: lambda part: [brute(t) for t in part], **rules)
    assert two.orderBy("month").collect() == one
    approx = N.monthly_news_features(clean, lex, ["the"], id_col="id", approx_sources=True, **rules)
    assert approx.select(F.sum("unique_sources")).first()[0] == 2
