from pyspark.sql import functions as F

from monthcast.functions.text import boolean_text_filter, clean_text, contains_keyword, keyword_flags, text_length


# Written by hand from the rule: lower-case; a URL runs to the next white space; what is not a-z, 0-9 or a hyphen parts words.
EXPECTED = [
    ("See HTTP://X.com/a next", "see next"), ("See HTTP://X.com/a\u00a0next", "see next"), ("İstanbul prices", "i stanbul prices"),
    ("a_b-c", "a b-c"), ("https://a.b", ""), (None, ""), ("", ""), ("  Multiple   spaces\tand\nlines  ", "multiple spaces and lines"),
    ("Chips: DRAM & NAND -- up 10%!", "chips dram nand -- up 10"), ("don't stop", "don t stop"),
    ("xhttp://y z", "x z"), ("httpx only", "only"),
    ("=" * 200_000, ""), ("a" + "=" * 200_000 + "b", "a b"), ("слово " * 40_000, ""), ("価格" * 100_000 + " up", "up"),
    (" \n" * 100_000 + "x", "x"), ("https://h/" + "p" * 200_000 + " tail", "tail"), ("ab" * 100_000, "ab" * 100_000),
    ("Привет world 価格 rise", "world rise"),
]


def test_clean_text_by_hand(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(EXPECTED)], "i int, t string")
    got = {r["i"]: r["c"] for r in df.select("i", clean_text("t").alias("c")).collect()}
    for i, (t, want) in enumerate(EXPECTED):
        assert got[i] == want, (t and t[:40], got[i][:40])


def test_clean_text_examples(spark):
    df = spark.createDataFrame([("See HTTP://X.com/a next",)], "t string")
    assert df.select(clean_text("t")).first()[0] == "see next"


def test_keyword_is_substring(spark):
    df = spark.createDataFrame([("new program launched",), ("no match",), (None,)], "t string")
    got = [r[0] for r in df.select(contains_keyword("t", "ram")).collect()]
    assert got == [1, 0, 0]


def test_keyword_flag_names(spark):
    df = spark.createDataFrame([("supply chain shortage",)], "t string")
    flags = keyword_flags("t", ["supply chain", "tariff"])
    row = df.select(*[v.alias(k) for k, v in flags.items()]).first().asDict()
    assert row == {"kw_supply_chain": 1, "kw_tariff": 0}


def test_length_in_code_points(spark):
    df = spark.createDataFrame([("héllo",), ("",), ("\U0001F600",)], "t string")
    assert [r[0] for r in df.select(text_length("t")).collect()] == [5, 0, 1]


def test_boolean_filter_whole_words(spark):
    df = spark.createDataFrame([("chip prices rise",), ("chips supply",), ("memory shortage",), ("pricey chip",)],
                               "t string")
    cond = boolean_text_filter("t", ["chip", "memory"], ["prices", "shortage"])
    assert [r[0] for r in df.where(cond).collect()] == ["chip prices rise", "memory shortage"]
