"""Decontamination, substring dedup and n-gram join against brute force."""
import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from monthcast.llm import components, decontaminate, ngram_join, queries, substring_dedup

from .conftest import SCHEMA, SF

WHITE = re.compile("[^\x20\x09-\x0d]+")


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def shingles(words):
    return {tuple(words[i: i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def pairs_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


# ------------------------------------------------------------ decontamination

def brute_items(docs, items):
    out = set()
    words = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    for d, t in docs:
        have = shingles(words.findall((t or "").lower()))
        for i, x in items:
            want = shingles(words.findall((x or "").lower()))
            if want and 10 * len(have & want) >= 8 * len(want):
                out.add((d, i, len(have & want), len(want)))
    return out


def check_items(spark, docs, items, **options):
    found = decontaminate.find_items(docs, items, **options).collect()
    got = [(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in found]
    want = brute_items(pairs_of(docs), [(r.item_id, r.text) for r in items.collect()])
    assert sorted(set(got), key=str) == sorted(want, key=str) and all(0.8 <= r.containment <= 1 for r in found)
    return want


def test_decontamination(spark, edges, nothing):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert check_items(spark, spark.read.parquet(f"{SF}/documents.parquet"), items)
    rng = random.Random(3)
    some = [r.text for r in edges.where("length(text) > 100").limit(8).collect()]
    own = []
    for t in some:
        w = t.split()
        own.append(" ".join(w[3:40]))
        v = w[3:60]
        v[rng.randrange(len(v))] = "other"
        own.append(" ".join(v).upper() + ".")
    own += ["x", "", None, "a b", own[0], own[0]]
    items = spark.createDataFrame([(i, t, "c", 1) for i, t in enumerate(own)], "item_id long, text string, doc_key string, hash int")
    want = check_items(spark, edges, items)
    assert len(want) > 10 and check_items(spark, edges, items, block=40) == want
    assert check_items(spark, nothing, items) == set() and check_items(spark, edges, items.limit(0)) == set()
    bad = {d for d, *_ in want}
    kept = decontaminate.decontaminated(edges, items)
    assert kept.columns == edges.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((r.doc_id for r in edges.collect() if r.doc_id not in bad or r.doc_id is None), key=str) or None in bad


def test_short_items_in_long_documents(spark):
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(5000)]
    long = [rng.choice(vocabulary) for _ in range(30_000)]
    item = [rng.choice(vocabulary) for _ in range(20)]
    docs = table(spark, [" ".join(long[:20_000] + item + long[20_000:]), " ".join(long), " ".join(item[:17])])
    items = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    assert {d for d, *_ in check_items(spark, docs, items)} == {0, 2}


def test_items_of_few_words_in_long_documents(spark):
    rng = random.Random(11)
    vocabulary = [f"v{i}" for i in range(60)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 200))) for _ in range(40)]
    texts += ["v1", "v2 v3", "v4 v5 v6 v7", "v4 v5 v6 v7 v8", "", "a V9, v10 b"]
    items = ["v1", "v2 v3", "V9 v10", "v4 v5 v6", "v4 v5 v6 v7", "v4 v5 v6 v7 v8", "nowhere", "v1 v1", "", None, "v1"]
    docs = table(spark, texts)
    item_rows = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    words = [re.findall("[a-z0-9]+", t.lower()) for t in texts]
    want = set()
    for i, x in enumerate(items):
        w = re.findall("[a-z0-9]+", (x or "").lower())
        want |= {(d, i) for d, v in enumerate(words) if w and any(v[k: k + len(w)] == w for k in range(len(v)))}
    for options in ({}, {"block": 3}):
        found = decontaminate.find_items(docs, item_rows, **options).collect()
        assert sorted((r.doc_id, r.item_id) for r in found) == sorted(want)
        assert all((r.n_shared, r.n_item, r.containment) == (1, 1, 1.0) for r in found)
    bad = {d for d, _ in want}
    kept = decontaminate.decontaminated(docs, item_rows)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(range(len(texts))) - bad)


# ------------------------------------------------------------ substring dedup

def brute_dedup(docs, length=50):
    first = {}
    order = lambda d: (d is None, d or 0)
    words = [(d, WHITE.findall(t or "")) for d, t in docs]
    for d, w in words:
        for i in range(len(w) - length + 1):
            k = tuple(w[i: i + length])
            first[k] = min(first.get(k, (True, 1)), order(d))
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - length + 1):
            if first[tuple(w[i: i + length])] < order(d):
                gone.update(range(i, i + length))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def got_dedup(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=str)


def test_substring_dedup(spark, edges, nothing):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute_dedup(pairs_of(docs))
    assert sum(n for _, _, n, _ in want) > 0
    assert got_dedup(queries.op7_substring_dedup(spark, "/root/testdata/sf0.01")) == want
    # every path: shards of one class, and windows one by one
    want = brute_dedup(pairs_of(edges))
    for options in ({}, {"max_classes": 1}, {"shard_classes": 3}, {"gram": 49}):
        assert got_dedup(substring_dedup.substring_dedup(edges, **options)) == want
    assert got_dedup(substring_dedup.substring_dedup(nothing)) == []


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_substring_dedup_on_few_words(spark, seed):
    """Few different words and short windows: many repeats and ties."""
    rng = random.Random(seed)
    texts = []
    for _ in range(40):
        t = [rng.choice("ab") for _ in range(rng.randint(0, 30))]
        texts.append(" ".join(t + (texts[rng.randrange(len(texts))].split()[:9] if texts else [])))
    docs = table(spark, texts)
    want = brute_dedup(pairs_of(docs), 6)
    for options in ({}, {"max_classes": 2}, {"shard_classes": 2}):
        assert got_dedup(substring_dedup.substring_dedup(docs, length=6, gram=3, **options)) == want


# --------------------------------------------------------------- n-gram join

def brute_join(docs):
    sets = [shingles(WHITE.findall(lower(t))) for _, t in docs]
    holders = defaultdict(set)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].add(i)
    root, links = list(range(len(docs))), [0] * len(docs)

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in enumerate(sets):
        for j in set().union(*(holders[x] for x in s)) if s else ():
            if j != i:
                both = len(s & sets[j])
                if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                    links[i] += 1
                    root[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return sorted(((d, len(sets[i]), least.get(top(i)) if sets[i] else d, links[i]) for i, (d, _) in enumerate(docs)), key=str)


def got_join(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in df.collect()), key=str)


def test_ngram_join(spark, edges, nothing):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute_join(pairs_of(docs))
    assert sum(n for *_, n in want) > 100
    assert got_join(queries.op9_ngram_join(spark, "/root/testdata/sf0.01")) == want
    want = brute_join(pairs_of(edges))
    for options in ({}, {"group_rows": 1, "query_rows": 1}, {"group_rows": 3, "query_rows": 2, "frequent_least": 1, "frequent_share": 0.0},
                    {"frequent_least": 10**9}):
        assert got_join(ngram_join.ngram_join(edges, **options)) == want, options
    assert got_join(ngram_join.ngram_join(nothing)) == []


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_join_near_the_bound(spark, seed):
    """Chains of edited copies, whose likeness lies about 0.8."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(6):
        now = [rng.choice(vocabulary) for _ in range(rng.randint(5, 120))]
        for _ in range(12):
            texts.append(" ".join(now))
            now = list(now)
            for _ in range(rng.randint(0, 3)):
                now[rng.randrange(len(now))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                now += [rng.choice(vocabulary) for _ in range(rng.randint(1, 10))]
    rng.shuffle(texts)
    docs = table(spark, texts)
    want = brute_join(pairs_of(docs))
    for options in ({}, {"group_rows": 4, "query_rows": 3}):
        assert got_join(ngram_join.ngram_join(docs, **options)) == want


def test_one_of_each(spark, edges):
    one = edges.where("doc_id is not null").dropDuplicates(["doc_id"])
    kept = ngram_join.one_of_each(one)
    assert kept.columns == one.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for d, n, c, _ in brute_join(pairs_of(one))})


def test_one_of_each_with_null_and_repeated_ids(spark, edges):
    rng = random.Random(9)
    a, b, c = ([f"{x}{rng.randrange(10**6)}" for _ in range(60)] for x in "abc")
    near = lambda w, i: " ".join([*w[:-1], f"end{i}"])
    rows = [(None, near(a, i % 3), "s") for i in range(30)]                             # a hot null id
    rows += [(5, near(b, i), "s") for i in range(3)] + [(5, near(b, 0), f"s{i}") for i in range(8)]  # one id, several texts, repeats
    rows += [(5, near(c, 0), "s"), (None, near(c, 0), "s"), (7, near(c, 1), "s")]       # the same id in another component
    rows += [(None, "", "s"), (8, None, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    for options in ({}, {"hot_keys": 4}, {"hot_keys": 0}):
        kept = ngram_join.one_of_each(docs, **options)
        assert kept.columns == docs.columns
        got = [tuple(r) for r in kept.collect()]
        assert sorted(((d, (t or " ")[0]) for d, t, _ in got), key=str) == [(5, "b"), (5, "c"), (8, " "), (None, " "), (None, "a")], options
        assert set(got) <= set(rows)
        assert sorted(got, key=str) == sorted((tuple(r) for r in ngram_join.one_of_each(docs.repartition(7), **options).collect()), key=str)
    # null ids and repeated rows left in: as many rows as components, and each row without words
    texts = [(i, t) for i, (_, t) in enumerate(pairs_of(edges))]
    want = sorted(c for c in {(c, n == 0) for _, n, c, _ in brute_join(texts)})
    assert ngram_join.one_of_each(edges).count() == len(want)


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(70)] + [(5, 2000 + i) for i in range(50)]
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    alone = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: top(x) for x in root if x not in alone}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_schema_has_clashing_names():
    assert "_salt" in SCHEMA and F is not None
