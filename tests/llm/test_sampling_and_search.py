"""Importance resampling, spelling variants and nearest neighbours."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from monthcast.llm import importance, nearest, spelling


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute_features(text, max_n):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))
    return len(words), [" ".join(words[i: i + n]) for n in range(1, max_n + 1) for i in range(len(words) - n + 1)]


def brute_resample(docs, target, max_n, buckets, seed, percent, least):
    def counts(texts):
        c = Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in brute_features(t, max_n)[1])
        return c, sum(c.values())

    (s, s_all), (t, t_all) = counts([x for _, x in docs]), counts(target)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    out = []
    for i, text in docs:
        n_words, f = brute_features(text, max_n)
        weight = sum(gain[zlib.crc32(x.encode()) % buckets] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n_words, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))])
    able = [r for r in out if r[1] >= least]
    able.sort(key=lambda r: (-r[4], r[0] is None, r[0]))
    return out, able[: percent * len(able) // 100]


@pytest.mark.parametrize("max_n,buckets,percent,least", [(1, 10_000, 10, 20), (3, 97, 60, 1), (2, 1000, 100, 0)])
def test_resampling_is_the_definition(spark, edges, max_n, buckets, percent, least):
    docs = [(r.doc_id, r.text) for r in edges.select("doc_id", "text").collect()]
    target = [t for _, t in docs[::9]] + ["été " * 40, None, ""]
    frame = spark.createDataFrame([(t, i) for i, t in enumerate(target)], "text string, score int")
    got = importance.ranked(edges, frame, max_n=max_n, buckets=buckets, percent=percent, least_words=least).collect()
    want, drawn = brute_resample(docs, target, max_n, buckets, 2024, percent, least)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r.doc_id, r.n_words, r.n_features, r.weight, r.score) for r in got), key=key) == sorted(map(tuple, want), key=key)
    ranks = sorted((r.rank, r.doc_id, r.score) for r in got if r.rank)
    assert [r[0] for r in ranks] == list(range(1, len(drawn) + 1))
    assert [(r[1], r[2]) for r in ranks] == [(r[0], r[4]) for r in drawn]
    taken = importance.resampled(edges, frame, max_n=max_n, buckets=buckets, percent=percent, least_words=least)
    assert taken.columns == edges.columns
    assert sorted((str(r.doc_id) for r in taken.collect())) == sorted(str(r[0]) for r in drawn)


def test_resampling_of_nothing(spark, nothing, edges):
    assert importance.ranked(nothing, edges).count() == 0
    assert importance.ranked(edges, nothing).where("rank is not null").count() > 0
    assert importance.resampled(nothing, nothing).count() == 0


def test_hot_rows_take_consecutive_ranks(spark):
    """A third of the rows are one row, cut in the middle by the draw."""
    rows = [(None, "a b c d")] * 300 + [(i, f"a b {i} x{i}") for i in range(600)]
    got = importance.ranked(spark.createDataFrame(rows, "doc_id long, text string").repartition(7),
                            spark.createDataFrame([("a b c",)], "text string"), least_words=1, percent=50).collect()
    assert len(got) == 900 and sorted(r.rank for r in got if r.rank) == list(range(1, 451))
    places = [r.rank for r in got if r.doc_id is None and r.rank]
    assert not places or sorted(places) == list(range(min(places), min(places) + len(places)))


def test_features_of_runs_across_texts():
    texts = pa.array(["a b a b", None, "", "b", "A-B"])
    of, bucket, words = importance.features(texts, 2, 1 << 20)
    want = Counter((i, zlib.crc32(f.encode()) % (1 << 20)) for i, t in enumerate(texts.to_pylist()) for f in brute_features(t, 2)[1])
    assert Counter(zip(of.tolist(), bucket.tolist(), strict=True)) == want and words.tolist() == [4, 0, 0, 1, 2]


def test_features_of_slices():
    """A block of a batch starts anywhere in it, as blocks in tasks do."""
    texts = pa.array([f"Wört {i} ¿Qué? " * (i % 7) if i % 11 else None for i in range(200)])
    for a, n in ((0, 200), (3, 50), (190, 10), (77, 1), (200, 0)):
        of, bucket, _ = importance.features(texts.slice(a, n), 1, 1 << 20)
        want = [(i, zlib.crc32(f.encode()) % (1 << 20)) for i, t in enumerate(texts.slice(a, n).to_pylist()) for f in brute_features(t, 1)[1]]
        assert list(zip(of.tolist(), bucket.tolist(), strict=True)) == want


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(words, ratio):
    out = {}
    for w, n in words.items():
        close = [x for x in words if near(w, x)]
        best = min(close, key=lambda x: (-words[x], x), default=None)
        form = best if best and words[best] >= ratio * n else None
        out[w] = [w, n, len(close), form, words[form] if form else None]
    for w, r in out.items():
        root = w
        while out[root][3]:
            root = out[root][3]
        r.append(root)
    return sorted(map(tuple, out.values()))


def test_every_near_pair_shares_a_signature(spark):
    rng = random.Random(2)
    words = {"".join(rng.choice("abcß") for _ in range(rng.randint(1, 7))): rng.choice([1, 2, 10, 30, 300]) for _ in range(500)}
    words |= {"x" * 2_000: 5, "x" * 2_001: 50, "x" * 1_999 + "y": 3, "日本語": 4, "日本": 40, "本日": 1, "𝄞a": 2, "a": 20}
    rows = [(w, n, "c", 1) for w, n in words.items()] + [(None, 9, "", 0), ("", 9, "", 0), ("nul", None, "", 0)]
    frame = spark.createDataFrame(rows, "word string, n long, form string, signature int")
    for ratio in (10,):
        got = spelling.variant_groups(frame, ratio).collect()
        assert sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in got) == brute_variants(words, ratio)
    split = spark.createDataFrame([("aaa", 3), ("aab", 40), ("aab", 41), ("aaa", 1)], "word string, n long")
    assert {(r.word, r.n, r.root) for r in spelling.variant_groups(split).collect()} == {("aaa", 4, "aab"), ("aab", 81, "aab")}
    assert spelling.variant_groups(split.limit(0)).count() == 0


def test_words_are_thinned_by_their_crc(spark, edges):
    want = Counter()
    for r in edges.select("doc_id", "text").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if r.doc_id is None else r.doc_id}:{run}".encode())
            if h % 3 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            want[run] += 1
    want = {w: n for w, n in want.items() if len(w) >= 3 and n >= 2}
    assert {r.word: r.n for r in spelling.word_counts(edges, thin_by=3, least_length=3, least_count=2).collect()} == want


def brute_nearest(rows, k, asks):
    """Per query row: (id, distance) of the k nearest other rows."""
    rows = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for q, (i, v) in enumerate(rows):
        if asks(i):
            def far(w, v=v):
                total = 0.0
                for x, y in zip(v, w, strict=True):
                    total += (x - y) * (x - y)
                return math.sqrt(total)
            found = sorted((far(w), j) for p, (j, w) in enumerate(rows) if p != q and len(w) == len(v))[:k]
            out += [(i, n + 1, j, d) for n, (d, j) in enumerate(found)]
    return sorted(out)


def frame_of(spark, rows, kind):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], f"vec_id long, embedding array<{kind}>, place int, row int").repartition(3)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_search_of_traps_is_exact_where_all_places_open(spark, kind):
    """Bad vectors, copies, repeated rows, other dimensions, ties; the
    smallest blocks, so that hot places are cut on both sides."""
    rng = np.random.default_rng(3)
    vecs = [(i, np.round(rng.normal(size=8) * 4).tolist()) for i in range(90)]
    vecs += [(100 + i, [1.0] * 8) for i in range(200)] + [(300, [1.0] * 8)] * 3          # copies in one place
    vecs += [(400 + i, rng.normal(size=3).tolist()) for i in range(4)] + [(500, [2.0])]
    vecs += [(600, None), (601, []), (602, [0.0] * 8), (603, [1.0] * 7 + [None]), (604, [math.nan] * 8), (605, [math.inf] * 8), (None, [1.0] * 8)]
    got = nearest.search(frame_of(spark, vecs, kind), F.col("vec_id") % 10 == 0, k=5, tables=2, recall=1.0, block_bytes=1).collect()
    if kind == "float":
        vecs = [(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in vecs]
    want = brute_nearest(vecs, 5, lambda i: i % 10 == 0)
    assert len(got) == len(want) and len({r.query_id for r in got}) == len({r[0] for r in want})
    exact = {r for r in want if r[0] in (100, 300, 400)}
    assert exact <= {(r.query_id, r.rank, r.vec_id, r.score) for r in got}
    assert len({tuple(r) for r in got} & set(want)) >= 0.9 * len(set(want))


def test_fewer_probes_keep_the_recall(spark):
    """Clusters: few places are opened, and the measured recall holds."""
    rng = np.random.default_rng(5)
    middle = rng.normal(size=(40, 32))
    rows = [(i, (middle[i % 40] + 0.15 * rng.normal(size=32)).tolist()) for i in range(4000)]
    table = frame_of(spark, rows, "double")
    got = nearest.search(table, F.col("vec_id") % 50 == 0).collect()
    want = brute_nearest(rows, 10, lambda i: i % 50 == 0)
    assert len(got) == len(want) == 800
    assert len({(r.query_id, r.vec_id) for r in got} & {(r[0], r[2]) for r in want}) >= 0.9 * len(want)
    truth = {r[0]: {} for r in want}
    assert all(abs(r.score - math.dist(rows[r.query_id][1], rows[r.vec_id][1])) < 1e-12 for r in got) and len(truth) == 80
    again = nearest.search(table.repartition(5), F.col("vec_id") % 50 == 0).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_search_of_nothing(spark):
    empty = frame_of(spark, [], "float")
    assert nearest.search(empty, F.col("vec_id") % 2 == 0).count() == 0
    one = frame_of(spark, [(0, [1.0, 2.0]), (1, None)], "double")
    assert nearest.search(one, F.lit(True)).count() == 0
    assert nearest.search(frame_of(spark, [(1, [1.0, 2.0]), (3, [2.0, 1.0])], "double"), F.col("vec_id") % 2 == 0).count() == 0


def test_rotation_keeps_angles():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(50, 13))
    x /= np.linalg.norm(x, axis=1)[:, None]
    turn = nearest.Rotations(13, 3, 7)
    for t in range(3):
        along = turn(x * 1e200, t)
        assert np.allclose(along[:, :16] @ along[:, :16].T, x @ x.T) and np.allclose(along[:, :16], -along[:, 16:])
