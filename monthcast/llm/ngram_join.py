"""N-gram Jaccard join (operator 9): a token-group matrix.

A document's set holds the hashes (64 bits) of its distinct runs of five words
(lower-cased A-Z, split at white space; a shorter text is one run). Documents
of one set are one class; classes link when 100 * intersection >= 80 * union.

1. Sets are made in the scan. Each class keeps its size, its smallest hash and
   its prefix: in the global order (rare before frequent, then by hash) the
   first ``size - ceil(0.8 size) + 1`` hashes. Two linked sets share a hash of
   both prefixes. The frequent hashes come from a bounded sample and only
   decide the order; any order gives the same result.
2. Groups: classes of like size and equal smallest hash, which similar sets
   tend to share, in blocks of ``group_rows`` at most.
3. Matrix: (hash, group) for every prefix hash that two classes at least have,
   with the group's least and greatest set size: the group's token union.
4. Bound: a class probes the matrix with its prefix. It may link with a
   member X only if the hashes found reach
   ``ceil(4/9 (|Q| + |X|)) - max(|Q| - prefix(Q), |X| - prefix(X))``; the least of
   this over the group's sizes, and the size ratio, must hold. Of two groups
   the one with the smaller number asks.
5. Open: only qualifying (block of queries, group) pairs are brought together,
   bounded on either side. The query's overlap with the union of the members'
   whole sets is counted first, and members are compared where it reaches
   0.8 |Q|. Links become a spanning forest and link counts within the task, so
   a large group never turns into a table of all its pairs.
6. Components of the forest by star contraction; each document gets its
   class's component.

Documents without words link with nothing and are their own component. Null
ids: their rows form sets and links, the smallest id of a class ignores nulls,
and a component without any id has a null component_id. Repeated rows are one
class. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER_WORDS, batches, fresh, given_back, gram_hashes, mix, packed_texts, per_key_back, row_key, unpack, words_of, written
from .components import components

SIZE = 5
SETS = "doc_id long, row_key long, n_shingles long, set_a long, set_b long, least long, hashes array<long>"


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = words_of(texts, LOWER_WORDS)
    h = words.hashes()
    grams = gram_hashes(h, SIZE)
    out = []
    for lo, hi in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if hi - lo >= SIZE:
            out.append(np.unique(grams[lo: hi - SIZE + 1]))
        elif hi > lo:
            out.append(mix(gram_hashes(h[lo:hi], hi - lo) + np.uint64(hi - lo)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def prefix_size(n):
    """Hashes of a set of n that a linked set must share one of."""
    return n - (8 * n + 9) // 10 + 1


def _digest(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set."""
    with np.errstate(over="ignore"):
        a = mix(s + np.uint64(len(s))).sum(dtype=np.uint64)
        b = mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def _sets(docs: DataFrame, frequent, whole: bool) -> DataFrame:
    """Rows of SETS from (doc_id, row_key, text): prefixes, or whole sets."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = frequent.value
        for b in batches(it, 4 << 20):
            sets = shingle_sets(b.column(2))
            digests = [_digest(s) for s in sets]
            kept = []
            for s in sets:
                if whole or not len(s):
                    kept.append(s)
                    continue
                p = prefix_size(len(s))
                late = hot[np.minimum(np.searchsorted(hot, s), len(hot) - 1)] == s if len(hot) else np.zeros(len(s), bool)
                rare = s[~late][:p]
                kept.append(np.concatenate([rare, s[late][: p - len(rare)]]))
            offsets = np.concatenate([[0], np.cumsum([len(k) for k in kept])]).astype(np.int32)
            flat = np.concatenate(kept).view(np.int64) if kept else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([d[0] for d in digests], pa.int64()), pa.array([d[1] for d in digests], pa.int64()),
                 pa.array([int(s[0].view(np.int64)) if len(s) else None for s in sets], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))],
                names=["doc_id", "row_key", "n_shingles", "set_a", "set_b", "least", "hashes"])

    return docs.mapInArrow(given_back(run), SETS)


def frequent_hashes(docs: DataFrame, sample_docs: int, share: float, least: int) -> np.ndarray:
    """Hashes that over ``share`` of a bounded, deterministic sample of
    documents hold; at most (mean set size / share) of them."""
    n = docs.count()
    taken = docs.where(F.pmod(F.xxhash64("row_key"), F.lit(max(1, n // sample_docs))) == 0)
    empty = docs.sparkSession.sparkContext.broadcast(np.zeros(0, np.uint64))
    counts = (_sets(taken, empty, whole=True).select(F.explode("hashes").alias("h")).groupBy("h").count()
              .where(F.col("count") >= max(least, int(share * min(n, sample_docs)))).select("h").toArrow())
    return np.sort(counts.column("h").to_numpy().astype(np.int64).view(np.uint64))


def _link_block(queries: list[tuple], members: list[tuple]) -> tuple[list[tuple[int, int]], dict[int, int]]:
    """Links between queries and members, each (class, copies, sorted set):
    the edges of a spanning forest, and the linked rows of each class.

    A pair that stands in both lists counts once.
    """
    sizes = np.array([len(s) for _, _, s in members])
    flat = np.concatenate([s for _, _, s in members])
    owner = np.repeat(np.arange(len(members)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    union = np.unique(flat)
    lo, hi = np.searchsorted(flat, union), np.searchsorted(flat, union, side="right")
    names = np.array([m[0] for m in members], np.int64)
    copies = np.array([m[1] for m in members], np.int64)
    inside = set(names.tolist())
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    edges: list[tuple[int, int]] = []
    links: dict[int, int] = {}
    for name, n, s in queries:
        at = np.minimum(np.searchsorted(union, s), len(union) - 1)
        at = at[union[at] == s]
        if 10 * len(at) < 8 * len(s):      # the group's union doesn't hold enough of the query
            continue
        counts = hi[at] - lo[at]
        places = np.repeat(lo[at] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        both = np.bincount(owner[places], minlength=len(members))
        linked = 100 * both >= 80 * (len(s) + sizes - both)
        # within one group each pair is met from both sides: keep one
        linked &= (names > name) if name in inside else (names != name)
        for k in np.flatnonzero(linked).tolist():
            other = int(names[k])
            links[name] = links.get(name, 0) + int(copies[k])
            links[other] = links.get(other, 0) + n
            a, b = top(name), top(other)
            if a != b:
                root[max(a, b)] = min(a, b)
                edges.append((name, other))
    return edges, links


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, row_key, n_shingles, component_id, n_links): one
    row per row of ``docs``; ``n_links`` counts the other rows it links with."""
    return with_components(docs, id_col, text_col, **options).drop("component")


def with_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_rows: int = 256,
                    query_rows: int = 512, sample_docs: int = 8_000, frequent_share: float = 0.0005,
                    frequent_least: int = 4) -> DataFrame:
    """``ngram_join`` with ``component``, which tells components apart also
    where ids are null or repeated (rows without words share one)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), row_key(id_col, text_col).alias("row_key"),
                       F.col(text_col).alias("text"))
    frequent = spark.sparkContext.broadcast(frequent_hashes(rows, sample_docs, frequent_share, frequent_least))
    prefixes = written(_sets(rows, frequent, whole=False), "ngram-prefixes")

    # classes of equal sets; a class is named by its smallest row key
    sets = prefixes.select("doc_id", "row_key", "n_shingles", "set_a", "set_b")
    by_set = written(per_key_back(
        sets, ["n_shingles", "set_a", "set_b"],
        {"node": F.min("row_key"), "copies": F.count("*"), "least_id": F.min("doc_id")},
        {"node": F.min("node"), "copies": F.sum("copies"), "least_id": F.min("least_id")},
        salt_on=F.xxhash64("row_key", "doc_id")), "ngram-classes")
    others = written(by_set.where(F.col("row_key") != F.col("node")).select("row_key").distinct(), "ngram-copies")
    reps = (prefixes.join(others, "row_key", "left_anti").where("n_shingles > 0")
            .select(F.col("row_key").alias("node"), F.col("n_shingles").alias("n"), "least", "hashes"))
    # groups: like size and equal smallest hash, in blocks
    small = (reps.select("node", "n", "least").distinct()
             .withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.25))).cast("int")))
    crowded = (small.groupBy("band", "least").agg(F.count("*").alias("in_key")).where(F.col("in_key") > group_rows))
    blocks = F.ceil(F.coalesce("in_key", F.lit(1)) / group_rows)
    crowd = written(small.join(crowded, ["band", "least"], "left").select("node", "n", F.xxhash64(
        "band", "least", F.pmod(F.xxhash64("node"), blocks)).alias("group")), "ngram-groups")

    # prefix hashes that two classes at least have
    tokens = reps.select("node", F.explode("hashes").alias("hash"))
    several = written(tokens.groupBy("hash").agg(F.count("*").alias("m")).where("m > 1").select("hash"), "ngram-hashes")
    tokens = written(tokens.join(several, "hash").join(crowd, "node").select("hash", "node", "n", "group"), "ngram-tokens")
    matrix = tokens.groupBy("hash", "group").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    q = tokens.withColumnRenamed("group", "own")
    probe = (matrix.join(q, "hash").where((F.col("own") <= F.col("group")) & (5 * F.col("high") >= 4 * F.col("n"))
                                          & (4 * F.col("low") <= 5 * F.col("n"))))
    probe = probe.groupBy("node", "n", "own", "group").agg(F.count("*").alias("found"), F.min("low").alias("low"),
                                                           F.max("high").alias("high"))
    beyond = lambda n: F.ceil(n * 8 / 10) - 1  # noqa: E731  hashes after the prefix
    least = F.greatest(F.ceil(F.col("n") * 4 / 5), F.col("low"))
    most = F.least(F.floor(F.col("n") * 5 / 4), F.col("high"))
    bound = F.ceil((F.col("n") + least) * 4 / 9 - 1e-6) - F.greatest(beyond(F.col("n")), beyond(most))
    # its own group is opened by a class that isn't alone in it
    peers = crowd.groupBy("group").count().where("count > 1").select("group", F.lit(True).alias("peers"))
    opened = (probe.where(F.col("found") >= bound).join(peers, "group", "left")
              .where((F.col("own") != F.col("group")) | F.col("peers")).select("node", "group"))
    opened = written(opened, "ngram-open")
    sized = opened.groupBy("group").count()
    opened = opened.join(sized, "group").select(
        "node", "group", F.pmod(F.xxhash64("node"), F.ceil(F.col("count") / query_rows)).alias("part"))
    wanted = (opened.select("group", "part").distinct().join(crowd, "group").select("node", "group", "part", F.lit(1).alias("member"))
              .union(opened.select("node", "group", "part", F.lit(0).alias("member"))))
    wanted = written(wanted.join(by_set.select("node", "copies").distinct(), "node"), "ngram-wanted")

    # texts travel compressed; of repeated rows one
    need = wanted.select("node").distinct()
    texts = packed_texts(rows).join(need, F.col("row_key") == need.node, "left_semi")
    texts = texts.dropDuplicates(["row_key"])
    meet = wanted.join(texts, wanted.node == texts.row_key)

    def link(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, queries, members = None, [], []

        def found() -> pa.RecordBatch:
            edges, links = _link_block(queries, members) if queries and members else ([], {})
            u = [a for a, _ in edges] + list(links)
            v = [b for _, b in edges] + [None] * len(links)
            n = [None] * len(edges) + list(links.values())
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(n, pa.int64())],
                                              names=["u", "v", "n"])

        for b in it:
            group, part, node, member, copies, packed = (c.to_pylist() for c in b.columns)
            for i in range(b.num_rows):
                if (group[i], part[i]) != key:
                    if key is not None:
                        yield found()
                    key, queries, members = (group[i], part[i]), [], []
                one = (node[i], copies[i], shingle_sets(pa.array([unpack(packed[i]).decode()]))[0])
                (members if member[i] else queries).append(one)
        if key is not None:
            yield found()

    linked = written(meet.select("group", "part", "node", "member", "copies", "packed").repartition("group", "part")
                     .sortWithinPartitions("group", "part").mapInArrow(given_back(link), "u long, v long, n long"), "ngram-links")
    comps = components(linked.where(F.col("v").isNotNull()).select("u", "v"))
    counts = linked.where(F.col("v").isNull()).groupBy("u").agg(F.sum("n").alias("n_links"))

    # one row a class: its component's smallest id, and that id's class marks the row to keep
    classes = by_set.select("node", "copies", "least_id").distinct()
    classes = (classes.join(comps, "node", "left").join(counts, classes.node == counts.u, "left")
               .select("node", F.coalesce("component", "node").alias("component"), "least_id",
                       (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    classes = per_key_back(classes, ["component"], {"component_id": F.min("least_id")},
                           {"component_id": F.min("component_id")}, salt_on=F.col("node"))
    # empty sets link with nothing, each row for itself
    out = by_set.withColumn("salt", F.pmod(F.xxhash64("row_key", "doc_id"), F.lit(64)).cast("int"))
    salts = out.groupBy("node", "salt").count().select("node", "salt")
    back = salts.join(classes, "node")
    own = F.col("n_shingles") == 0
    return (out.join(back, ["node", "salt"])
            .select("doc_id", "row_key", "n_shingles", "component", F.when(own, F.col("doc_id")).otherwise(F.col("component_id"))
                    .alias("component_id"), F.when(own, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links")))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_keys: int = 10_000,
                **options) -> DataFrame:
    """The rows of ``docs`` with one row of each component: that of the
    smallest id, nulls last, then of the smallest row key; of its repeated
    rows, one. Rows without words are components of their own and all stay.

    Row keys of over 1 / ``hot_keys`` of the rows, so fewer than that, are
    broadcast: their rows are thinned in the scan and never meet in one task.
    """
    name, own = fresh(docs, "own_key"), row_key(id_col, text_col)
    found = written(with_components(docs, id_col, text_col, **options).where("n_shingles > 0")
                    .groupBy("row_key", "component").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")),
                    "ngram-rows")
    best = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key"))
                                          .alias("best")).select(F.col("best.row_key").alias("row_key"), F.lit(True).alias("kept"))
    n = found.agg(F.sum("copies")).first()[0] or 0
    keys = written(found.join(best, "row_key", "left").select(
        F.col("row_key").alias(name), F.coalesce("kept", F.lit(False)).alias("kept"),
        ((F.col("copies") > 1) & (F.col("copies") * hot_keys > n)).alias("hot"), (F.col("copies") > 1).alias("repeated")),
        "ngram-keys")
    hot = keys.where("hot")
    rest = docs.join(F.broadcast(hot.select(name)), own == F.col(name), "left_anti")
    gone = keys.where("NOT hot AND (repeated OR NOT kept)").select(name)
    parts = [rest.join(gone, own == F.col(name), "left_anti")]
    twice = keys.where("kept AND repeated")
    for of, few in ((docs, F.broadcast(twice.where("hot").select(name))), (rest, twice.where("NOT hot").select(name))):
        if few.isEmpty():
            continue
        # which of the rows of one key is decided by their values
        value = F.xxhash64(*[F.col(c) for c, t in docs.dtypes if "map<" not in t])
        parts.append(of.join(few, own == F.col(name), "left_semi").groupBy(own.alias(name))
                     .agg(F.min_by(F.struct(*docs.columns), value).alias("one")).select("one.*"))
    return reduce(DataFrame.unionByName, parts)
