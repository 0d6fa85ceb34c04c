"""Substring dedup (operator 7): suffix automata of reference shards.

A window is ``LENGTH`` consecutive words of one document. A word goes if a
window that covers it has the same words as a window that starts in a document
of a smaller id; windows are judged on the input.

1. Anchors. Each window's anchor is its run of ``GRAM`` words with the smallest
   hash (leftmost), so equal windows have equal anchors. Consecutive windows
   with one anchor form a region (at most 2 * LENGTH words). Made in the scan.
2. Only anchors that occur in documents of different ids go on, by a count per
   anchor. Occurrences with the same region are one class, which belongs to its
   smallest document: in all others every window of the region is covered.
3. What is left is each class's smallest document, against other classes with
   the same anchor. Classes are dealt by anchor into reference shards of bounded
   size. A shard's task takes them in ascending id: the class's words are
   streamed through a suffix automaton of the words of all classes of smaller
   ids, and windows end where the matching statistic reaches LENGTH; then the
   class is added. Shards are co-partitioned with the passages that can match
   them, instead of sending every shard to every document, which would cost
   shards times documents.
4. An anchor with more than ``max_classes`` classes doesn't fit a shard. Its
   windows are compared one by one: the smallest id of each window hash (128
   bits), aggregated before the shuffle. The rule is the same and exact.
5. Covered places become spans per document, which are removed.

Null text has no words. A null id stands after all others. Repeated rows (same
id) never cover each other. Documents of fewer than LENGTH words keep all.
Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automaton import SuffixAutomaton
from .common import PLAIN_WORDS, Words, batches, gram_hashes, mix, packed_texts, per_key_back, row_key, unpack, words_of, written

LENGTH, GRAM = 50, 16
LAST = (1 << 63) - 1
_STEP = np.uint64(0xD6E8FEB86659FD93)
ANCHORS = ("doc_id long, row_key long, n_words long, kept_sha256 string, anchor array<long>, region array<long>, "
           "start array<int>, run array<int>")


def sliding_least(v: np.ndarray, w: int) -> np.ndarray:
    """Place of the leftmost smallest value in each run of ``w`` values."""
    at, least, k = np.arange(len(v)), v, 1

    def merged(a: int, b: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        right = least[b: b + n] < least[a: a + n]
        return np.where(right, at[b: b + n], at[a: a + n]), np.where(right, least[b: b + n], least[a: a + n])

    while 2 * k <= w:
        at, least = merged(0, k, len(at) - k)
        k *= 2
    if k < w:
        at, least = merged(0, w - k, len(at) - (w - k))
    return at


def window_anchors(words: Words, h: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(document, anchor hash, region hash, first window, windows) of each
    region of a block of texts."""
    empty = np.zeros(0, np.int64)
    if len(h) < length:
        return empty, empty.astype(np.uint64), empty.astype(np.uint64), empty, empty
    grams = gram_hashes(h, gram)
    at = sliding_least(grams, length - gram + 1)
    owner = np.repeat(np.arange(len(words)), words.counts)
    inside = owner[: len(at)] == owner[length - 1:]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | ~inside[:-1] | (owner[1: len(at)] != owner[: len(at) - 1])
    first = np.flatnonzero(new & inside)
    # a region ends before the next new window or the document's last window
    breaks = np.flatnonzero(new | ~inside)
    after = np.append(breaks, len(at))[np.searchsorted(breaks, first, side="right")]
    run = after - first
    with np.errstate(over="ignore"):
        power = np.full(len(h) + 1, _STEP)
        power[0] = 1
        power = np.cumprod(power, dtype=np.uint64)
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix(h) * power[:-1], dtype=np.uint64)])
        end = first + run + length - 1
        # words of a region weigh by their place in it
        back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(h), np.uint64(pow(int(_STEP), -1, 1 << 64)))]), dtype=np.uint64)
        region = mix((total[end] - total[first]) * back[first] + mix(run.astype(np.uint64)))
    doc = owner[first]
    return doc, grams[at[first]], region, first - words.first[doc], run


def anchored(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Rows of ANCHORS from (doc_id, row_key, text); ``kept_sha256`` is that
    of the whole text."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, 8 << 20):
            words = words_of(b.column(2), PLAIN_WORDS)
            doc, anchor, region, start, n = window_anchors(words, words.hashes(), length, gram)
            offsets = pa.array(np.searchsorted(doc, np.arange(len(words) + 1)).astype(np.int32))
            data = words.data.tobytes()
            shas = []
            starts, ends = words.start.tolist(), words.end.tolist()
            for lo, hi in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
                shas.append(hashlib.sha256(b" ".join([data[x:y] for x, y in zip(starts[lo:hi], ends[lo:hi], strict=True)])).hexdigest())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, t)) for x, t in (
                (anchor.view(np.int64), pa.int64()), (region.view(np.int64), pa.int64()),
                (start.astype(np.int32), pa.int32()), (n.astype(np.int32), pa.int32()))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(words.counts, pa.int64()), pa.array(shas), *lists],
                                             names=["doc_id", "row_key", "n_words", "kept_sha256", "anchor", "region", "start", "run"])

    return docs.mapInArrow(run, ANCHORS)


def covered_windows(classes: list[tuple], length: int) -> list[np.ndarray]:
    """For each (id, text of the region), the windows (by start) that stand in
    a region of a smaller id. ``classes`` come in ascending id."""
    sam, ids, out = SuffixAutomaton(), {}, []
    i = 0
    while i < len(classes):
        j = i
        while j < len(classes) and classes[j][0] == classes[i][0]:
            j += 1
        # those of one document are judged before any of them is added
        streams = [[ids.setdefault(w, len(ids)) for w in text.split(b" ")] for _, text in classes[i:j]]
        for s in streams:
            out.append(np.array([k + 1 - length for k, (_, n) in enumerate(sam.statistics(s)) if n >= length], np.int32))
        for s in streams:
            for _ in sam.add(s):
                pass
        i = j
    return out


def removed_spans(docs: DataFrame, prepared: DataFrame, length: int, max_classes: int, shard_classes: int) -> DataFrame:
    """(row_key, lo, hi): spans of words that go. ``docs`` has row_key, text."""
    order = F.coalesce("doc_id", F.lit(LAST))
    occ = (prepared.select(order.alias("ord"), "row_key", F.explode(F.arrays_zip("anchor", "region", "start", "run")).alias("a"))
           .select("ord", "row_key", "a.anchor", "a.region", "a.start", "a.run"))
    anchors = occ.groupBy("anchor").agg(F.min("ord").alias("lo"), F.max("ord").alias("hi"),
                                        (F.min("region") != F.max("region")).alias("mixed"))
    anchors = written(anchors.where("lo < hi").select("anchor", "mixed"), "dedup-anchors")
    hits = written(occ.join(anchors, "anchor"), "dedup-hits")
    hits = written(per_key_back(hits, ["anchor", "region"], {"least": F.min("ord")}, {"least": F.min("least")},
                                salt_on=F.xxhash64("row_key", "start")), "dedup-classes")
    whole = hits.where("ord > least").select("row_key", F.col("start").alias("lo"), (F.col("start") + F.col("run") + length - 1).alias("hi"))

    own = hits.where("mixed and ord = least")
    reps = own.dropDuplicates(["anchor", "region"]).select("anchor", "region", "ord", "row_key", "start", "run")
    crowd = reps.groupBy("anchor").agg(F.count("*").alias("classes")).where(F.col("classes") > max_classes).select(
        "anchor", F.lit(True).alias("crowded"))
    reps = written(reps.join(crowd, "anchor", "left").withColumn("crowded", F.coalesce("crowded", F.lit(False))), "dedup-reps")
    per_doc = reps.groupBy("row_key", "ord").agg(F.collect_list(F.struct("anchor", "region", "start", "run", "crowded")).alias("parts"))
    texts = packed_texts(docs)
    joined = per_doc.join(texts, "row_key").dropDuplicates(["row_key"]).select("ord", "parts", "packed")

    def regions(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "region", "ord", "text", "at", "key_a", "key_b"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int64()]
        rows: list[tuple] = []
        for b in it:
            for i in range(b.num_rows):
                ord_, parts, packed = (c[i].as_py() for c in b.columns)
                words = unpack(packed).split()
                for p in parts:
                    part = words[p["start"]: p["start"] + p["run"] + length - 1]
                    if not p["crowded"]:
                        rows.append((p["anchor"], p["region"], ord_, b" ".join(part), None, None, None))
                        continue
                    for k in range(p["run"]):
                        d = hashlib.md5(b" ".join(part[k: k + length]), usedforsecurity=False).digest()
                        rows.append((p["anchor"], p["region"], ord_, None, k, int.from_bytes(d[:8], "little", signed=True),
                                     int.from_bytes(d[8:], "little", signed=True)))
                if len(rows) >= 8192:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
                    rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    parts = written(joined.mapInArrow(regions, "anchor long, region long, ord long, text binary, at int, key_a long, key_b long"),
                    "dedup-regions")
    shards = max(1, parts.where("text is not null").count() // shard_classes)
    sharded = (parts.where("text is not null").withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)).cast("int"))
               .select("shard", "ord", "anchor", "region", "text").repartition("shard").sortWithinPartitions("shard", "ord"))

    def stream(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []

        def found() -> pa.RecordBatch:
            out = covered_windows([(o, t) for o, _, _, t in held], length)
            return pa.RecordBatch.from_arrays([pa.array([x[1] for x in held], pa.int64()), pa.array([x[2] for x in held], pa.int64()),
                                               pa.array(out, pa.list_(pa.int32()))], names=["anchor", "region", "covered"])

        for b in it:
            for s, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if s != shard:
                    if held:
                        yield found()
                    shard, held = s, []
                held.append(tuple(row))
        if held:
            yield found()

    by_shard = sharded.mapInArrow(stream, "anchor long, region long, covered array<int>").select(
        "anchor", "region", F.explode("covered").alias("at"))
    single = parts.where("text is null").select("anchor", "region", "ord", "at", "key_a", "key_b")
    by_window = per_key_back(single, ["key_a", "key_b"], {"first": F.min("ord")}, {"first": F.min("first")},
                             salt_on=F.xxhash64("anchor", "region")).where("first < ord").select("anchor", "region", "at")
    places = by_shard.union(by_window).groupBy("anchor", "region").agg(F.collect_set("at").alias("covered"))
    some = (own.join(places, ["anchor", "region"]).select("row_key", "start", F.explode("covered").alias("at"))
            .select("row_key", (F.col("start") + F.col("at")).alias("lo"), (F.col("start") + F.col("at") + length).alias("hi")))
    return whole.union(some)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                    max_classes: int = 256, shard_classes: int = 1000) -> DataFrame:
    """(doc_id, row_key, n_words, n_removed, kept_sha256, spans): one row per
    row; ``spans`` are the removed word spans (from 0, end exclusive)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), row_key(id_col, text_col).alias("row_key"), F.col(text_col).alias("text"))
    prepared = written(anchored(rows, length, gram), "dedup-prepared")
    spans = removed_spans(rows, prepared, length, max_classes, shard_classes)
    per_doc = spans.distinct().groupBy("row_key").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    joined = per_doc.join(packed_texts(rows), "row_key").dropDuplicates(["row_key"]).select("row_key", "spans", "packed")

    def remove(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            out: list[tuple] = []
            for i in range(b.num_rows):
                key, parts, packed = (c[i].as_py() for c in b.columns)
                words = unpack(packed).split()
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, [p["lo"] for p in parts], 1)
                np.add.at(edge, [p["hi"] for p in parts], -1)
                gone = np.cumsum(edge)[:-1] > 0
                cut = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                kept = b" ".join([words[k] for k in np.flatnonzero(~gone).tolist()])
                out.append((key, int(gone.sum()), hashlib.sha256(kept).hexdigest(),
                            [{"lo": x, "hi": y} for x, y in zip(cut[::2].tolist(), cut[1::2].tolist(), strict=True)]))
            types = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                                                 names=["key", "n_removed", "sha", "spans"])

    done = joined.mapInArrow(remove, "key long, n_removed long, sha string, spans array<struct<lo:int,hi:int>>")
    base = prepared.select("doc_id", "row_key", "n_words", "kept_sha256")
    return (base.join(done, base.row_key == done.key, "left")
            .select("doc_id", "row_key", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
                    F.coalesce("sha", "kept_sha256").alias("kept_sha256"),
                    F.coalesce("spans", F.lit([]).cast("array<struct<lo:int,hi:int>>")).alias("spans")))
