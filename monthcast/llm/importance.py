"""Target-distribution importance resampling (operator 11): documents whose
hashed n-gram features are likelier in a target set are drawn more often.

Features are runs of 1 to ``max_n`` consecutive words of one text, joined by
one space, repeats counted; a feature's bucket is the unsigned crc32 of its
UTF-8 bytes modulo ``buckets``. With S, s the raw table's feature counts (all,
and of the bucket) and T, t the target's, a bucket's gain is
``floor(1000 * ln((t+1)(S+buckets) / ((s+1)(T+buckets))))``; a document's weight
is the floored mean of its features' gains. Weight plus Gumbel noise (from a
hash of the id and the seed, so reruns agree) is the score, and the ``share``
of the eligible documents with the highest scores is drawn: sampling without
replacement by weight (the Gumbel top-k rule).

Each batch of whole texts runs through Arrow kernels: ``ascii_lower``,
``split_pattern_regex``, ``list_flatten``, ``dictionary_encode``. Runs of n words are
pairs of (code of the first n-1 words, dictionary index of the next word),
shifted against each other within a text; the crc is continued once for each
distinct pair, and gains are taken per feature and reduced per text segment.

Scale: two scans. What meets in one place is ``buckets`` counts (a parameter,
checked against ``MAX_BUCKETS``). Ranks come from counts per score range, then
per score, then an order within one score; the noise alone bounds the share of
distinct ids with the same score by 1 / (1000 e), whatever the weights, and
equal rows are counted before they are ordered, so no task holds a hot group.

Null and empty texts have no features, weight 0 and are drawn only if
``least_words`` is 0. A null id hashes as the empty string and ranks after other
ids of its score; repeated rows take consecutive ranks, so some copies of a row
may be drawn and others not. Texts of any length are read whole. An empty
target gives every bucket a gain by the raw counts alone; an empty raw table
gives no rows. Columns of other names are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, row_key, text_buffers, written

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"     # after lower-casing A-Z
MAX_BUCKETS = 1 << 20
SCORE_RANGE = 256


def features(texts: pa.Array, max_n: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, bucket) of every feature of a block of texts, in no order
    among sizes, and the words of each text."""
    # a block is a slice of a batch, and ascii_lower misreads the offsets of a slice: begin at 0
    offsets, data = text_buffers(texts)
    whole = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(np.ascontiguousarray(data)))
    lists = pc.split_pattern_regex(pc.ascii_lower(whole), pattern=SEPARATORS)
    flat, text_of = pc.list_flatten(lists), pc.list_parent_indices(lists)
    real = pc.not_equal(pc.binary_length(flat), 0)
    coded = pc.dictionary_encode(flat.filter(real))
    text_of = text_of.filter(real).to_numpy(zero_copy_only=False)
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    words = [w.encode() for w in coded.dictionary.to_pylist()]
    joined = [b" " + w for w in words] if max_n > 1 else []
    crc = np.fromiter((zlib.crc32(w) for w in words), np.int64, len(words))
    run, of_texts, of_buckets = index, [text_of], [crc[index] % buckets]
    for n in range(2, max_n + 1):
        # runs of n words: those of n - 1 words, and the word that follows in the same text
        inside = text_of[n - 1:] == text_of[: max(0, len(text_of) - n + 1)]
        last = index[n - 1:]
        pairs, code = np.unique(run[: len(last)] * max(1, len(words)) + last, return_inverse=True)
        before, word = (pairs // max(1, len(words))).tolist(), (pairs % max(1, len(words))).tolist()
        crc = np.fromiter((zlib.crc32(joined[w], int(crc[b])) for b, w in zip(before, word, strict=True)), np.int64, len(pairs))
        run = code.reshape(-1)
        of_texts.append(text_of[n - 1:][inside])
        of_buckets.append(crc[run[inside]] % buckets)
    return np.concatenate(of_texts), np.concatenate(of_buckets), np.bincount(text_of, minlength=len(texts))


def bucket_counts(texts: DataFrame, text_col: str = "text", max_n: int = 1, buckets: int = 10_000) -> np.ndarray:
    """Features per bucket over all texts: counted in each task, summed by Spark."""
    if not 0 < buckets <= MAX_BUCKETS:
        raise ValueError(f"buckets must lie in 1..{MAX_BUCKETS}")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches(it, 4 << 20):
            total += np.bincount(features(b.column(0), max_n, buckets)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    counted = texts.select(text_col).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in counted.collect():
        out[r.bucket] = r.n
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket, in doubles, floored."""
    s, t, m = raw.astype(float), target.astype(float), float(len(raw))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + m) / ((s + 1) * (t.sum() + m)))).astype(np.int64)


def weights(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text", max_n: int = 1) -> DataFrame:
    """(doc_id, row_key, n_words, n_features, weight) of every row."""
    sent, buckets = docs.sparkSession.sparkContext.broadcast(gains), len(gains)
    rows = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("row_key"), F.col(text_col).alias("text"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = sent.value
        for b in batches(it, 4 << 20):
            text_of, bucket, n_words = features(b.column(2), max_n, buckets)
            order = np.argsort(text_of, kind="stable") if max_n > 1 else slice(None)
            at = np.searchsorted(text_of[order], np.arange(b.num_rows + 1))
            upto = np.concatenate([[0], np.cumsum(gain[bucket[order]])])
            n = np.diff(at)
            weight = (upto[at[1:]] - upto[at[:-1]]) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n_words.astype(np.int64)), pa.array(n),
                                              pa.array(weight)], names=["doc_id", "row_key", "n_words", "n_features", "weight"])

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {kind}, row_key long, n_words long, n_features long, weight long")


def gumbel(id_col: Column, seed: int) -> Column:
    """Gumbel noise in thousandths from the first 8 hex digits of a SHA-256."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def ranked(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
           max_n: int = 1, buckets: int = 10_000, seed: int = 2024, percent: int = 10, least_words: int = 20) -> DataFrame:
    """Per row: doc_id, row_key, n_words, n_features, weight, score, rank (1 is
    the first drawn; null where not drawn). Of N rows with at least
    ``least_words`` words, ``floor(percent * N / 100)`` are drawn."""
    gains = bucket_gains(bucket_counts(docs, text_col, max_n, buckets), bucket_counts(target, target_col, max_n, buckets))
    cols = ["doc_id", "row_key", "n_words", "n_features", "weight", "score"]
    # equal rows are counted, not ordered among themselves
    rows = written(weights(docs, gains, id_col, text_col, max_n).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
                   .groupBy(*cols).agg(F.count("*").alias("copies")), "importance-rows")
    able = F.col("n_words") >= least_words
    eligible = rows.where(able)
    to_draw = percent * (eligible.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]) // 100
    per_score = (eligible.groupBy("score").agg(F.sum("copies").alias("here"))
                 .withColumn("range", F.floor(F.col("score") / SCORE_RANGE).cast("long")))
    above = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    per_range = (per_score.groupBy("range").agg(F.sum("here").alias("here"))
                 .select("range", F.coalesce(F.sum("here").over(above), F.lit(0)).alias("before_range")))
    inside = Window.partitionBy("range").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    before = (per_score.join(per_range, "range")
              .select("score", (F.col("before_range") + F.coalesce(F.sum("here").over(inside), F.lit(0))).alias("before"))
              .where(F.col("before") < to_draw))
    order = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "row_key", "n_features")
    first = F.col("before") + F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("copies")
    drawn = (eligible.join(before, "score").withColumn("first", first)
             .select(*cols, F.explode(F.sequence(F.col("first") + 1, F.col("first") + F.col("copies"))).alias("rank"))
             .withColumn("rank", F.when(F.col("rank") <= to_draw, F.col("rank"))))
    rest = (rows.join(before.select(F.col("score").alias("_at")), able & (F.col("score") == F.col("_at")), "left_anti")
            .select(*cols, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("rank"))
            .withColumn("rank", F.lit(None).cast("long")))
    return drawn.unionByName(rest)


def resampled(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn rows of ``docs`` themselves, with all their columns. Of equal
    rows (same id and text) that are drawn in part, the first by a hash of all
    columns stay."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    per_key = (ranked(docs, target, **options).groupBy("row_key").agg(F.count("rank").alias("drawn"), F.count("*").alias("rows"))
               .where("drawn > 0"))
    per_key = written(per_key, "importance-drawn")
    key = row_key(id_col, text_col)
    whole = per_key.where("drawn = rows").select(F.col("row_key").alias("_drawn_key"))
    out = docs.join(whole, key == F.col("_drawn_key"), "left_semi")
    # only the row group at the cut can be drawn in part: one at most
    for r in per_key.where("drawn < rows").limit(2).collect():
        out = out.unionByName(docs.where(key == r.row_key).orderBy(
            F.xxhash64(*[F.col(c) for c, t in docs.dtypes if not t.startswith("map")])).limit(r.drawn))
    return out
