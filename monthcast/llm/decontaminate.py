"""Benchmark decontamination (operator 4, native): size-partitioned MinHash
containment search, verified by exact shingle containment.

An item's shingles are its distinct runs of five words (lower case, letters and
digits and everything beyond ASCII); a shorter item is one shingle. An item is
found in a document that holds at least 0.8 of the item's shingles, wherever
they stand: a document is shingled at five words and at each shorter length
that some item has.

Search: items are partitioned by their size ``q``, for the size decides how
many of the smallest shingle hashes make a sketch: a document that holds
``need = ceil(0.8 q)`` of them must hold one of any ``q - need + 1``, so the
bottom sketch of that many MinHash values misses nothing, however long the
document is. Documents are streamed past the sketches (documents of fewer than
``need`` shingles are passed over); those that hold a sketch value are
candidates. Verification counts the exact shingles (as words, not hashes) of
the candidates only.

The query set (items) is taken in blocks of at most ``block`` shingles, each
small enough to be sent to all tasks, so it may grow; only hits are shuffled.

Null or empty texts and items have no shingles and match nothing. Rows are
told apart by id and text, so repeated rows give one result. Empty tables give
no rows; columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, row_key, written

SIZE, HELD = 5, 0.8
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def with_words(df: DataFrame, text_col: str) -> DataFrame:
    """Adds ``words``; a projection of its own, since later steps name it often."""
    return df.withColumn("words", F.filter(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), _SEPARATORS),
                                           lambda w: w != ""))


def shingles(source: str, one: Callable[[list[Column]], Column], sizes: Sequence[int]) -> Column:
    """``one`` of each run of each of ``sizes`` elements of the array column ``source``."""
    def runs(size: int) -> Column:
        last = F.size(source) - size
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: one(
            [F.get(source, i + j) for j in range(size)]))).otherwise(F.array())

    return F.concat(*[runs(size) for size in sizes]) if len(sizes) > 1 else runs(sizes[0])


def _text(parts: list[Column]) -> Column:
    return F.concat_ws(" ", *parts)


def item_shingles(items: DataFrame, id_col: str, text_col: str, held: float) -> DataFrame:
    """(item_id, shingle, hash, size, n_item, need, place): one row for each
    distinct shingle of ``size`` words; ``place`` is its rank by hash within the item."""
    rows = with_words(items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")), "text")
    rows = rows.withColumn("size", F.least(F.size("words"), F.lit(SIZE)))
    rows = rows.withColumn("texts", F.when(F.col("size") == SIZE, F.array_distinct(shingles("words", _text, [SIZE])))
                           .when(F.col("size") > 0, F.array(F.array_join("words", " "))).otherwise(F.array()))
    # shingles hash as in the documents: by the hashes of the words
    rows = rows.withColumn("pairs", F.array_sort(F.transform("texts", lambda t: F.struct(
        _hash_of(t).alias("hash"), t.alias("shingle")))))
    rows = rows.withColumn("n_item", F.size("texts")).where("n_item > 0")
    rows = rows.withColumn("need", F.ceil(F.lit(held) * F.col("n_item") - F.lit(1e-9)).cast("int"))
    return rows.select("item_id", "size", "n_item", "need", F.posexplode("pairs").alias("place", "p")).select(
        "item_id", "p.shingle", "p.hash", "size", "n_item", "need", "place")


def _hash_of(shingle: Column) -> Column:
    words = F.split(shingle, " ")
    return reduce(lambda out, size: out.when(F.size(words) == size, _hash([F.xxhash64(F.get(words, F.lit(j))) for j in range(size)])),
                  range(1, SIZE), F.when(F.size(words) == SIZE, _hash([F.xxhash64(F.get(words, F.lit(j))) for j in range(SIZE)])))


def _hash(words: list[Column]) -> Column:
    return F.xxhash64(*words)


def find_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id_col: str = "item_id", item_text_col: str = "text", held: float = HELD,
               block: int = 200_000) -> DataFrame:
    """(doc_key, doc_id, item_id, n_shared, n_item, containment)."""
    table = written(item_shingles(items, item_id_col, item_text_col, held), "decontam-items")
    blocks = max(1, -(-table.count() // block))
    parts = [table.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k) for k in range(blocks)]
    # the lengths of short items, 1 to SIZE - 1, that there are
    short = sorted(r[0] for r in table.where(F.col("size") < SIZE).select("size").distinct().collect())
    sizes = [SIZE, *short]

    base = docs.select(row_key(id_col, text_col).alias("doc_key"), F.col(id_col).alias("doc_id"),
                       F.col(text_col).alias("text"))
    rows = with_words(base, "text").select("doc_key", "words")
    rows = rows.withColumn("h", F.transform("words", lambda w: F.xxhash64(w)))
    rows = rows.withColumn("n", F.greatest(F.size("words") - SIZE + 1, F.lit(1)))
    rows = rows.select("doc_key", "n", F.explode(shingles("h", _hash, sizes)).alias("hash"))
    hits = [rows.join(F.broadcast(p.where(F.col("place") <= F.col("n_item") - F.col("need")).select("hash", "need")), "hash")
            .where(F.col("n") >= F.col("need")).select("doc_key") for p in parts]
    found = written(reduce(DataFrame.union, hits).distinct(), "decontam-candidates")

    near = with_words(base.join(found, "doc_key", "left_semi"), "text").select("doc_key", "doc_id", "words")
    near = near.select("doc_key", "doc_id", F.explode(F.array_distinct(
        shingles("words", _text, sizes))).alias("shingle"))
    shared = reduce(DataFrame.union, [near.join(F.broadcast(p.select("shingle", "item_id", "n_item", "need")), "shingle")
                                      for p in parts])
    counted = shared.groupBy("doc_key", "doc_id", "item_id", "n_item", "need").agg(
        F.count_distinct("shingle").alias("n_shared"))
    return counted.where(F.col("n_shared") >= F.col("need")).select(
        "doc_key", "doc_id", "item_id", "n_shared", F.col("n_item").cast("long").alias("n_item"),
        (F.col("n_shared") / F.col("n_item")).alias("containment"))


def decontaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no item."""
    name = fresh(docs, "found_key")
    bad = written(find_items(docs, items, id_col, text_col, **options).select(F.col("doc_key").alias(name)).distinct(),
                  "decontam-found")
    return docs.join(bad, row_key(id_col, text_col) == F.col(name), "left_anti")
