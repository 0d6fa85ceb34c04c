"""Document fingerprints (operator 6, native): closed syncmers.

A text is a sequence of whitespace words. A k-mer of ``K`` words is a closed
syncmer if the smallest of its inner S-mers (``S`` words each, ordered by hash)
lies at its first or last place. Whether a k-mer is one depends on its own
words alone, so the same passage gives the same anchors in any text. The
fingerprint is the bottom sketch of the anchors' hashes (the ``SKETCH``
smallest distinct ones, as 8 hex digits each); the likeness of two
fingerprints is the share of common values among the smallest ``SKETCH``
values of both together, an estimate of the Jaccard likeness of the anchor
sets. A text with words but without a closed syncmer (one shorter than K words,
or some of K or K + 1 words) has its whole word sequence as its only anchor; a
text without words has the empty fingerprint, which is like an empty one (1.0)
and unlike any other (0.0).

Only DataFrame functions. Null text counts as empty. Equal texts have equal
fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import range_bounds, range_index

K, S, SKETCH = 5, 2, 64
#: Rows of a range of ids that one task sorts to find each row's neighbour, and ranges at most.
RANGE_ROWS, MAX_RANGES = 2_000, 65_536


def with_anchors(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """Adds ``out``: the bottom sketch (sorted array of ints) of the text.

    Each step is a projection of its own, and arrays are named twice in each
    lambda, so that no step is computed again per element.
    """
    words, h, s, at = (f"_{out}_{x}" for x in ("words", "h", "s", "at"))
    keep = df.columns
    df = df.withColumn(words, F.split(F.col(text_col), r"[\x20\x09-\x0D]+"))
    df = df.withColumn(h, F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))).select(*keep, h)
    # s-mers of S = 2 words
    df = df.withColumn(s, F.when(F.size(h) >= S, F.zip_with(
        F.slice(F.col(h), F.lit(1), F.size(h) - 1), F.slice(F.col(h), F.lit(2), F.size(h) - 1),
        lambda a, b: F.xxhash64(a, b))).otherwise(F.lit([]).cast("array<bigint>")))
    inner = K - S
    places = F.when(F.size(s) > inner, F.sequence(F.lit(0), F.size(s) - inner - 1)).otherwise(F.lit([]).cast("array<int>"))

    def edge(i: Column) -> Column:
        ends = F.least(F.get(s, i), F.get(s, i + inner))
        within = F.least(*[F.get(s, i + j) for j in range(1, inner)])
        return ends <= within

    df = df.withColumn(at, F.filter(places, edge))
    anchor = F.transform(at, lambda i: F.shiftrightunsigned(
        F.xxhash64(F.get(s, i), F.get(s, i + S), F.get(h, i + K - 1)), 32))
    whole = F.when(F.size(h) == 0, F.lit([]).cast("array<bigint>")).otherwise(
        F.array(F.shiftrightunsigned(F.xxhash64(F.col(h)), 32)))
    df = df.withColumn(out, F.when(F.size(at) == 0, whole).otherwise(anchor)).select(*keep, out)
    return df.withColumn(out, F.slice(F.array_sort(F.array_distinct(out)), 1, SKETCH))


def fingerprint_text(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda v: F.lower(F.lpad(F.hex(v), 8, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Bottom-sketch estimate of the Jaccard likeness, 0 to 1."""
    low = F.slice(F.array_sort(F.array_union(a, b)), 1, SKETCH)
    both = F.size(F.array_intersect(low, F.array_intersect(a, b)))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when(
        (F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(both / F.size(low))


def with_next(docs: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """Adds ``next_<c>`` for each column: its value in the next row by
    descending id (after the last: the first).

    Rows are dealt once, into ranges of ids; the first row of a range also
    goes to the range before it, so each range can look ahead alone. Null ids
    come last; rows of equal ids stand in the order of their other columns.
    """
    n = docs.agg(F.count("*")).first()[0]
    bounds = range_bounds(docs, id_col, min(MAX_RANGES, max(1, n // RANGE_ROWS)))
    top = docs.withColumn("_range", range_index(F.col(id_col), bounds))
    order = [F.col(id_col).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in columns]]
    # one row a range: its first id and the range that comes before it (the first range's is the last)
    firsts = sorted((r[0], r[1]) for r in top.groupBy("_range").agg(F.max(id_col)).collect())
    ghosts = [(r, first, firsts[(i + 1) % len(firsts)][0]) for i, (r, first) in enumerate(firsts)]
    ghost = docs.sparkSession.createDataFrame(ghosts, f"_r int, _first {dict(docs.dtypes)[id_col]}, _to int")
    dealt = top.join(F.broadcast(ghost), (F.col("_r") == F.col("_range")) & F.col(id_col).eqNullSafe(F.col("_first")),
                     "left")
    dealt = dealt.withColumn("_copy", F.explode(F.array_compact(F.array(
        F.struct(F.col("_range").alias("range"), F.lit(0).alias("ghost")),
        F.when(F.col("_to").isNotNull(), F.struct(F.col("_to").alias("range"), F.lit(1).alias("ghost")))))))
    dealt = dealt.select(*docs.columns, F.col("_copy.range").alias("_range"), F.col("_copy.ghost").alias("_ghost"))
    w = Window.partitionBy("_range").orderBy("_ghost", *order)
    dealt = dealt.withColumns({f"next_{c}": F.lead(c).over(w) for c in columns})
    return dealt.where(F.col("_ghost") == 0).drop("_range", "_ghost")


def fingerprint_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text (its last half
    replaced by the first part of the next text), and their likenesses."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = with_anchors(rows, "text", "sketch")
    rows = with_next(rows, "doc_id", ["text", "sketch"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.col("text").substr(F.lit(1), n - half),
                                              F.col("next_text").substr(F.lit(1), half)))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "edited", "sketch", "next_sketch")
    rows = with_anchors(rows.withColumn("edited_sha256", F.sha2("edited", 256)), "edited", "edited_sketch")
    return rows.select("doc_id", "n_chars", "edited_sha256", fingerprint_text(F.col("sketch")).alias("fingerprint"),
                       fingerprint_text(F.col("edited_sketch")).alias("edited_fingerprint"),
                       likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
                       likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"))
