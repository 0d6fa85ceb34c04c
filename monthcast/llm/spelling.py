"""Spelling variant grouping (operator 12): words that differ by one inserted,
deleted or replaced code point, each with the frequent form it stands for.

PartEnum signatures: a word's letters are a multiset, seen as a binary vector
with one dimension for each (letter, n-th occurrence). One edit changes at most
two dimensions, so near words have Hamming distance at most two. Letters are
dealt into ``PARTS`` groups; two vectors at distance two or less agree in at
least ``PARTS - 2`` of the groups, so a word's signatures are the hashes of its
letters in each choice of ``PARTS - 2`` groups. The enumeration is exact: every
near pair shares a signature. The letters of a choice are hashed in the order
in which they stand in the word: an edit leaves the order of letters that it
doesn't touch, so no pair is lost, and words of the same letters in another
order (most candidates otherwise, 24 of 27 measured) don't meet. Signatures are
equi-joined, and the edit distance verifies each candidate inside the join.
Words are distinct and stand once, so no hot word or document makes a group
large; a group is the words with one skeleton.

A word's form is its near word of largest count (ties: the smallest in
code-point order) if that count is at least ``ratio`` times its own. Counts
grow by ``ratio`` along a chain of forms, so chains have at most
log_ratio(2^63) links and a fixed number of pointer doublings reaches the root.

Null and empty words and null counts are left out of the table first; a word
given in several rows counts once, with the sum of its counts. Words of any
length are compared whole (Spark walks to the band of its banded distance, so a
pair of very long words takes time by the square of their length). An
empty table gives no rows; columns of other names are ignored.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

RUNS = "[A-Za-zÀ-ÿ]+"
#: Groups of letters, and the choices of groups that make the signatures.
PARTS = 8
CHOICES = list(combinations(range(PARTS), PARTS - 2))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", thin_by: int | None = None,
                least_length: int = 1, least_count: int = 1) -> DataFrame:
    """(word, n) of the letter runs of all whole texts. With ``thin_by``, a run
    whose crc32 with the document's id divides by it loses one letter, the
    (crc32 mod length)-th. Words count after that."""
    run = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                      F.explode(F.regexp_extract_all(lower_ascii(F.col(text_col)), F.lit(f"({RUNS})"), 1)).alias("run"))
    if thin_by is None:
        words = run.select(F.col("run").alias("word"))
    else:
        h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
        at = (F.col("h") % F.length("run")).cast("int")
        words = run.where(F.length("run") >= least_length).select("run", h.alias("h")).select(
            F.when(F.col("h") % thin_by == 0, F.concat(F.substring(F.col("run"), F.lit(1), at),
                                                       F.substring(F.col("run"), at + 2, F.length("run"))))
            .otherwise(F.col("run")).alias("word"))
    return (words.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
            .where(F.col("n") >= least_count))


def signatures(word: Column) -> Column:
    """The hash of the word's letters in each choice of groups. Letters go to
    groups by code point."""
    letters = F.split(word, "")

    def chosen(groups: tuple[int, ...]) -> Column:
        return F.filter(letters, lambda c: F.pmod(F.ascii(c), F.lit(PARTS)).isin(*groups))

    return F.array(*[F.xxhash64(F.lit(i), chosen(groups)) for i, groups in enumerate(CHOICES)])


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): both directions of every pair of distinct
    words that one insertion, deletion or replacement parts. ``words`` has
    distinct, non-null words."""
    rows = words.select("word", "n", F.length("word").alias("size"), F.explode(signatures(F.col("word"))).alias("signature"))
    a, b = (rows.select("signature", *[F.col(c).alias(f"{side}_{c}") for c in ("word", "n", "size")]) for side in "ab")
    wa, wb = F.col("a_word"), F.col("b_word")
    # words that differ in few groups meet in several signatures
    pairs = a.join(b, (a["signature"] == b["signature"]) & (F.abs(F.col("a_size") - F.col("b_size")) <= 1) & (wa < wb)
                   & (F.levenshtein(wa, wb, 1) == 1)).select("a_word", "a_n", "b_word", "b_n").dropDuplicates(["a_word", "b_word"])
    one = lambda x, y: F.struct(F.col(f"{x}_word").alias("word"), F.col(f"{x}_n").alias("n"),
                                F.col(f"{y}_word").alias("near"), F.col(f"{y}_n").alias("near_n"))
    return pairs.select(F.explode(F.array(one("a", "b"), one("b", "a"))).alias("p")).select("p.*")


def variant_groups(words: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of each word of (word, n)."""
    words = written(words.where(F.col("word").isNotNull() & (F.col("word") != "") & F.col("n").isNotNull())
                    .groupBy("word").agg(F.sum("n").alias("n")), "spelling-words")
    # the larger count first, then the smaller word: min of (-count, word)
    best = (near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"),
                                                 F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best")))
    is_form = -F.col("best.minus") >= ratio * F.col("n")
    each = written(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.minus")).alias("form_n")), "spelling-forms")
    root = each.where(F.col("form").isNotNull()).select(F.col("word").alias("from"), F.col("form").alias("root"))
    links = math.ceil(63 / math.log2(ratio)) if ratio > 1 else 64
    for _ in range(math.ceil(math.log2(links)) if links > 1 else 0):
        ahead = root.select(F.col("from").alias("root"), F.col("root").alias("further"))
        root = written(root.join(ahead, "root", "left").select("from", F.coalesce("further", "root").alias("root")), "spelling-roots")
    return (each.join(root, F.col("word") == F.col("from"), "left")
            .select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")))
