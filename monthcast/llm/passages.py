"""Positional matching by closed syncmers (operator 6, native): where a
passage of one text stands in others.

``anchor_places`` gives every closed syncmer of every whole text with its place.
Anchors are context-free, so a shared passage has the same anchors at the same
distances in both texts: ``find_passages`` joins them on the anchor, and matches of
one pair of texts that lie on one diagonal (place minus place) make a passage.
All anchors are kept, however long the text; none is sketched away.

The join is of a stated set of query texts with all rows, on the anchor; a
query is not matched with itself. Its output is the anchors that texts really
share, and a passage that a third of all rows hold is as many results. Anchors
that repeat within a text are matched at each place.

Null and empty texts, and texts without a closed syncmer (all under ``K`` words),
have no anchors and no passages. Rows are told apart by a hash of id and text,
so null and repeated ids do no harm; repeated rows count once each as targets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_key
from .fingerprint import K, S


def anchor_places(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row_key, doc_id, anchor, place): all closed syncmers, places in words from 0."""
    rows = docs.select(row_key(id_col, text_col).alias("row_key"), F.col(id_col).alias("doc_id"),
                       F.split(F.coalesce(F.col(text_col), F.lit("")), r"[\x20\x09-\x0D]+").alias("words"))
    rows = rows.select("row_key", "doc_id", F.transform(F.filter("words", lambda w: w != ""), lambda w: F.xxhash64(w)).alias("h")).where(F.size("h") >= K)
    # hashes of S = 2 words
    rows = rows.withColumn("s", F.zip_with(F.slice("h", F.lit(1), F.size("h") - 1), F.slice("h", F.lit(2), F.size("h") - 1), lambda a, b: F.xxhash64(a, b)))
    inner = K - S

    def edge(i: Column) -> Column:
        return F.least(F.get("s", i), F.get("s", i + inner)) <= F.least(*[F.get("s", i + j) for j in range(1, inner)])

    places = F.filter(F.sequence(F.lit(0), F.size("h") - K), edge)
    anchor = F.transform(places, lambda i: F.struct(F.xxhash64(*[F.get("h", i + j) for j in range(K)]).alias("anchor"), i.alias("place")))
    return rows.select("row_key", "doc_id", F.explode(anchor).alias("a")).select("row_key", "doc_id", "a.*")


def find_passages(docs: DataFrame, is_query: Column, id_col: str = "doc_id", text_col: str = "text", least_anchors: int = 3,
                  widest_gap: int = 50) -> DataFrame:
    """(query_id, doc_id, query_start, doc_start, n_words, n_anchors): passages of at least
    ``least_anchors`` anchors that texts of the queries share with other texts.
    Neighbouring anchors of a passage lie at most ``widest_gap`` words apart."""
    asked = anchor_places(docs.where(is_query), id_col, text_col).dropDuplicates(["row_key", "place"])
    asked = asked.select("anchor", F.col("row_key").alias("query_key"), F.col("doc_id").alias("query_id"), F.col("place").alias("at"))
    all_ = anchor_places(docs, id_col, text_col)
    hits = (asked.join(all_, "anchor").where(F.col("row_key") != F.col("query_key"))
            .groupBy("query_key", "query_id", "row_key", "doc_id", (F.col("place") - F.col("at")).alias("shift"))
            .agg(F.array_sort(F.collect_set("at")).alias("places")))
    # a diagonal's places, cut where the next one is too far away
    cuts = F.filter(F.sequence(F.lit(0), F.size("places") - 1), lambda i: (i == 0) | (F.get("places", i) - F.get("places", i - 1) > widest_gap))
    hits = hits.withColumn("cuts", F.concat(cuts, F.array(F.size("places"))))
    runs = F.transform(F.sequence(F.lit(0), F.size("cuts") - 2), lambda r: F.struct(
        F.get("places", F.get("cuts", r)).alias("first"), F.get("places", F.get("cuts", r + 1) - 1).alias("last"),
        (F.get("cuts", r + 1) - F.get("cuts", r)).alias("n")))
    return (hits.select("query_id", "doc_id", "shift", F.explode(runs).alias("r")).where(F.col("r.n") >= least_anchors)
            .select("query_id", "doc_id", F.col("r.first").alias("query_start"), (F.col("r.first") + F.col("shift")).alias("doc_start"),
                    (F.col("r.last") - F.col("r.first") + K).alias("n_words"), F.col("r.n").alias("n_anchors")))
