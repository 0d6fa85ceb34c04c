"""Connected components of an edge table by star contraction: alternate
large-star and small-star steps until the edges are stars round each
component's smallest node. No node's neighbours meet in one task: minima are
aggregated on the map side and go back salted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_key_back, written


def _with_min(pairs: DataFrame) -> DataFrame:
    """(u, v) pairs with ``m``, the smallest of u and its v's."""
    out = per_key_back(pairs, ["u"], {"m": F.min("v")}, {"m": F.min("m")}, salt_on=F.xxhash64("v"))
    return out.withColumn("m", F.least("u", "m"))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of ``edges`` (columns u, v)."""
    now = written(edges.where(F.col("u") != F.col("v"))
                  .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-0")
    before = None
    for i in range(max_rounds):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_with_min(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where(F.col("u") != F.col("v")).distinct())
        down = _with_min(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
        small = (down.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(down.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v")).distinct())
        now = written(small, f"cc-{i + 1}")
        # stars: no smaller end is itself a larger end; and the table no longer changes
        state = now.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = state
    raise RuntimeError("components did not settle")
