"""Keyed upsert family: batch dedup, merge into a target, change accounting,
duplicate audits and clean-up.

All key-level "first/last row" choices are aggregates (``min``/``max`` of a
struct), so hot keys are reduced map-side; the merge is one full outer join
of two tables that are unique on the key, so it cannot fan out.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .news import keep_first, keep_last

INSERTED, MODIFIED, UNCHANGED, UNTOUCHED = "inserted", "modified", "unchanged", "untouched"


def _valid_keys(keys: Sequence[str], allow_empty: bool) -> Column:
    conds = [F.col(k).isNotNull() for k in keys]
    if not allow_empty:
        conds += [F.col(k).cast("string") != F.lit("") for k in keys]
    return reduce(lambda a, b: a & b, conds)


def _seq(seq_col) -> list[str]:
    return [seq_col] if isinstance(seq_col, str) else list(seq_col)


def dedup_keep_last(batch: DataFrame, keys: Sequence[str], seq_col) -> DataFrame:
    """Last row per key in arrival order ``seq_col`` (a column or a list);
    NULL keys dropped, empty-string keys kept."""
    return keep_last(batch.where(_valid_keys(keys, allow_empty=True)), keys, _seq(seq_col))


def merge_with_changes(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                       seq_col=None, drop_seq: bool = False, newer_by=None) -> DataFrame:
    """Upsert ``batch`` into ``target`` by ``keys`` and tag every output row
    with ``__change`` in {inserted, modified, unchanged, untouched}.

    Field-level ``$set`` semantics: every incoming column overwrites (NULL
    included); columns only the target has survive; new columns appear. With
    ``newer_by`` (a column or a list that both sides have) a target row with a
    later value stays untouched, so the order of batches does not matter.
    """
    keys = list(keys)
    incoming = dedup_keep_last(batch, keys, seq_col) if seq_col else batch.where(
        _valid_keys(keys, allow_empty=True))
    if seq_col and drop_seq:
        incoming = incoming.drop(*_seq(seq_col))
    t_cols = [c for c in target.columns if c not in keys]
    b_cols = [c for c in incoming.columns if c not in keys]
    shared = [c for c in b_cols if c in t_cols]
    t = target.select(*keys, *[F.col(c).alias(f"__t_{c}") for c in t_cols], F.lit(True).alias("__t"))
    b = incoming.select(*keys, *[F.col(c).alias(f"__b_{c}") for c in b_cols], F.lit(True).alias("__b"))
    j = t.join(b, on=keys, how="full")
    has_b = F.col("__b").isNotNull()
    if newer_by:
        has_b = has_b & ~(F.struct(*[F.col(f"__t_{c}").alias(c) for c in _seq(newer_by)])
                          > F.struct(*[F.col(f"__b_{c}").alias(c) for c in _seq(newer_by)]))
    same = reduce(lambda a, c: a & F.col(f"__t_{c}").eqNullSafe(F.col(f"__b_{c}")), shared, F.lit(True))
    change = (F.when(F.col("__t").isNull(), F.lit(INSERTED))
               .when(~has_b, F.lit(UNTOUCHED))
               .when(same, F.lit(UNCHANGED))
               .otherwise(F.lit(MODIFIED)))
    out_cols = [F.col(k) for k in keys]
    for c in t_cols:
        out_cols.append((F.when(has_b, F.col(f"__b_{c}")).otherwise(F.col(f"__t_{c}")) if c in shared
                         else F.col(f"__t_{c}")).alias(c))
    out_cols += [F.when(has_b, F.col(f"__b_{c}")).alias(c) for c in b_cols if c not in t_cols]
    return j.select(*out_cols, change.alias("__change"))


def upsert_merge(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                 seq_col=None) -> DataFrame:
    """The merged table (target columns first, then new incoming columns)."""
    return merge_with_changes(target, batch, keys, seq_col).drop("__change")


def change_counts(merged_with_changes: DataFrame) -> DataFrame:
    """One row: inserted, modified, unchanged, untouched and ``changed`` =
    inserted + modified (what the upsert reports)."""
    c = F.col("__change")
    row = merged_with_changes.agg(*[F.sum((c == F.lit(k)).cast("long")).alias(k)
                                    for k in (INSERTED, MODIFIED, UNCHANGED, UNTOUCHED)])
    row = row.select(*[F.coalesce(F.col(k), F.lit(0)).alias(k)
                       for k in (INSERTED, MODIFIED, UNCHANGED, UNTOUCHED)])
    return row.withColumn("changed", F.col(INSERTED) + F.col(MODIFIED))


def duplicate_key_audit(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """Groups sharing a non-null, non-empty key more than once:
    (keys..., n, keep = first ``order_col``, n_extra = n - 1).

    Ids to delete are not collected into a list: that list is unbounded for a
    hot key. ``dedup_keep_first_by_key`` produces the cleaned table instead.
    """
    return (df.where(_valid_keys(keys, allow_empty=False))
              .groupBy(*keys)
              .agg(F.count(F.lit(1)).alias("n"), F.min(order_col).alias("keep"))
              .where(F.col("n") > 1)
              .withColumn("n_extra", F.col("n") - 1))


def dedup_keep_first_by_key(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """Drop every row but the first (by ``order_col``) of each duplicate
    group; rows with NULL or empty keys are never touched."""
    valid = _valid_keys(keys, allow_empty=False)
    kept = keep_first(df.where(valid), keys, [order_col])
    return kept.unionByName(df.where(~valid | valid.isNull()))
