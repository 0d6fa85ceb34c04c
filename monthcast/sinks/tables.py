"""Sinks: replace, partition-rewriting upsert and count tables, CSV / JSON exports.

The keyed tables are plain Parquet, partitioned by one column. A batch
rewrites the partitions that it touches: the new rows of those partitions are
written to a staging folder beside the table, then take their place by Spark's
dynamic partition overwrite.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from ..operators import upsert as U


#: Codec of the keyed tables: their rows are written three times a batch.
CODEC = "zstd"


def replace(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Full replace. Never call with ``path`` feeding ``df``; use a
    keyed table for read-modify-write."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.save(path)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def export_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_if_there(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The table at ``path``, or None where there is no such path. Any other
    failure is raised: an unreadable table is not an empty one."""
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


class PartitionedTable:
    """Parquet partitioned by ``part_col``, rewritten partition by partition.

    Partitions are folders named by a string made of the partition value, in
    which NULL, the empty string and any other value stay apart; the value
    itself is stored with the rows and keeps its type. Every rewritten
    partition also gets one marked row that readers pass over, so a partition
    whose last row has moved away is overwritten too.

    ``rewrite`` is safe to repeat: a batch whose staging is complete is swapped in
    from there, as after a failure between the two steps. A batch that failed
    has to be repeated before the next one (a restarted stream does so).
    Single writer per table.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], part_col: str):
        self.spark, self.path, self.keys, self.part_col = spark, path.rstrip("/"), list(keys), part_col
        self.folder, self.staging, self.batch_path = f"{part_col}_part", f"{self.path}_staging", f"{self.path}_batch"

    def folder_of(self, value: Column) -> Column:
        text = value.cast("string")
        return (F.when(text.isNull(), "~null").when(text == "", "~empty")
                .when(text.startswith("~"), F.concat(F.lit("~"), text)).otherwise(text))

    def _stored(self, path: str, schema: T.StructType | None = None) -> DataFrame | None:
        """Rows with their folder as a string, whatever its values look like."""
        if schema is None:
            found = read_if_there(self.spark, path)
            if found is None:
                return None
            schema = found.schema
        return read_if_there(self.spark, path, T.StructType([f for f in schema.fields if f.name != self.folder]
                                                            + [T.StructField(self.folder, T.StringType())]))

    def _complete(self, path: str) -> bool:
        done = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return done.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(done)

    def _staged(self) -> DataFrame | None:
        return self._stored(self.staging) if self._complete(self.staging) else None

    def stored(self) -> DataFrame | None:
        """All stored rows with folders; the last staging has all columns that
        the table has got by now."""
        staged = self._staged()
        schema = None if staged is None else T.StructType([f for f in staged.schema if f.name not in ("__batch", "__change")])
        return self._stored(self.path, schema)

    def read(self) -> DataFrame | None:
        rows = self.stored()
        return None if rows is None else rows.where(~F.col("__gone")).drop("__gone", self.folder)

    def staged_batch(self) -> str | None:
        """The batch whose staging is complete."""
        staged = self._staged()
        row = None if staged is None else staged.select("__batch").first()
        return None if row is None else row[0]

    def rows_of(self, touched: DataFrame) -> DataFrame:
        """The stored rows in the ``touched`` folders; only those are scanned,
        and folder names, no more than the table has, are sent to the rows."""
        return self.stored().where(~F.col("__gone")).join(F.broadcast(touched), self.folder, "left_semi").drop("__gone", self.folder)

    def rewrite(self, touched: DataFrame, rows: DataFrame, batch_id: str) -> None:
        """Put ``rows`` (all rows of the ``touched`` folders) in place."""
        marks = touched.select(self.folder, F.lit(True).alias("__gone"))
        (rows.withColumn(self.folder, self.folder_of(F.col(self.part_col))).withColumn("__gone", F.lit(False))
         .unionByName(marks, allowMissingColumns=True).withColumn("__batch", F.lit(str(batch_id)))
         .write.mode("overwrite").option("compression", CODEC).partitionBy(self.folder).parquet(self.staging))
        self.swap()

    def swap(self) -> None:
        """Replace the staged folders. Doing it again gives the same table.
        The rows that arrive are counted, and their keys must be unique."""
        staged = self._staged()
        (staged.drop("__batch", "__change").write.mode("overwrite").option("compression", CODEC).option("partitionOverwriteMode", "dynamic")
         .partitionBy(self.folder).parquet(self.path))
        want = staged.where(~F.col("__gone")).count()
        there = (self.rows_of(staged.select(self.folder).distinct()).groupBy(*self.keys).count()
                 .agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n"), F.max("count").alias("most")).first())
        if there.n != want or (there.most or 1) > 1:
            raise RuntimeError(f"{self.path}: {there.n} rows after the swap, {want} expected; most rows of a key: {there.most}")


class PartitionedUpsertTable(PartitionedTable):
    """Keyed upsert. A key stands in the partition of its newest row: when that
    changes, the old and the new partition are both rewritten.

    Per batch: last-wins de-duplication; the partitions that hold the batch's
    keys now (a semi-join over the key column and the folder names) and those it goes to;
    the merge of the rows in them; ``rewrite``. ``part_value`` is a Column over the batch.
    """

    def upsert(self, batch: DataFrame, batch_id: str, part_value: Column, seq_col=None, newer_by=None) -> dict:
        """Change counts. ``newer_by``: a row of the table that is later by
        these columns stays, so the order of batches does not matter."""
        if self.staged_batch() == str(batch_id):
            self.swap()
            return {"skipped": True, "changed": 0}
        incoming = U.dedup_keep_last(batch, self.keys, seq_col) if seq_col else batch
        others = [c for c in incoming.columns if c != self.part_col]
        incoming.select(*others, part_value.alias(self.part_col)).write.mode("overwrite").option("compression", CODEC).parquet(self.batch_path)
        placed = self.spark.read.parquet(self.batch_path)
        if placed.limit(1).count() == 0:
            return {"skipped": False, "inserted": 0, "modified": 0, "unchanged": 0, "untouched": 0, "changed": 0, "partitions_rewritten": 0}
        stored = self.stored()
        goes_to = placed.select(self.folder_of(F.col(self.part_col)).alias(self.folder)).distinct()
        if stored is None:
            touched, merged = goes_to, placed.withColumn("__change", F.lit(U.INSERTED))
        else:
            placed = placed.withColumn(self.part_col, F.col(self.part_col).cast(stored.schema[self.part_col].dataType))
            lives_in = (stored.where(~F.col("__gone")).select(*self.keys, self.folder)
                        .join(placed.select(*self.keys), self.keys, "left_semi").select(self.folder))
            touched = lives_in.unionByName(goes_to).distinct()
            merged = U.merge_with_changes(self.rows_of(touched), placed, self.keys, newer_by=newer_by)
        self.rewrite(touched, merged, batch_id)
        staged = self._staged()
        counts = U.change_counts(staged.where(~F.col("__gone")).select("__change")).first().asDict()
        return counts | {"partitions_rewritten": staged.select(self.folder).distinct().count(), "skipped": False}


class PeriodCounts(PartitionedTable):
    """Running counts per (period, groups...), kept in one partition a month.

    A batch adds its own counts to the stored rows of the months it touches,
    and no other month is read or written: the cost of a batch is its own rows
    and those months, however large the table is. Each row notes the last
    batch that was added to it; batches come in ascending order, so one that is
    replayed changes nothing. NULL groups count as groups of their own.
    Distinct values are kept as HyperLogLog sketches, which add up.
    """

    SKETCH_K = 14      # relative standard error about 0.8 %

    def __init__(self, spark: SparkSession, path: str, period: str, groups: Sequence[str]):
        super().__init__(spark, path, [period, *groups], "month")
        self.period = period

    def add(self, counts: DataFrame, batch: int) -> None:
        """``counts`` has the keys, n, total and optionally sketch, one row per key."""
        if self.staged_batch() == str(batch):
            return self.swap()
        replace(counts.withColumn("month", F.date_format(self.period, "yyyy-MM")), self.batch_path)
        new = self.spark.read.parquet(self.batch_path)
        if new.limit(1).count() == 0:
            return None
        touched = new.select(self.folder_of(F.col("month")).alias(self.folder)).distinct()
        new = new.withColumn("last_batch", F.lit(int(batch)).cast("long"))
        if self.stored() is not None:
            new = self._added(self.rows_of(touched), new)
        return self.rewrite(touched, new, str(batch))

    def _added(self, old: DataFrame, new: DataFrame) -> DataFrame:
        values = [c for c in new.columns if c not in self.keys]
        o, n = (side.select(*[F.col(c).alias(f"{k}_{c}") for c in self.keys], F.struct(*values).alias(k)) for side, k in ((old, "o"), (new, "n")))
        same = reduce(lambda a, b: a & b, [F.col(f"o_{c}").eqNullSafe(F.col(f"n_{c}")) for c in self.keys])
        applied = F.col("o.last_batch") >= F.col("n.last_batch")
        # a sum over no values is null and adds nothing
        add = {"n": F.col("o.n") + F.col("n.n"), "total": F.coalesce(F.col("o.total") + F.col("n.total"), "o.total", "n.total")}
        if "sketch" in values:
            add["sketch"] = F.hll_union("o.sketch", "n.sketch")
        pick = lambda c: (F.when(F.col("n").isNull() | applied, F.col(f"o.{c}")).when(F.col("o").isNull(), F.col(f"n.{c}"))
                          .otherwise(add.get(c, F.col(f"n.{c}"))))
        return o.join(n, same, "full").select(
            *[F.when(F.col("o").isNotNull(), F.col(f"o_{c}")).otherwise(F.col(f"n_{c}")).alias(c) for c in self.keys],
            *[pick(c).alias(c) for c in values])
