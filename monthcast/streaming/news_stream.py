"""Structured Streaming: incremental, idempotent loads.

* ``stream_upsert``: file source (declared schema) -> per micro-batch
  last-wins dedup + keyed merge into a partitioned table (``foreachBatch``); only
  the partitions a batch touches are rewritten.
* ``stream_period_counts``: running counts (and distinct-value sketches) per
  day or calendar month and group; a micro-batch adds to the months it touches.
* ``stream_first_seen``: append-only de-duplication within a watermark, with the
  number of rows that came too late.

A restarted query replays its last batch at most, and that changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.tables import CODEC, PartitionedUpsertTable, PeriodCounts


#: Micro-batches that landed rows are streamed in, and the rows of a landed file.
BATCHES, FILE_ROWS = 4, 20_000


def land(df: DataFrame, path: str, by: Sequence[str], ordered: bool = False, fmt: str = "parquet", batches: int = BATCHES) -> int:
    """Write ``df`` as files for a stream, dealt by the columns ``by`` (with
    ``ordered``, in ranges of them); returns how many files a trigger takes.

    The files grow in number, not in size, with the rows, so no task gathers a
    whole micro-batch; there are about ``batches`` of those however many files."""
    files = max(batches, -(-df.count() // FILE_ROWS))
    dealt = df.repartitionByRange(files, *by) if ordered else df.repartition(files, *by)
    writer = dealt.write.option("compression", CODEC) if fmt == "parquet" else dealt.write
    writer.format(fmt).save(path)
    return -(-files // batches)


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                files_per_trigger: int = 1) -> DataFrame:
    return (spark.readStream.schema(schema).format(fmt)
            .option("maxFilesPerTrigger", files_per_trigger).load(path))


def _run(writer, apply, checkpoint: str, query_name: str) -> None:
    writer.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).queryName(query_name).start().awaitTermination()


def stream_upsert(stream: DataFrame, table_root: str, keys: Sequence[str], seq_cols: Sequence[str], checkpoint: str,
                  partition_col: str, part_value: Column, query_name: str = "upsert") -> list[dict]:
    """Run to completion over what is available; returns per-batch counts.
    The latest row of a key by ``seq_cols`` wins, in whatever order files come."""
    table = PartitionedUpsertTable(stream.sparkSession, table_root, keys, partition_col)
    log: list[dict] = []

    def apply(batch: DataFrame, batch_id: int) -> None:
        counts = table.upsert(batch, f"{query_name}-{batch_id}", part_value, seq_col=list(seq_cols), newer_by=list(seq_cols))
        log.append(counts | {"batch_id": batch_id})

    _run(stream.writeStream, apply, checkpoint, query_name)
    return log


def payload_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 1) -> DataFrame:
    """Landed provider payloads (one JSON document per line) as a stream."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
            .json(path))


def stream_payload_upsert(spark: SparkSession, landing: str, schema: T.StructType, flatten, table_root: str, checkpoint: str,
                          part_value: Column, keys: Sequence[str] = ("url",), seq_cols: Sequence[str] = ("seen_date",),
                          partition_col: str = "load_month", query_name: str = "payload_upsert", files_per_trigger: int = 1) -> list[dict]:
    """Payload files -> provider flattener (explode, nested fields) -> keyed
    upsert per micro-batch. ``flatten`` is one of ``sources.payloads.flatten_*``
    and runs on the parsed struct columns of each batch."""
    return stream_upsert(flatten(payload_stream(spark, landing, schema, files_per_trigger)), table_root, list(keys), list(seq_cols),
                         checkpoint, partition_col, part_value, query_name=query_name)


def stream_period_counts(stream: DataFrame, ts_col: str, group_cols: Sequence[str], value_col: str, table_root: str, checkpoint: str,
                         period: str = "day", distinct_col: str | None = None, query_name: str = "period_counts") -> PeriodCounts:
    """(window_start, groups..., n, total[, sketch]) per ``period`` ("day" or
    "month") and group, added up over the micro-batches.

    The counts themselves are the state, so it never has to expire and no row
    is too late. Rows without a time are left out. ``distinct_col`` adds a
    HyperLogLog sketch of its values (``F.hll_sketch_estimate`` reads it)."""
    if period not in ("day", "month"):
        raise ValueError(f"no such period: {period}")
    table = PeriodCounts(stream.sparkSession, table_root, "window_start", group_cols)
    start = F.date_trunc(period, F.col(ts_col).cast("timestamp"))
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(value_col).alias("total")]
    if distinct_col:
        aggs.append(F.hll_sketch_agg(distinct_col, F.lit(PeriodCounts.SKETCH_K)).alias("sketch"))

    def apply(batch: DataFrame, batch_id: int) -> None:
        table.add(batch.where(F.col(ts_col).isNotNull()).groupBy(start.alias("window_start"), *group_cols).agg(*aggs), batch_id)

    _run(stream.writeStream, apply, checkpoint, query_name)
    return table


def dedup_within_watermark(stream: DataFrame, keys: Sequence[str], ts_col: str, delay: str) -> DataFrame:
    """Append-only first-seen de-duplication; state expires with the watermark."""
    timed = stream.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
    return timed.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_first_seen(stream: DataFrame, keys: Sequence[str], ts_col: str, delay: str, out_path: str, checkpoint: str,
                      query_name: str = "first_seen") -> int:
    """Append each key's first row to the Parquet table ``out_path``; returns how
    many rows came later than the watermark and were dropped for it.

    Equal to the batch de-duplication as long as copies of a key come within
    ``delay`` of each other in event time and no row is late. Rows without a time
    never pass a watermark and belong in the reject counts instead."""
    first = dedup_within_watermark(stream.where(F.col(ts_col).isNotNull()), keys, ts_col, delay)
    query = (first.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint)
             .outputMode("append").trigger(availableNow=True).queryName(query_name).start())
    query.awaitTermination()
    return sum(int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress for op in p["stateOperators"])
