"""Shared helpers: byte-level tokenising with numpy, hot-key-safe joins,
deterministic range boundaries and written intermediate tables."""

from __future__ import annotations

import ctypes
from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

SALTS = 64


# ---------------------------------------------------------------- tables

def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: cuts
    the lineage, and survives the loss of any executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def per_key_back(rows: DataFrame, keys: Sequence[str], aggs: dict[str, Column], merge: dict[str, Column],
                 where: Column | None = None, how: str = "left", salt_on: Column | None = None) -> DataFrame:
    """Join a per-key aggregate back to ``rows`` without a hot key's rows
    meeting in one task.

    ``aggs`` aggregates ``rows`` per (keys, salt); ``merge`` merges those
    partial results (by the same names) per key; ``where`` keeps only some
    merged keys. The merged values then go only to the salts a key really has,
    so both sides of the join are spread over up to ``SALTS`` tasks a key.
    """
    salt_on = salt_on if salt_on is not None else F.xxhash64(*[F.col(c) for c, t in rows.dtypes
                                                               if not t.startswith("map")])
    salted = rows.withColumn("_salt", F.pmod(salt_on, F.lit(SALTS)).cast("int"))
    part = salted.groupBy(*keys, "_salt").agg(*[c.alias(n) for n, c in aggs.items()])
    whole = part.groupBy(*keys).agg(F.collect_set("_salt").alias("_salts"),
                                    *[c.alias(n) for n, c in merge.items()])
    if where is not None:
        whole = whole.where(where)
    back = whole.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
                        F.explode("_salts").alias("_to_salt"), *merge)
    cond = F.col("_salt") == F.col("_to_salt")
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    return salted.join(back, cond, how).select(*rows.columns, *merge)


def row_key(id_col: str, text_col: str) -> Column:
    """Tells rows apart by id and text, also where the id is null or repeated."""
    return F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))


def packed_texts(rows: DataFrame) -> DataFrame:
    """(row_key, packed): whole texts compressed, for a shuffle."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for b in batches(it):
            texts = [pack((x or "").encode()) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.binary())], names=["row_key", "packed"])

    return rows.select("row_key", "text").mapInArrow(run, "row_key long, packed binary")


def unpack(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


# ---------------------------------------------------- deterministic ranges

def range_bounds(df: DataFrame, key: str, n: int, per_range: int = 16) -> list:
    """At most ``n - 1`` cut points of an integer key into even ranges.

    Taken from a deterministic sample by hash of the key (about
    ``per_range * n`` keys reach the driver), so the same rows always give the
    same ranges, however they are stored. Any cut points give right results.
    """
    if n <= 1:
        return []
    total = df.where(F.col(key).isNotNull()).agg(F.count("*")).first()[0]
    step = max(1, total // (per_range * n))
    rows = (df.where(F.col(key).isNotNull()).where(F.pmod(F.xxhash64(F.col(key)), F.lit(step)) == 0)
            .groupBy(key).count().select(key).collect())
    keys = sorted(r[0] for r in rows)
    if not keys:
        return []
    return sorted({keys[len(keys) * i // n] for i in range(1, n)})


def range_index(key: Column, bounds: Sequence[int]) -> Column:
    """The range of ``key`` (0 .. len(bounds)); null keys fall in range 0.
    A native binary search over the literal cut points."""
    if not bounds:
        return F.lit(0)
    cuts = F.lit([int(b) for b in bounds])
    steps = F.lit(list(range(max(1, len(bounds).bit_length()))))
    # lo = number of cut points known to be <= key, hi = one past the last candidate
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))

    def step(acc: Column, _: Column) -> Column:
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        done = acc["lo"] >= acc["hi"]
        right = F.get(cuts, mid) <= key
        return F.struct(F.when(done, acc["lo"]).when(right, mid + 1).otherwise(acc["lo"]).alias("lo"),
                        F.when(done, acc["hi"]).when(right, acc["hi"]).otherwise(mid).alias("hi"))

    return F.when(key.isNull(), F.lit(0)).otherwise(F.aggregate(steps, start, step, lambda a: a["lo"]))


def range_of(value: int | None, bounds: Sequence[int]) -> int:
    return 0 if value is None else bisect_right(bounds, value)


# --------------------------------------------------- byte-level tokenising

def _table(separators: Sequence[int], lower: bool) -> np.ndarray:
    """Byte -> byte; every separator becomes a space, which is one always."""
    t = np.arange(256, dtype=np.uint8)
    if lower:
        t[65:91] += 32
    t[list(separators)] = 0x20
    return t


WHITESPACE = [0x20, *range(0x09, 0x0E)]
NOT_WORD = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
PLAIN_WORDS = _table(WHITESPACE, lower=False)          # [^\x20\x09-\x0D]+, unchanged
LOWER_WORDS = _table(WHITESPACE, lower=True)           # the same after lower-casing A-Z
LOWER_ALNUM = _table(NOT_WORD, lower=True)             # [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z

def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (public xor-shift-multiply form)."""
    x = (x + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


@dataclass
class Words:
    """Words of a block of texts. ``first[d]:first[d+1]`` are the words of
    text ``d``; ``start``/``end`` are byte offsets into ``data``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.first) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word, whatever block it stands in (eight bytes
        of every word at a time)."""
        size = (self.end - self.start).astype(np.uint64)
        if not len(size):
            return np.zeros(0, np.uint64)
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(self.data) + 1,), "<u8", padded.data, strides=(1,))
        with np.errstate(over="ignore"):
            h = mix(size)
            left, at, rest = np.arange(len(size)), self.start, size
            while len(left):
                short = np.minimum(rest, np.uint64(8))
                v = eight[at] & (~np.uint64(0) >> (np.uint64(64) - np.uint64(8) * short))
                h[left] = mix(h[left] ^ v)
                more = rest > 8
                left, at, rest = left[more], at[more] + 8, rest[more] - np.uint64(8)
        return h


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string array; null texts are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if len(texts) == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0]: offsets[-1]]


def words_of(texts: pa.Array, table: np.ndarray) -> Words:
    """Words by a byte table (separators are ASCII, so bytes suffice)."""
    offsets, raw = text_buffers(texts)
    data = table[raw]
    inside = data != 0x20
    # a word never runs on into the next text
    before = np.empty(len(data), bool)
    if len(data):
        before[0] = False
        before[1:] = inside[:-1]
        before[offsets[:-1][offsets[:-1] < len(data)]] = False
        start = np.flatnonzero(inside & ~before)
        after = np.empty(len(data), bool)
        after[-1] = False
        after[:-1] = inside[1:]
        after[(offsets[1:] - 1)[offsets[1:] > offsets[:-1]]] = False
        end = np.flatnonzero(inside & ~after) + 1
    else:
        start = end = np.zeros(0, np.int64)
    return Words(data, start, end, np.searchsorted(start, offsets).astype(np.int64))


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` word hashes (length ``len(h) - n + 1``)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(len(h) - n + 1, np.uint64)
        for i in range(n):
            out = out * np.uint64(0xD1342543DE82EF95) + h[i: len(h) - n + 1 + i]
        return mix(out)


def given_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, after which the Python worker returns the memory it has freed:
    workers live on, and what one task took at most would stay theirs."""

    def wrapped(it: Iterator) -> Iterator:
        try:
            yield from run(it)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # of glibc only
            if trim:
                trim(0)

    return wrapped


def batches(it: Iterator[pa.RecordBatch], max_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in blocks of about ``max_bytes`` at most (one row at least)."""
    for b in it:
        rows = max(1, min(b.num_rows, int(b.num_rows * max_bytes / max(1, b.nbytes))))
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)
