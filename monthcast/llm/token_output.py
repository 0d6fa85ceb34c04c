"""Token-ID / binary output (operator 3).

Texts are encoded by a public tokenizer and written as raw id payloads, in
shards of ascending document id, with a minimal-perfect-hash index over the
document keys.

Payload file ``ids-<shard>.bin``: the ids of the shard's documents one after
another, little-endian, two bytes an id if the vocabulary allows, else four.
Index file ``index-<bucket>.npz``: the keys of one hash bucket. A key's slot
comes from a minimal perfect hash (levels of bit arrays: a key takes the first
level at which its place is its alone; its slot is the rank of that bit); the
slot holds the key's fingerprint (64 bits of another hash), shard, offset and
length, so a lookup reads one slot, and a key that isn't in the index is
refused by its fingerprint. The manifest (Parquet) has a row a shard with its
size and the ids before it; a directory (Parquet) lists every row.

The id stream is the same however often the job runs: shards are ranges of ids
from a deterministic sample, rows sorted by id (then text).

Null text is empty: its document has the end id only. Rows of a repeated id are
all written; the index finds the first of them. A null id is written first and
not indexed. An empty table gives no files and an empty manifest.
"""

from __future__ import annotations

import io
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, given_back, range_bounds, range_index, written
from .files import committed, open_root

END_ID = 2
LEVELS, GAMMA = 40, 2.0
# A vocabulary of bytes begins a new piece at a space between two characters that aren't white space. What ``str`` takes for
# white space holds all that the vocabulary does.
_SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
_RUN = f" [{_SPACES}]|[{_SPACES}] "
_CUT = re.compile(r"(?<=\S) (?=\S)")


# ------------------------------------------------------------------ encoding

class Encoder:
    """Ids of whole texts by the tokenizers library.

    Merges never cross a single space between two words, so the library
    encodes each distinct word (with the space before it) once, many in one
    call, and a text's ids are those of its words in turn, gathered at once
    for a block of texts. Texts that hold an added token go to the library
    whole. ``max_cached`` bounds the words kept between blocks.
    """

    def __init__(self, path: str, max_cached: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        n = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if n <= 1 << 16 else "<u4")
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.spaced = np.array([(self.tokenizer.id_to_token(i) or "").startswith("\u0120") for i in range(n)])
        self.max_cached = max_cached
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}     # word -> its place; start[place]: its first id in ids
        self.ids, self.start = np.zeros(0, self.dtype), np.zeros(1, np.int64)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _packed(self, texts: list[str]) -> list[bytes]:
        return [x.tobytes() for x in self._ids(texts)]

    def _learn(self, words: list[str], at_once: int = 1000) -> None:
        """Keep the ids of new words, each with a space before it. Of the
        tokens of such a word only the first begins with a space."""
        plain = [w for w in words if w and " " not in w and not w[0].isspace() and not w[-1].isspace()]
        known = set(plain) if len(plain) < len(words) else None
        found, sizes = [], []
        for i in range(0, len(plain), at_once):
            some = plain[i: i + at_once]
            ids = self._ids([" " + " ".join(some)])[0]
            first = np.flatnonzero(self.spaced[ids])
            if len(first) != len(some):
                raise ValueError("the vocabulary merges over a space")
            found.append(ids)
            sizes.append(np.diff(np.append(first, len(ids))))
        other = [w for w in words if w not in known] if known is not None else []
        for ids in self._ids([" " + w for w in other]):
            found.append(ids)
            sizes.append(np.array([len(ids)]))
        self.place.update(zip(plain + other, range(len(self.place), len(self.place) + len(words)), strict=True))
        self.ids = np.concatenate([self.ids, *found])
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(np.concatenate(sizes))])

    def _joined(self, words: pa.ListArray) -> list[bytes]:
        """Packed ids of texts, each given as its words."""
        offsets = words.offsets.to_numpy()
        flat = words.values
        # the first word of a text has no space before it
        firsts = self._ids(flat.take(pa.array(offsets[:-1])).to_pylist())
        coded = flat.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.place) > self.max_cached:
            self._forget()
        new = [w for w in distinct if w not in self.place]
        if new:
            self._learn(new)
        at = np.array([self.place[w] for w in distinct], np.int64)[coded.indices.to_numpy()]
        size = self.start[at + 1] - self.start[at]
        size[offsets[:-1]] = 0
        end = np.cumsum(size)
        packed = self.ids[np.repeat(self.start[at] - (end - size), size) + np.arange(end[-1])].tobytes()
        ends = (end[offsets[1:] - 1] * self.dtype.itemsize).tolist()
        return [f.tobytes() + packed[a:b] for f, a, b in zip(firsts, [0, *ends], ends, strict=False)]

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Packed ids of each text."""
        if not len(texts):
            return []
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        whole = np.zeros(len(texts), bool)
        for a in self.added:
            whole |= pc.match_substring(texts, a).to_numpy(zero_copy_only=False)
        runs = pc.match_substring_regex(texts, _RUN).to_numpy(zero_copy_only=False) & ~whole
        out = np.empty(len(texts), object)
        for mask, packed in (
                (whole, lambda t: self._packed(t.to_pylist())),
                (runs, lambda t: self._joined(pa.array([_CUT.split(x) for x in t.to_pylist()], pa.list_(pa.string())))),
                (~whole & ~runs, lambda t: self._joined(pc.split_pattern(t, " ")))):
            if mask.any():
                for i, x in zip(np.flatnonzero(mask).tolist(), packed(texts.filter(pa.array(mask))), strict=True):
                    out[i] = x
        return out.tolist()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


# ------------------------------------------------------- minimal perfect hash

def _hash(keys: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = keys.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(seed + 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return _hash(keys, 1 << 20)


class PerfectHash:
    """Keys to 0 .. n-1 without a gap. ``levels`` are bit arrays; ``rest``
    are keys that found no place of their own in any level (sorted)."""

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray):
        self.levels, self.rest = levels, rest
        self.before = np.cumsum([0] + [int(x.sum()) for x in levels])
        self.ranks = [np.concatenate([[0], np.cumsum(x)]) for x in levels]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        left, levels = np.unique(keys.astype(np.int64)), []
        for level in range(LEVELS):
            if not len(left):
                break
            size = max(64, int(GAMMA * len(left)))
            at = (_hash(left, level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return cls(levels, left)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 where no level has a place for it."""
        keys = keys.astype(np.int64)
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            at = (_hash(keys[open_], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[open_[hit]] = self.before[level] + self.ranks[level][at[hit]]
            open_ = open_[~hit]
        if len(self.rest) and len(open_):
            at = np.minimum(np.searchsorted(self.rest, keys[open_]), len(self.rest) - 1)
            out[open_] = np.where(self.rest[at] == keys[open_], self.before[-1] + at, -1)
        return out

    def dump(self) -> dict[str, np.ndarray]:
        return {"sizes": np.array([len(x) for x in self.levels], np.int64), "rest": self.rest,
                "bits": np.packbits(np.concatenate(self.levels)) if self.levels else np.zeros(0, np.uint8)}

    @classmethod
    def load(cls, d) -> PerfectHash:
        sizes = d["sizes"]
        bits = np.unpackbits(d["bits"])[: int(sizes.sum())].astype(bool)
        return cls(np.split(bits, np.cumsum(sizes)[:-1]) if len(sizes) else [], d["rest"])


# ------------------------------------------------------------------- writing

DIRECTORY = "shard int, key long, offset long, length long, repeated boolean"


def write_tokens(docs: DataFrame, root: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = END_ID, shard_bytes: int = 256 << 20, min_shards: int = 64,
                 bucket_keys: int = 100_000, max_buckets: int = 1 << 20) -> tuple[DataFrame, DataFrame]:
    """Write payload and index files under ``root``; returns the manifest
    (shard, documents, ids, before, buckets) and the directory of all rows
    (shard, key, offset, length, repeated)."""
    total, n = docs.agg(F.sum(F.octet_length(text_col)), F.count("*")).first()
    bounds = range_bounds(docs, id_col, max(min_shards, (total or 0) // shard_bytes + 1))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def encode(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.dtype).tobytes()
        for part in batches(it, 8 << 20):
            ids = [x + end for x in enc.encode(part.column(1))]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    encoded = rows.mapInArrow(given_back(encode), "doc_id long, ids binary").withColumn("shard", range_index(F.col("doc_id"), bounds))
    dealt = encoded.repartition(len(bounds) + 1, "shard").sortWithinPartitions("shard", "doc_id", "ids")

    def write(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = encoder(tokenizer).dtype.itemsize
        rows = ((s, k, x) for b in it for s, k, x in zip(b.column(2).to_pylist(), b.column(0).to_pylist(), b.column(1), strict=True))
        waiting = next(rows, None)
        while waiting is not None:
            shard, at, before, listed = waiting[0], 0, None, []
            with committed(root, f"ids-{shard:06d}.bin") as out:
                while waiting is not None and waiting[0] == shard:
                    _, key, ids = waiting
                    packed = ids.as_buffer()
                    out.write(packed)
                    # rows of one id stand together; the index finds the first
                    listed.append((shard, key, at, packed.size // width, key is None or key == before))
                    at, before = at + packed.size // width, key
                    waiting = next(rows, None)
                    if len(listed) >= 50_000:
                        yield directory(listed)
                        listed = []
            if listed:
                yield directory(listed)

    def directory(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                          names=["shard", "key", "offset", "length", "repeated"])

    listed = written(dealt.mapInArrow(given_back(write), DIRECTORY), "token-directory")
    buckets = min(max_buckets, max(min_shards, n // bucket_keys + 1))
    entries = (listed.where(~F.col("repeated"))
               .select(F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int").alias("bucket"), "key", "shard", "offset", "length")
               .repartition(buckets, "bucket").sortWithinPartitions("bucket"))

    def index(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def emit() -> pa.RecordBatch:
            bucket, key, shard, offset, length = np.concatenate(held, axis=1)
            mph = PerfectHash.build(key)
            slot = mph.slots(key)
            table = {"fingerprint": fingerprints(key), "shard": shard, "offset": offset, "length": length}
            placed = {k: np.empty_like(v) for k, v in table.items()}
            for k, v in table.items():
                placed[k][slot] = v
            packed = io.BytesIO()
            np.savez(packed, **mph.dump(), **placed)
            name = f"index-{int(bucket[0]):07d}.npz"
            with committed(root, name) as out:
                out.write(packed.getvalue())
            return pa.RecordBatch.from_pydict({"bucket": pa.array([int(bucket[0])], pa.int32()), "keys": pa.array([len(key)], pa.int64())})

        for b in it:
            cols = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns])
            for part in np.split(cols, np.flatnonzero(np.diff(cols[0])) + 1, axis=1):
                if held and held[0][0, 0] != part[0, 0]:
                    yield emit()
                    held = []
                held.append(part)
        if held:
            yield emit()

    written(entries.mapInArrow(index, "bucket int, keys long"), "token-index")
    # one row a shard: a small table, ordered at once
    sums = listed.groupBy("shard").agg(F.count("*").alias("documents"), F.sum("length").alias("ids"))
    before = F.sum("ids").over(Window.partitionBy(F.lit(0)).orderBy("shard")) - F.col("ids")
    manifest = sums.select("shard", "documents", "ids", before.alias("before"), F.lit(buckets).alias("buckets"))
    return written(manifest, "token-manifest"), listed


# ------------------------------------------------------------------- reading

def lookup(keys: DataFrame, key_col: str, root: str, buckets: int) -> DataFrame:
    """(key, shard, offset, length) of each distinct key, through the index;
    keys that the index doesn't hold are left out."""
    asked = keys.select(F.col(key_col).cast("long").alias("key")).where(F.col("key").isNotNull()).distinct().withColumn(
        "bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"))

    def find(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = open_root(root)
        now, d, mph = None, None, None
        for b in it:
            key, bucket = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            for part in np.split(np.arange(len(key)), np.flatnonzero(np.diff(bucket)) + 1):
                if not len(part):
                    continue
                if bucket[part[0]] != now:
                    now = bucket[part[0]]
                    name = f"{folder}/index-{int(now):07d}.npz"
                    if fs.get_file_info(name).type.name == "NotFound":
                        now, mph = bucket[part[0]], None
                    else:
                        with fs.open_input_stream(name, compression=None) as f:
                            d = dict(np.load(io.BytesIO(f.read())))
                        mph = PerfectHash.load(d)
                if mph is None:
                    continue
                slot = mph.slots(key[part])
                good = slot >= 0
                good[good] = d["fingerprint"][slot[good]] == fingerprints(key[part][good])
                at = slot[good]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[part][good], pa.int64()), pa.array(d["shard"][at], pa.int32()),
                     pa.array(d["offset"][at], pa.int64()), pa.array(d["length"][at], pa.int64())],
                    names=["key", "shard", "offset", "length"])

    return (asked.repartition(buckets, "bucket").sortWithinPartitions("bucket")
            .mapInArrow(find, "key long, shard int, offset long, length long"))


def read_tokens(places: DataFrame, root: str, width: int, n_shards: int) -> DataFrame:
    """(doc_id, shard, offset, n_tokens, ids_crc32): the ids of the places,
    read from the payload files. CRC over little-endian 32-bit ids."""

    def read(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = open_root(root)
        now, f = None, None
        try:
            for b in it:
                crcs = []
                for shard, offset, length in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                    if shard != now:
                        if f:
                            f.close()
                        now, f = shard, fs.open_input_file(f"{folder}/ids-{shard:06d}.bin")
                    f.seek(offset * width)
                    ids = np.frombuffer(f.read(length * width), f"<u{width}")
                    if len(ids) != length:
                        raise ValueError(f"shard {shard} is cut short")
                    crcs.append(zlib.crc32(ids.astype("<u4").tobytes()))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(crcs, pa.int64())],
                                                 names=["doc_id", "shard", "offset", "n_tokens", "ids_crc32"])
        finally:
            if f:
                f.close()

    return (places.select(F.col("key").alias("doc_id"), "shard", "offset", "length")
            .repartition(n_shards, "shard").sortWithinPartitions("shard", "offset")
            .mapInArrow(read, "doc_id long, shard int, offset long, n_tokens long, ids_crc32 long"))


def tokens_written(docs: DataFrame, root: str, tokenizer: str, id_col: str = "doc_id", **options) -> DataFrame:
    """Write ``docs``, then read every document back: keys go through the
    index; rows of a repeated or null id, which it doesn't hold, through the
    directory. (doc_id, start, n_tokens, ids_crc32)."""
    manifest, listed = write_tokens(docs, root, tokenizer, id_col=id_col, **options)
    head = manifest.agg(F.count("*"), F.max("buckets")).first()
    found = lookup(docs, id_col, root, head[1] or 1)
    places = found.unionByName(listed.where("repeated").select("key", "shard", "offset", "length"))
    read = read_tokens(places, root, encoder(tokenizer).dtype.itemsize, max(1, head[0]))
    return (read.join(manifest.select("shard", "before"), "shard")
            .select("doc_id", (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"))
