"""Approximate nearest neighbours (operator 13): cross-polytope hashing.

Each table turns a unit vector by three rounds of random signs and a fast
Hadamard transform (a pseudo-rotation, dimension padded to a power of two) and
assigns it to the nearest signed axis. Every row is indexed in every table. A
query ranks all (table, axis) places by its own coordinate there, and probes
the first of them; the rows of the probed places are its candidates, whose
exact Euclidean distances on the original vectors give the result.

How many places are probed is measured, not set: for a bounded sample of
queries (``sample_queries``, the smallest hashes) the true neighbours are found by
brute force over all rows, and the least number of probes whose recall on the
sample reaches ``recall`` is taken. Where that many probes would open more rows
than one table holds, all axes of the first table are probed: that is every row
once, and exact. A query that found fewer than ``k`` rows in its probed places
gets that as well. So no setting drops neighbours by size, and where vectors have no
neighbours to speak of (uniform noise) the search turns into a scan in blocks.

Scale: rows are grouped by place, places cut into blocks of at most about
``block_bytes`` of rows and of queries by a hash of the row, so a place that holds
a third of all rows (copies of one vector) is many tasks. Each task multiplies
its queries with its rows and passes on the ``k`` best of each query; the merge
keeps a bounded number a query in each task before its shuffle. Vectors are
kept once with their places and copied to them only for that shuffle. Counts
per place (tables x axes numbers for each dimension, ``MAX_DIMENSIONS`` of them at
most) and the sample are all that reaches the driver.

Vectors that are null or empty, zero, or hold null or non-finite components
take no part, nor do rows without an id. Vectors of different dimension aren't
compared. Equal distances go to the smaller id. Repeated rows (same id and
vector) are counted and take as many ranks; a query row passes over itself
once, so its other copies are its nearest rows, and a repeated query row gives
its result as often. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, written

MAX_DIMENSIONS = 1000      # different ones in one table
INDEXED = "row long, id long, copies long, asked long, dim int, vec binary, places array<int>"
PROBED = "row long, asked long, dim int, place int, vec binary"


def usable(vec: Column) -> Column:
    """Whether a vector takes part."""
    v = vec.cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce((F.size(v) > 0) & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0), F.lit(False))


class Rotations:
    """The pseudo-rotations of one dimension; the same wherever they are made."""

    def __init__(self, dim: int, tables: int, seed: int):
        self.dim, self.size = dim, 1 << max(1, (dim - 1).bit_length())
        rng = np.random.default_rng([seed, dim])
        self.signs = rng.integers(0, 2, (tables, 3, self.size)) * 2.0 - 1.0
        self.axes = 2 * self.size

    def __call__(self, vectors: np.ndarray, table: int) -> np.ndarray:
        """Coordinates of unit vectors along the signed axes (positive ones first)."""
        largest = np.abs(vectors).max(axis=1, keepdims=True)      # before squaring: no overflow
        x = vectors / largest
        x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
        x = np.pad(x, ((0, 0), (0, self.size - self.dim)))
        for signs in self.signs[table]:
            x = x * signs
            half = 1
            while half < self.size:
                two = x.reshape(len(x), -1, 2, half)
                x = np.stack([two[:, :, 0] + two[:, :, 1], two[:, :, 0] - two[:, :, 1]], axis=2).reshape(len(x), self.size)
                half *= 2
            x = x / np.sqrt(self.size)
        return np.concatenate([x, -x], axis=1)


def distances(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact Euclidean distances of pairs of vectors, summed in order of the components."""
    total = np.zeros(len(rows))
    for j in range(rows.shape[1]):
        gap = queries[:, j] - rows[:, j]
        total += gap * gap
    return np.sqrt(total)


def nearest(queries: np.ndarray, query_rows: np.ndarray, vecs: np.ndarray, ids: np.ndarray, rows: np.ndarray,
            copies: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query index, row index, exact distance) of at least each query's ``k``
    nearest rows of the block; by query, nearest first, ties to the smaller id."""
    scale = max(np.abs(queries).max(), np.abs(vecs).max())
    q, r = queries / scale, vecs / scale
    own = (r * r).sum(axis=1)
    close = 1e-9 * max(1.0, float(own.max()))
    step = max(1, (1 << 21) // len(r))
    for i in range(0, len(q), step):
        square = own[None, :] - 2 * (q[i: i + step] @ r.T)      # but for the query's own square
        square[(query_rows[i: i + step, None] == rows[None, :]) & (copies == 1)[None, :]] = np.inf
        kth = np.partition(square, min(k, len(r)) - 1, axis=1)[:, min(k, len(r)) - 1]
        # rows that rounding could put among the k nearest are measured exactly
        of, at = np.nonzero((square <= kth[:, None] + close) & np.isfinite(square))
        exact, pairs = np.empty(len(of)), max(1, (1 << 22) // r.shape[1])
        for j in range(0, len(of), pairs):
            exact[j: j + pairs] = distances(queries[i + of[j: j + pairs]], vecs[at[j: j + pairs]])
        order = np.lexsort((rows[at], ids[at], exact, of))
        of, at, exact = of[order], at[order], exact[order]
        keep = np.arange(len(of)) - np.searchsorted(of, of) < k
        yield i + of[keep], at[keep], exact[keep]


def _lists(lists: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(starts, components) of an array of vectors."""
    lists = lists.cast(pa.large_list(pa.float32() if kind == "<f4" else pa.float64()))
    offsets = lists.offsets.to_numpy()
    return offsets - offsets[0], lists.flatten().to_numpy(zero_copy_only=False)


def _packed(vecs: pa.Array, dim: int, kind: str) -> np.ndarray:
    vecs = vecs.combine_chunks() if isinstance(vecs, pa.ChunkedArray) else vecs
    return np.frombuffer(b"".join(vecs.to_pylist()), kind).reshape(-1, dim).astype(np.float64)


def _by_dim(b: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = b.column(b.schema.get_field_index("dim")).to_numpy(zero_copy_only=False)
    for dim in np.unique(dims).tolist():
        yield dim, b.take(pa.array(np.flatnonzero(dims == dim)))


def indexed(table: DataFrame, is_query: Column, id_col: str, vec_col: str, tables: int, seed: int) -> DataFrame:
    """Each different row once, with its place in each table (table number
    times axes plus nearest axis), its copies, and how many of them ask."""
    kind = "<f4" if dict(table.dtypes)[vec_col] == "array<float>" else "<f8"
    vec = F.col(vec_col) if kind == "<f4" else F.col(vec_col).cast("array<double>")
    rows = (table.where(usable(F.col(vec_col)) & F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("id"), vec.alias("vec"), F.coalesce(is_query, F.lit(False)).alias("asks"))
            .groupBy(F.xxhash64("id", "vec").alias("row"))
            .agg(F.any_value("id").alias("id"), F.any_value("vec").alias("vec"), F.count("*").alias("copies"),
                 F.count_if("asks").alias("asked")))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, Rotations] = {}
        for b in batches(it, 1 << 20):
            starts, flat = _lists(b.column(2), kind)
            sizes = np.diff(starts)
            for dim in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == dim)
                vecs = flat[starts[at][:, None] + np.arange(dim)[None, :]]
                turn = turns.setdefault(dim, Rotations(dim, tables, seed))
                places = np.stack([turn(vecs.astype(np.float64), t).argmax(axis=1) + t * turn.axes for t in range(tables)], axis=1)
                mine = b.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [mine.column(0), mine.column(1), mine.column(3), mine.column(4), pa.array(np.full(len(at), dim, np.int32)),
                     pa.array([v.tobytes() for v in vecs.astype(kind)], pa.binary()),
                     pa.array(list(places.astype(np.int32)), pa.list_(pa.int32()))],
                    names=["row", "id", "copies", "asked", "dim", "vec", "places"])

    return written(rows.mapInArrow(run, INDEXED), "nearest-index")


def _first(found: DataFrame, by: str, k: int) -> DataFrame:
    """The ``k`` first rows of each ``by``; Spark keeps ``k`` a task before its shuffle."""
    w = Window.partitionBy(by).orderBy("score", "vec_id", "row")
    return found.withColumn("at", F.row_number().over(w)).where(F.col("at") <= k).drop("at")


def sampled_neighbours(index: DataFrame, sample: list[tuple], k: int, kind: str) -> dict[int, list[np.ndarray]]:
    """The true nearest rows of each sampled query, by brute force over all rows."""
    by_dim: dict[int, list[int]] = {}
    for i, (_, v) in enumerate(sample):
        by_dim.setdefault(len(v), []).append(i)
    sent = index.sparkSession.sparkContext.broadcast((sample, by_dim))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, groups = sent.value
        for b in batches(it, 4 << 20):
            for dim, part in _by_dim(b):
                mine = groups.get(dim, [])
                if mine:
                    rows, ids, copies = (part.column(c).to_numpy(zero_copy_only=False) for c in range(3))
                    q = np.array([queries[i][1] for i in mine])
                    for of, at, d in nearest(q, np.array([queries[i][0] for i in mine]), _packed(part.column(4), dim, kind),
                                             ids, rows, copies, k):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.array(mine, np.int32)[of]), pa.array(ids[at]), pa.array(rows[at]), pa.array(d),
                             part.column(4).take(pa.array(at))], names=["q", "vec_id", "row", "score", "vec"])

    found = index.select("row", "id", "copies", "dim", "vec").mapInArrow(run, "q int, vec_id long, row long, score double, vec binary")
    out: dict[int, list[np.ndarray]] = {}
    for r in _first(found, "q", k).collect():
        out.setdefault(r.q, []).append(np.frombuffer(r.vec, kind).astype(np.float64))
    return out


def probes(sample: list[tuple], neighbours: dict[int, list], counts: dict, tables: int, seed: int, recall: float) -> dict[int, int]:
    """For each dimension, the least number of probes that finds ``recall`` of the
    sampled queries' true neighbours; 0 (all axes of the first table) where
    that opens fewer rows, or where no query was sampled."""
    out = {}
    for dim, count in counts.items():
        turn, need, opened = Rotations(dim, tables, seed), [], []
        for i, (_, v) in enumerate(sample):
            if len(v) != dim:
                continue
            along = np.concatenate([turn(v[None, :], t)[0] for t in range(tables)])
            order = np.argsort(-along, kind="stable")
            turn_of = np.empty(len(order), np.int64)
            turn_of[order] = np.arange(len(order))
            opened.append(np.cumsum(count[order]))
            for x in neighbours.get(i, []):
                need.append(min(turn_of[t * turn.axes + int(turn(x[None, :], t)[0].argmax())] for t in range(tables)))
        n = int(np.sort(need)[int(np.ceil(recall * len(need))) - 1]) + 1 if need else 0
        out[dim] = n if n and np.mean([o[n - 1] for o in opened]) < count[: turn.axes].sum() else 0
    return out


def probed(queries: DataFrame, how_many: dict[int, int], counts: dict, tables: int, seed: int, kind: str) -> DataFrame:
    """(row, asked, dim, place, vec): each query at the places that it probes."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, Rotations] = {}
        for b in batches(it, 1 << 17):
            for dim, part in _by_dim(b):
                turn, n, vecs = turns.setdefault(dim, Rotations(dim, tables, seed)), how_many[dim], _packed(part.column(3), dim, kind)
                if n:
                    along = np.concatenate([turn(vecs, t) for t in range(tables)], axis=1)
                    order = np.argsort(-along, axis=1, kind="stable")[:, :n]
                else:
                    order = np.broadcast_to(np.arange(turn.axes), (len(vecs), turn.axes))
                of, place = np.repeat(np.arange(len(vecs)), order.shape[1]), order.reshape(-1)
                real = counts[dim][place] > 0
                some = part.take(pa.array(of[real]))
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), some.column(2),
                                                  pa.array(place[real].astype(np.int32)), some.column(3)],
                                                 names=["row", "asked", "dim", "place", "vec"])

    return written(queries.select("row", "asked", "dim", "vec").mapInArrow(run, PROBED), "nearest-probes")


def candidates_ranked(index: DataFrame, asking: DataFrame, counts: dict, k: int, tables: int, block_bytes: int, kind: str) -> DataFrame:
    """(query, asked, vec_id, row, copies, score): of each query the ``k`` nearest different
    rows of all places that it probes."""
    per_block = {d: max(64, block_bytes // (8 * d)) for d in counts}
    # every block of rows meets every block of queries of its place
    cut = index.sparkSession.createDataFrame(
        [(r.dim, r.place, -(-int(counts[r.dim][r.place]) // per_block[r.dim]), -(-r["count"] // per_block[r.dim]))
         for r in asking.groupBy("dim", "place").count().collect()], "dim int, place int, row_blocks int, query_blocks int")

    def dealt(side: DataFrame, mine: str, other: str) -> tuple[DataFrame, Column, Column]:
        at = F.pmod(F.xxhash64("row", F.lit(mine)), F.col(mine)).cast("int")
        return side.join(F.broadcast(cut), ["dim", "place"]), at, F.explode(F.sequence(F.lit(0), F.col(other) - 1))

    rows, at, each = dealt(index.select("row", "id", "copies", "dim", "vec", F.explode("places").alias("place")), "row_blocks", "query_blocks")
    rows = rows.select("dim", "place", at.alias("row_block"), each.alias("query_block"), F.lit(False).alias("asks"),
                       "row", "id", "copies", "vec")
    asks, at, each = dealt(asking, "query_blocks", "row_blocks")
    asks = asks.select("dim", "place", each.alias("row_block"), at.alias("query_block"), F.lit(True).alias("asks"),
                       "row", F.lit(0).cast("long").alias("id"), F.col("asked").alias("copies"), "vec")

    def best(key: tuple, group: pa.Table) -> pa.Table:
        dim, asks = key[0].as_py(), group["asks"].to_numpy()
        vecs = _packed(group["vec"], dim, kind)
        row, ids, copies = (group[c].to_numpy() for c in ("row", "id", "copies"))
        found = list(nearest(vecs[asks], row[asks], vecs[~asks], ids[~asks], row[~asks], copies[~asks], k)
                     ) if asks.any() and not asks.all() else []
        of, at, d = (np.concatenate([f[c] for f in found]) if found else np.zeros(0, int) for c in range(3))
        return pa.table({"query": row[asks][of], "asked": copies[asks][of], "vec_id": ids[~asks][at], "row": row[~asks][at],
                         "copies": copies[~asks][at], "score": d.astype(np.float64)})

    cells = rows.unionByName(asks).groupBy("dim", "place", "row_block", "query_block").applyInArrow(
        best, "query long, asked long, vec_id long, row long, copies long, score double")
    # a row may come from every table
    return _first(cells, "query", k * tables).dropDuplicates(["query", "row"])


def search(table: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10, tables: int = 8,
           recall: float = 0.97, sample_queries: int = 64, block_bytes: int = 4 << 20, seed: int = 11) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows of every row for
    which ``is_query`` holds, among all other rows."""
    kind = "<f4" if dict(table.dtypes)[vec_col] == "array<float>" else "<f8"
    index = indexed(table, is_query, id_col, vec_col, tables, seed)
    queries = index.where("asked > 0")
    sample = [(r.row, np.frombuffer(r.vec, kind).astype(np.float64)) for r in
              queries.select("row", "vec").orderBy(F.xxhash64("row", F.lit(seed)), "row").limit(sample_queries).collect()]
    dims = [r[0] for r in queries.select("dim").distinct().limit(MAX_DIMENSIONS + 1).collect()]
    if len(dims) > MAX_DIMENSIONS:
        raise ValueError(f"queries have more than {MAX_DIMENSIONS} different dimensions")
    counts = {d: np.zeros(tables * Rotations(d, 1, seed).axes, np.int64) for d in dims}
    for r in index.where(F.col("dim").isin(dims)).select("dim", F.explode("places").alias("place")).groupBy("dim", "place").count().collect():
        counts[r.dim][r.place] = r["count"]
    how_many = probes(sample, sampled_neighbours(index, sample, k, kind), counts, tables, seed, recall)

    def found_by(some: DataFrame, how: dict[int, int]) -> DataFrame:
        return candidates_ranked(index, probed(some, how, counts, tables, seed, kind), counts, k, tables, block_bytes, kind)

    found = found_by(queries, how_many)
    if any(how_many.values()):
        found = written(found, "nearest-found")
        own = (F.col("query") == F.col("row")).cast("long")
        enough = found.groupBy("query").agg(F.sum(F.col("copies") - own).alias("n")).where(F.col("n") >= k).select(F.col("query").alias("row"))
        short = written(queries.join(enough, "row", "left_anti"), "nearest-short")
        if short.limit(1).count():
            rest = written(found_by(short, dict.fromkeys(dims, 0)), "nearest-rest")
            found = found.join(rest.select("query"), "query", "left_anti").unionByName(rest)
    # ranks by copies: a row takes as many as it has, but for the query's own
    w = Window.partitionBy("query").orderBy("score", "vec_id", "row").rowsBetween(Window.unboundedPreceding, 0)
    own = F.when(F.col("query") == F.col("row"), 1).otherwise(0)
    ranks = (found.withColumn("n", F.col("copies") - own).withColumn("upto", F.sum("n").over(w))
             .where((F.col("n") > 0) & (F.col("upto") - F.col("n") < k))
             .select("query", "asked", "vec_id", "score",
                     F.explode(F.sequence(F.col("upto") - F.col("n") + 1, F.least(F.col("upto"), F.lit(k)))).alias("rank")))
    ids = queries.select(F.col("row").alias("query"), F.col("id").alias("query_id"))
    return (ranks.join(ids, "query").withColumn("_again", F.explode(F.sequence(F.lit(1).cast("long"), F.col("asked"))))
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
