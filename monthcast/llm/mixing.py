"""Mixing sources to target weights (operator 10): Pareto order sampling.

Targets: the sources share ``total`` words by weight; a source's target stops
at ``max_epochs`` times its size and the excess is reshared by weight until
none is above (computed at once from the sorted cap/weight ratios).

Sampling: a source that needs ``r`` times its words takes ``floor(r)`` whole
copies of every document for certain, and the rest by order sampling: document
``i`` with remaining inclusion probability ``p_i`` gets the Pareto rank
``(u / (1 - u)) / (p_i / (1 - p_i))`` of a hash-based uniform ``u``, and ranks
are taken in ascending order until the source's words are reached (the size is
fixed in words, so the mix ends within one document of its target). ``weight``
makes the expected copies unequal within a source: expected copies are
``r * weight / (mean weight by words)``, at most ``max_epochs``.

What is ranked are units: of equal rows (same id, text, source and weight) the
first, second, ... copy each has a rank of its own, by a hash of the row and its
number. So null ids and repeated rows, however many, are drawn one by one.

Scale: equal rows are counted before anything else, and their numbers come from
the count, so a row that is a third of the table meets in no task. The cut of each source is found from word counts per rank bin, then
exactly within the one bin that holds it; no source meets in one task. The cut
is a number per source, so applying it needs no shuffle of texts.

Null text counts 0 words, and texts of any length are counted whole; null source
is a source of its own (last by order); a null id is an id like another; an
empty table gives an empty mix. Ranks hash the row and the seed, so reruns
agree; which of equal rows that differ in further columns is taken follows a
hash of all columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SALTS, fresh, written

BINS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), share: float = 1.0,
                   max_epochs: float = 3.0) -> DataFrame:
    """(source, source_size) -> (source, source_size, target).

    The table has one row per source. Sources by code point, null last, take
    the weights in turn. A source is capped while its cap/weight lies below
    the level that the rest would get.
    """
    one = F.lit(0)
    by_name = Window.partitionBy(one).orderBy(F.col("source").cast("binary").asc_nulls_last())
    by_ratio = Window.partitionBy(one).orderBy("ratio", F.col("source").cast("binary").asc_nulls_last())
    cycle = F.lit([float(w) for w in weights])
    t = (sizes.withColumn("w", F.get(cycle, F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))))
         .withColumn("cap", F.lit(float(max_epochs)) * F.col("source_size"))
         .withColumn("ratio", F.col("cap") / F.col("w"))
         .withColumn("total", F.lit(float(share)) * F.sum("source_size").over(Window.partitionBy(one))))
    before, rest = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    t = t.withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                     / F.sum("w").over(rest))
    # the level of the first source that is not capped holds for all after it
    t = t.withColumn("free", F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "level")))
                     .over(Window.partitionBy(one)))
    return t.select("source", "source_size",
                    F.when(F.col("free").isNull() | (F.col("ratio") < F.col("free.ratio")), F.col("cap"))
                    .otherwise(F.least(F.col("cap"), F.col("free.level") * F.col("w"))).alias("target"))


def _uniform(row: Column, number: Column, seed: int) -> Column:
    """Uniform in (0, 1) from a hash of a row and the number of its copy."""
    return (F.pmod(F.xxhash64(row, number.cast("long"), F.lit(seed)), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))


def _row(id_col: str, text_col: str, source_col: str, weight: Column) -> Column:
    nulls = F.concat(*[F.col(c).isNull().cast("string") for c in (id_col, text_col, source_col)])
    return F.xxhash64(F.col(id_col), F.col(text_col), F.col(source_col), weight, nulls)


def _copies(target: Column, weighted: Column, weight: Column, epochs: float, u: Column) -> tuple[Column, Column]:
    """(whole copies, Pareto rank for one more or null) of a unit."""
    expected = F.when(weighted > 0, F.least(F.lit(epochs), target * weight / weighted)).otherwise(0.0)
    # an expectation of exactly n copies may come out a rounding error off
    expected = F.when(F.abs(expected - F.round(expected)) < 1e-9, F.round(expected)).otherwise(expected)
    whole = F.floor(expected).cast("long")
    p = expected - whole
    return whole, F.when(p > 0, (u / (1 - u)) / (p / (1 - p)))


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weight: Column | None = None, weights: tuple[float, ...] = (1.0, 2.0, 3.0), share: float = 1.0,
             max_epochs: float = 3.0, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """(per-unit table, per-source table).

    The per-unit table has doc_id, source, size, rank and whole copies ``whole``;
    the per-source table has source, source_size, target and the rank ``cut`` up
    to which one copy more is taken.
    """
    weight = (weight if weight is not None else F.lit(1.0)).cast("double")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
                       weight.alias("weight"), _row(id_col, text_col, source_col, weight).alias("row"))
    rows = written(rows.groupBy(*rows.columns).agg(F.count("*").alias("equal")), "mix-rows")
    sums = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("equal")).alias("source_size"),
                                      F.sum(F.col("size") * F.col("weight") * F.col("equal")).alias("weighted"))
    targets = source_targets(sums.select("source", "source_size"), weights, share, max_epochs)
    sources = written(targets.join(sums.withColumnRenamed("source", "s").drop("source_size"),
                                   F.col("source").eqNullSafe(F.col("s")))
                      .select("source", "source_size", "target", "weighted"), "mix-sources")
    units = rows.withColumn("number", F.explode(F.sequence(F.lit(0).cast("long"), F.col("equal") - 1)))
    j = units.join(sources.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    whole, rank = _copies(F.col("target"), F.col("weighted"), F.col("weight"), float(max_epochs), _uniform(F.col("row"), F.col("number"), seed))
    ranked = j.withColumn("whole", whole).withColumn("rank", rank)
    # bins even in rank / (1 + rank), which lies in 0..1
    ranked = ranked.withColumn("bin", F.floor(F.col("rank") / (1 + F.col("rank")) * BINS).cast("int"))
    ranked = ranked.select("doc_id", "source", "size", "source_size", "target", "whole", "rank", "bin")
    per_bin = ranked.groupBy("source", "source_size", "target", "bin").agg(
        F.sum("size").alias("words"), F.sum(F.col("size") * F.col("whole")).alias("certain"))
    w = Window.partitionBy("source")
    up_to = w.orderBy(F.col("bin").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    per_bin = (per_bin.withColumn("need", F.col("target") - F.sum("certain").over(w))
               .withColumn("before", F.coalesce(F.sum(F.when(F.col("bin").isNotNull(), F.col("words"))).over(up_to), F.lit(0)))
               .where(F.col("bin").isNotNull() & (F.col("before") < F.col("need"))
                      & (F.col("before") + F.col("words") >= F.col("need")))
               .groupBy("source").agg(F.min(F.struct("bin", "before", "need")).alias("at")))
    at = per_bin.select(F.col("source").alias("s"), F.col("at.bin").alias("cut_bin"), F.col("at.before").alias("before"),
                        F.col("at.need").alias("need"))
    near = (ranked.join(at, F.col("source").eqNullSafe(F.col("s")) & (F.col("bin") == F.col("cut_bin")))
            .groupBy("source", "rank", "before", "need").agg(F.sum("size").alias("words")))
    running = F.sum("words").over(Window.partitionBy("source").orderBy("rank")) + F.col("before")
    # take the rank that crosses the target if that comes nearer than stopping short of it
    cuts = (near.withColumn("after", running)
            .where(F.col("after") - F.col("words") / 2 <= F.col("need"))
            .groupBy("source").agg(F.max("rank").alias("cut_in")))
    # every rank below the cut bin is taken; no bin reached: all ranks (need is not met) or none
    final = (sources.join(at, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
             .join(cuts.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left")
             .select("source", "source_size", "target", "weighted", "cut_bin", "cut_in"))
    floor_rank = F.col("cut_bin") / BINS / (1 - F.col("cut_bin") / BINS)
    needs = ranked.groupBy("source").agg(F.sum(F.col("size") * F.col("whole")).alias("certain"))
    final = (final.join(needs.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left")
             .select("source", "source_size", "target", "weighted",
                     F.when(F.col("cut_in").isNotNull(), F.col("cut_in"))
                     .when(F.col("cut_bin").isNotNull(), floor_rank - 1e-12)
                     .when(F.col("target") - F.col("certain") > 0.5, F.lit(float("inf")))
                     .otherwise(F.lit(-1.0)).alias("cut")))
    return ranked.drop("bin"), written(final, "mix-cuts")


def mix(docs: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, size, source_size, target, copies, taken."""
    rows, sources = mix_plan(docs, **options)
    s = sources.select(F.col("source").alias("s"), "cut")
    return (rows.join(s, F.col("source").eqNullSafe(F.col("s")))
            .withColumn("copies", F.col("whole") + F.coalesce((F.col("rank") <= F.col("cut")).cast("long"), F.lit(0)))
            .select("doc_id", "size", "source_size", "target", "copies",
                    (F.col("size") * F.col("copies")).alias("taken")))


def _numbered(rows: DataFrame, columns: list[str], row: str, number: str) -> DataFrame:
    """Repeated rows with the numbers 0, 1, ... among those of equal ``row``. Rows
    that are equal in all columns are counted; the others of one ``row`` are
    numbered in ``SALTS`` lots, whose first numbers come from the lots' counts."""
    every = F.xxhash64(*[F.to_json(c) if t.startswith("map") else F.col(c) for c, t in rows.dtypes])
    one = rows.groupBy(F.col(row).alias("_row"), every.alias("_every")).agg(F.any_value(F.struct(*columns)).alias("_one"), F.count("*").alias("_n"))
    one = one.withColumn("_lot", F.pmod("_every", F.lit(SALTS)).cast("int"))
    lots = one.groupBy("_row", "_lot").agg(F.sum("_n").alias("_in"))
    before = F.sum("_in").over(Window.partitionBy("_row").orderBy("_lot").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_in")
    upto = F.sum("_n").over(Window.partitionBy("_row", "_lot").orderBy("_every").rowsBetween(Window.unboundedPreceding, 0))
    one = (one.withColumn("_first", upto - F.col("_n"))
           .join(lots.select("_row", "_lot", before.alias("_before")), ["_row", "_lot"]))
    first = F.col("_before") + F.col("_first")
    return (one.select("_row", F.explode(F.sequence(first, first + F.col("_n") - 1)).alias("_number"), "_one")
            .select("_one.*", F.col("_row").alias(row), F.col("_number").alias(number)))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` themselves, each repeated as often as the mix
    takes it. The choice is applied per row from the per-source cuts."""
    seed, epochs = options.get("seed", 7), float(options.get("max_epochs", 3.0))
    id_col, text_col, source_col = options.get("id_col", "doc_id"), options.get("text_col", "text"), options.get("source_col", "source")
    weight = options.get("weight")
    weight = (weight if weight is not None else F.lit(1.0)).cast("double")
    _, sources = mix_plan(docs, **options)
    own, n, each, row, number = (fresh(docs, x) for x in ("mix", "copies", "copy", "row", "number"))
    keyed = docs.withColumn(row, _row(id_col, text_col, source_col, weight))
    again = written(keyed.groupBy(row).count().where("count > 1").select(F.col(row).alias("_again")), "mix-repeated")
    once = keyed.join(again, F.col(row) == F.col("_again"), "left_anti").withColumn(number, F.lit(0).cast("long"))
    more = _numbered(keyed.join(again, F.col(row) == F.col("_again"), "left_semi"), docs.columns, row, number)
    s = sources.select(F.struct(F.col("source").alias("s"), "target", "weighted", "cut").alias(own))
    j = once.unionByName(more.select(*once.columns)).join(s, F.col(source_col).eqNullSafe(F.col(f"{own}.s")))
    whole, rank = _copies(F.col(f"{own}.target"), F.col(f"{own}.weighted"), weight, epochs, _uniform(F.col(row), F.col(number), seed))
    copies = whole.cast("int") + F.coalesce((rank <= F.col(f"{own}.cut")).cast("int"), F.lit(0))
    return (j.withColumn(n, copies).where(F.col(n) > 0)
            .withColumn(each, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*docs.columns))
