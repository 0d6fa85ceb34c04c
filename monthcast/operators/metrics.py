"""Chronological split, class statistics and classification metrics.

Inputs are (truth, prediction) columns of any DataFrame; every metric is an
aggregate, so evaluation over a large scored table is distributed. Label
sets are fixed lists (three classes), generated from literals, never joined
as a cross product.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import CLASS_LABELS


def chronological_split(df: DataFrame, test_size: int, order_col: str = "month",
                        tiebreak: Sequence[str] = ()) -> DataFrame:
    """Add ``is_test``: the last ``test_size`` rows by ``order_col`` are test.

    Exactly ``min(test_size, rows)`` rows, also where order values repeat:
    ties are broken by ``tiebreak``, then by a hash of the whole row, and of
    equal rows only as many as needed are taken. The test rows are found with
    a distributed top-k; its at most ``test_size`` keys are broadcast back.
    Only rows equal to the last one taken can be taken in part, so only those
    are numbered; no other row is shuffled.
    """
    keys = [order_col, *tiebreak, "__row"]
    hashed = [F.col(c) for c, t in df.dtypes if not t.startswith("map")]
    rows = df.withColumn("__row", F.xxhash64(*hashed))
    last = (rows.select(*keys).orderBy(*[F.col(k).desc_nulls_last() for k in keys]).limit(test_size)
            .groupBy(*keys).agg(F.count("*").alias("__n")))
    edge = F.row_number().over(Window.orderBy(*[F.col(k).asc_nulls_first() for k in keys])) == 1      # of test_size rows at most
    last = last.withColumn("__edge", edge).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__n", "__edge")
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    found = rows.join(F.broadcast(last), same, "left")
    at_edge = F.coalesce(F.col("__edge"), F.lit(False))
    whole = found.where(~at_edge).withColumn("is_test", F.col("__n").isNotNull())
    copy = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0)))
    part = found.where(at_edge).withColumn("is_test", copy <= F.col("__n"))
    return whole.select(*df.columns, "is_test").unionByName(part.select(*df.columns, "is_test"))


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Value counts of ``label`` (NULL excluded), most frequent first."""
    return (df.where(F.col(label).isNotNull()).groupBy(label).count()
              .orderBy(F.col("count").desc(), F.col(label).asc()))


def _label_grid(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    arr = F.array(*[F.lit(x) for x in labels])
    return (df.sparkSession.range(1)
            .select(F.explode(arr).alias("actual"))
            .select("actual", F.explode(arr).alias("predicted")))


def confusion_matrix(df: DataFrame, y: str, p: str, labels: Sequence[str] = CLASS_LABELS) -> DataFrame:
    """Long form (actual, predicted, n) over the fixed label order,
    zero-filled; rows with labels outside ``labels`` are ignored."""
    counts = (df.where(F.col(y).isin(list(labels)) & F.col(p).isin(list(labels)))
                .groupBy(F.col(y).alias("actual"), F.col(p).alias("predicted"))
                .agg(F.count(F.lit(1)).alias("n")))
    return (_label_grid(df, labels).join(counts, ["actual", "predicted"], "left")
            .select("actual", "predicted", F.coalesce(F.col("n"), F.lit(0)).alias("n")))


def accuracy(df: DataFrame, y: str, p: str) -> DataFrame:
    return df.agg(F.avg((F.col(y) == F.col(p)).cast("double")).alias("accuracy"))


def per_label_counts(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., label, support, predicted, tp) for every label seen in y or p.
    One pass over the rows; a pair of labels then counts for both."""
    by = list(by)
    n = F.col("__n")
    pairs = df.groupBy(*by, F.col(y).alias("__y"), F.col(p).alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    hit = F.when(F.col("__y") == F.col("__p"), n).otherwise(0)
    sides = F.array(F.struct(F.col("__y").alias("label"), n.alias("s"), F.lit(0).cast("long").alias("q"), hit.alias("tp")),
                    F.struct(F.col("__p").alias("label"), F.lit(0).cast("long").alias("s"), n.alias("q"), F.lit(0).cast("long").alias("tp")))
    return (pairs.select(*by, F.explode(sides).alias("__side")).select(*by, "__side.*").where(F.col("label").isNotNull())
            .groupBy(*by, "label").agg(F.sum("s").alias("support"), F.sum("q").alias("predicted"), F.sum("tp").alias("tp")))


def _prf(df: DataFrame) -> DataFrame:
    tp, sup, pred = F.col("tp").cast("double"), F.col("support").cast("double"), F.col("predicted").cast("double")
    precision = F.coalesce(F.try_divide(tp, pred), F.lit(0.0))
    recall = F.coalesce(F.try_divide(tp, sup), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2.0 * tp, sup + pred), F.lit(0.0))
    return df.withColumns({"precision": precision, "recall": recall, "f1": f1})


def macro_f1(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean per-label F1 over labels present in truth or prediction
    (per ``by`` group, e.g. per model)."""
    return _prf(per_label_counts(df, y, p, by)).groupBy(*by).agg(F.avg("f1").alias("macro_f1"))


def classification_report(df: DataFrame, y: str, p: str, labels: Sequence[str] = CLASS_LABELS) -> DataFrame:
    """Rows (label, precision, recall, f1, support) for each fixed label
    (absent ones are zeros), then ``macro avg`` and ``weighted avg``;
    zero division gives 0."""
    arr = F.array(*[F.lit(x) for x in labels])
    base = df.sparkSession.range(1).select(F.posexplode(arr).alias("ord", "label"))
    counts = per_label_counts(df, y, p)
    per = _prf(base.join(counts, "label", "left").fillna(0, subset=["support", "predicted", "tp"]))
    per = per.select("ord", "label", "precision", "recall", "f1", "support")
    w = Window.partitionBy()  # at most len(labels) rows
    total = F.sum("support").over(w)
    summary = per.select(
        F.avg("precision").over(w).alias("m_p"), F.avg("recall").over(w).alias("m_r"),
        F.avg("f1").over(w).alias("m_f"),
        F.coalesce(F.try_divide(F.sum(F.col("precision") * F.col("support")).over(w), total.cast("double")),
                   F.lit(0.0)).alias("w_p"),
        F.coalesce(F.try_divide(F.sum(F.col("recall") * F.col("support")).over(w), total.cast("double")),
                   F.lit(0.0)).alias("w_r"),
        F.coalesce(F.try_divide(F.sum(F.col("f1") * F.col("support")).over(w), total.cast("double")),
                   F.lit(0.0)).alias("w_f"),
        total.alias("tot")).limit(1)
    macro = summary.select(F.lit(len(labels)).alias("ord"), F.lit("macro avg").alias("label"),
                           F.col("m_p").alias("precision"), F.col("m_r").alias("recall"),
                           F.col("m_f").alias("f1"), F.col("tot").alias("support"))
    weighted = summary.select(F.lit(len(labels) + 1).alias("ord"), F.lit("weighted avg").alias("label"),
                              F.col("w_p").alias("precision"), F.col("w_r").alias("recall"),
                              F.col("w_f").alias("f1"), F.col("tot").alias("support"))
    return per.unionByName(macro).unionByName(weighted)


def evaluation(scored: DataFrame, y: str, p: str, by: Sequence[str] = ("model",), labels: Sequence[str] = CLASS_LABELS) -> DataFrame:
    """All figures of a metrics artifact in long form, for every ``by`` group
    (candidate model): (by..., metric, label, predicted_label, value).

    ``n_rows_test``, ``accuracy``, ``macro_f1`` (labels present in truth or prediction);
    ``precision``, ``recall``, ``f1-score``, ``support`` for each of ``labels`` (zeros where
    absent), ``macro avg`` and ``weighted avg``; ``confusion_matrix`` over ``labels``;
    ``test_class_distribution`` and ``predicted_class_distribution`` of the labels that
    occur. Rows without a truth or a prediction are left out.

    The scored rows are read once and grouped by (by, y, p); a group's figures
    are expressions over its few cells, so nothing is joined or read again.
    """
    by = list(by)
    cells = (scored.where(F.col(y).isNotNull() & F.col(p).isNotNull())
             .groupBy(*by, F.col(y).alias("y"), F.col(p).alias("p")).agg(F.count(F.lit(1)).alias("n"))
             .groupBy(*by).agg(F.collect_list(F.struct("y", "p", "n")).alias("cells")))

    def total(pick: Callable[[Column], Column]) -> Column:
        return F.aggregate("cells", F.lit(0).cast("long"), lambda a, c: a + F.when(pick(c), c["n"]).otherwise(0))

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    def mean(values: list[Column], weights: list[Column] | None = None) -> Column:
        w = weights or [F.lit(1)] * len(values)
        return ratio(reduce(add, [v * x for v, x in zip(values, w, strict=True)]), reduce(add, w))

    def row(metric: str, value: Column, label: Column | str | None = None, predicted: str | None = None) -> Column:
        label = label if isinstance(label, Column) else F.lit(label)
        return F.struct(F.lit(metric).alias("metric"), label.cast("string").alias("label"),
                        F.lit(predicted).cast("string").alias("predicted_label"), value.cast("double").alias("value"))

    def f1_of(label: Column) -> Column:
        return ratio(2.0 * total(lambda c: (c["y"] == label) & (c["p"] == label)),
                     total(lambda c: c["y"] == label) + total(lambda c: c["p"] == label))

    def distribution(metric: str, side: str) -> Column:
        seen = F.array_sort(F.array_distinct(F.transform("cells", lambda c: c[side])))
        return F.transform(seen, lambda x: row(metric, total(lambda c: c[side] == x), x))

    tp = [total(lambda c, x=x: (c["y"] == x) & (c["p"] == x)) for x in labels]
    support = [total(lambda c, x=x: c["y"] == x) for x in labels]
    predicted = [total(lambda c, x=x: c["p"] == x) for x in labels]
    figures = {"precision": [ratio(t, q) for t, q in zip(tp, predicted, strict=True)],
               "recall": [ratio(t, s) for t, s in zip(tp, support, strict=True)],
               "f1-score": [ratio(2.0 * t, s + q) for t, s, q in zip(tp, support, predicted, strict=True)]}
    n = total(lambda c: F.lit(True))
    seen = F.array_distinct(F.concat(F.transform("cells", lambda c: c["y"]), F.transform("cells", lambda c: c["p"])))
    macro_f1 = ratio(F.aggregate(seen, F.lit(0.0), lambda a, x: a + f1_of(x)), F.size(seen))
    fixed = [row("n_rows_test", n), row("accuracy", ratio(total(lambda c: c["y"] == c["p"]), n)), row("macro_f1", macro_f1)]
    for metric, values in figures.items():
        fixed += [row(metric, v, x) for v, x in zip(values, labels, strict=True)]
        fixed += [row(metric, mean(values), "macro avg"), row(metric, mean(values, support), "weighted avg")]
    fixed += [row("support", s, x) for s, x in zip(support, labels, strict=True)]
    fixed += [row("support", reduce(add, support), x) for x in ("macro avg", "weighted avg")]
    fixed += [row("confusion_matrix", total(lambda c, a=a, b=b: (c["y"] == a) & (c["p"] == b)), a, b) for a in labels for b in labels]
    rows = F.concat(F.array(*fixed), distribution("test_class_distribution", "y"), distribution("predicted_class_distribution", "p"))
    return cells.select(*by, F.explode(rows).alias("r")).select(*by, "r.*")


def labels_in(df: DataFrame, label: str) -> DataFrame:
    """Sorted distinct labels as one array (label sets are small)."""
    return df.where(F.col(label).isNotNull()).agg(F.sort_array(F.collect_set(label)).alias("labels"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (k * n_c) per class."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    w = Window.partitionBy()  # one row per class
    return counts.select(label, "n_c", (F.sum("n_c").over(w) / (F.count(F.lit(1)).over(w) * F.col("n_c")))
                         .alias("weight"))


def select_best(results: DataFrame, metric: str, model_col: str = "model",
                position_col: str = "position") -> DataFrame:
    """Arg-max of ``metric`` (missing = -inf); the earliest candidate wins ties."""
    score = F.coalesce(F.col(metric).cast("double"), F.lit(float("-inf")))
    return results.orderBy(score.desc(), F.col(position_col).asc()).limit(1)
