"""Model fitting and scoring with MLlib.

Preprocessing statistics (medians, means, population std) are one aggregate
each over the training rows; the fitted values are applied as literal
expressions, so scoring any number of rows is a narrow projection.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel, OneVsRest
from pyspark.ml.common import _py2java
from pyspark.ml.feature import IndexToString, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from ..config import CLASS_LABELS, RANDOM_STATE
from ..plans.sizing import materialize
from . import metrics as M

# Columns that the saved pipeline adds for its own use.
PREPARED = "__x_"

# Rows that a partition of training rows holds before there is another one.
ROWS_PER_PARTITION = 50_000


def median_stats(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row of exact medians (linear interpolation), one column per input."""
    return train.agg(*[F.percentile(F.col(c).cast("double"), 0.5).alias(c) for c in cols])


def median_impute(df: DataFrame, train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fill NULLs with the training medians (columns that are all NULL in
    training stay NULL)."""
    med = median_stats(train, cols).first().asDict()
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(med[c]).cast("double")) for c in cols})


def scale_stats(train: DataFrame, cols: Sequence[str]) -> dict:
    row = train.agg(*[F.avg(F.col(c)).alias(f"m_{c}") for c in cols],
                    *[F.stddev_pop(F.col(c)).alias(f"s_{c}") for c in cols]).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols}


def standard_scale(df: DataFrame, train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - mean) / population std of the training rows; zero std -> 1."""
    st = scale_stats(train, cols)
    out = {}
    for c in cols:
        m, s = st[c]
        s = 1.0 if (s is None or s == 0.0) else s
        out[c] = (F.col(c) - F.lit(m)) / F.lit(s)
    return df.withColumns(out)


def prepare_stage(train: DataFrame, features: Sequence[str], scale: bool) -> SQLTransformer:
    """Median imputation, and scaling by mean and population deviation, as a
    stage that is saved with the model: the training statistics are literals of
    its statement. Columns that are all NULL in training are dropped."""
    med = median_stats(train, features).first().asDict()
    kept = [c for c in features if med[c] is not None]
    if not kept:
        raise ValueError("every feature is missing in all training rows")
    filled = train.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(med[c])) for c in kept})
    stats = scale_stats(filled, kept) if scale else {}

    def number(x: float) -> str:
        return f"cast('{float(x)!r}' as double)"

    parts = []
    for c in kept:
        mean, deviation = stats.get(c, (0.0, 1.0))
        value = f"coalesce(cast(`{c}` as double), {number(med[c])})"
        if scale:
            value = f"({value} - {number(mean)}) / {number(deviation or 1.0)}"
        parts.append(f"{value} AS `{PREPARED}{c}`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__"), kept


def few_partitions(train: DataFrame) -> DataFrame:
    """``train`` in no more partitions than its rows fill. A fit runs hundreds
    of short jobs with a task for every partition, so empty ones are dear."""
    return train.coalesce(max(1, -(-train.count() // ROWS_PER_PARTITION)))


def _fit(train: DataFrame, features: Sequence[str], label: str, scale: bool, classifier) -> PipelineModel:
    """Fit on the labelled rows. The pipeline itself needs no label, so it
    scores unlabelled rows too; the class names are part of its last stage.
    The prepared rows are computed once: every job of the fit reads them."""
    labelled = train.where(F.col(label).isNotNull())
    index = StringIndexer(inputCol=label, outputCol="label_idx", stringOrderType="alphabetAsc").fit(labelled)
    prepare, kept = prepare_stage(labelled, features, scale)
    names = IndexToString(inputCol="prediction", outputCol="predicted", labels=list(index.labels))
    assemble = VectorAssembler(inputCols=[f"{PREPARED}{c}" for c in kept], outputCol="features")
    ready = PipelineModel([prepare, assemble]).transform(index.transform(labelled))
    ready = materialize(ready.select(*[c for c in ("features", "label_idx", "weight") if c in ready.columns]))
    return PipelineModel([prepare, assemble, classifier.fit(few_partitions(ready)), names])


def fit_logistic(train: DataFrame, features: Sequence[str], label: str = "target_class",
                 max_iter: int = 2000, scale: bool = False) -> PipelineModel:
    """Multinomial L2 logistic regression, C = 1, balanced class weights.

    With weights summing to n, regParam = 1/n gives the optimum of
    0.5*||w||^2 + C * sum(w_i * loss_i) (intercept unpenalised)."""
    weights = M.class_weights(train, label).select(label, "weight")
    data = train.join(weights, label, "left")
    n = train.where(F.col(label).isNotNull()).count()
    lr = LogisticRegression(featuresCol="features", labelCol="label_idx", weightCol="weight",
                            family="multinomial", regParam=1.0 / max(n, 1), elasticNetParam=0.0,
                            standardization=False, maxIter=max_iter, tol=1e-9)
    return _fit(data, features, label, scale, lr)


def fit_gbt(train: DataFrame, features: Sequence[str], label: str = "target_class",
            max_iter: int = 100, max_depth: int = 3, step: float = 0.1) -> PipelineModel:
    """One-vs-rest gradient-boosted trees (100 trees, depth 3, rate 0.1)."""
    gbt = GBTClassifier(maxIter=max_iter, maxDepth=max_depth, stepSize=step, seed=RANDOM_STATE)
    ovr = OneVsRest(classifier=gbt, featuresCol="features", labelCol="label_idx", parallelism=len(CLASS_LABELS))
    return _fit(train, features, label, False, ovr)


def logistic_from_coefficients(train: DataFrame, features: Sequence[str], classes: Sequence[str],
                               coefficients: Sequence[Sequence[float]], intercepts: Sequence[float]) -> PipelineModel:
    """A multinomial logistic pipeline with given coefficients (a row for each class,
    on scaled features), prepared by the statistics of ``train``. It is saved,
    loaded and scored as a fitted one."""
    prepare, kept = prepare_stage(train, features, scale=True)
    if len(coefficients) != len(classes) or any(len(r) != len(kept) for r in coefficients):
        raise ValueError(f"{len(classes)} rows of {len(kept)} coefficients are needed")
    sc = train.sparkSession.sparkContext
    matrix = DenseMatrix(len(classes), len(kept), [x for row in coefficients for x in row], isTransposed=True)
    model = LogisticRegressionModel(sc._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        f"logistic_{abs(hash(tuple(classes))):x}", _py2java(sc, matrix), _py2java(sc, DenseVector(list(intercepts))), len(classes), True))
    assemble = VectorAssembler(inputCols=[f"{PREPARED}{c}" for c in kept], outputCol="features")
    names = IndexToString(inputCol="prediction", outputCol="predicted", labels=list(classes))
    return PipelineModel([prepare, assemble, model.setFeaturesCol("features"), names])


def logistic_gradient(model: PipelineModel, train: DataFrame, label: str = "target_class") -> DataFrame:
    """(class, feature, gradient): the derivative of the training objective
    (C = 1, balanced weights) at the model's coefficients; zero at the optimum.
    ``(intercept)`` is a feature without penalty."""
    names, kept, fitted = class_names(model), model_features(model), model.stages[2]
    flat = fitted.coefficientMatrix.toArray()
    own = {(c, f): float(flat[i, j]) for i, c in enumerate(names) for j, f in enumerate(kept)}
    penalty = F.create_map(*[F.lit(x) for (c, f), v in own.items() for x in (f"{c} {f}", v)])
    data = train.where(F.col(label).isNotNull()).join(M.class_weights(train, label).select(label, "weight"), label)
    rows = model.transform(data).select(F.col(label).alias("y"), "weight", vector_to_array("probability").alias("p"),
                                        F.concat(vector_to_array("features"), F.array(F.lit(1.0))).alias("x"))
    each = rows.select("y", "weight", "x", F.posexplode("p").alias("c", "p"))
    each = each.select((F.col("weight") * (F.col("p") - (F.get(F.array(*map(F.lit, names)), F.col("c")) == F.col("y")).cast("double"))).alias("d"),
                       F.get(F.array(*map(F.lit, names)), F.col("c")).alias("class"), F.posexplode("x").alias("f", "x"))
    total = each.groupBy("class", F.get(F.array(*map(F.lit, [*kept, "(intercept)"])), F.col("f")).alias("feature")).agg(F.sum(F.col("d") * F.col("x")).alias("g"))
    return total.select("class", "feature", (F.col("g") + F.coalesce(penalty[F.concat_ws(" ", "class", "feature")], F.lit(0.0))).alias("gradient"))


def save_model(model: PipelineModel, path: str) -> None:
    """Persist a fitted pipeline (stages, label order and feature list)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def model_features(model: PipelineModel) -> list[str]:
    """The features the model was trained on (all-NULL columns left out)."""
    return [c.removeprefix(PREPARED) for c in model.stages[1].getInputCols()]


def class_names(model: PipelineModel) -> list[str]:
    return list(model.stages[-1].getLabels())


def label_probabilities(names: Sequence[str], probs: Column, labels: Sequence[str] = CLASS_LABELS) -> dict[str, Column]:
    """``proba_<label>`` from the model's class order and its probability
    array; 0.0 for labels the model never saw."""
    by_name = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), probs)
    return {f"proba_{lab}": F.coalesce(by_name[lab], F.lit(0.0)) for lab in labels}


def score(model: PipelineModel, df: DataFrame, labels: Sequence[str] = CLASS_LABELS) -> DataFrame:
    """Add ``predicted`` and ``proba_<label>`` (0.0 for labels the model never
    saw). One-vs-rest models expose margins only: softmax them."""
    names = class_names(model)
    out = model.transform(df)
    if "probability" in out.columns:
        probs = vector_to_array("probability")
    else:
        raw = vector_to_array("rawPrediction")
        exps = F.transform(raw, lambda x: F.exp(x))
        probs = F.transform(exps, lambda x: x / F.aggregate(exps, F.lit(0.0), lambda a, b: a + b))
    cols = label_probabilities(names, probs, labels)
    drop = [c for c in out.columns if c.startswith(PREPARED) or c in ("features", "rawPrediction", "probability", "prediction")]
    return out.withColumns(cols).drop(*drop)


def evaluate(scored: DataFrame, y: str = "target_class", p: str = "predicted") -> dict:
    acc = M.accuracy(scored, y, p).first()["accuracy"]
    f1 = M.macro_f1(scored, y, p).first()["macro_f1"]
    return {"accuracy": acc, "macro_f1": f1}


def train_candidates(model_table: DataFrame, features: Sequence[str], test_size: int,
                     candidates: Sequence[str] = ("logistic_regression", "gradient_boosting"),
                     label: str = "target_class", max_iter: int | None = None):
    """Fit each candidate on the chronological train split, score the test
    split, return (results DataFrame, models dict, scored test rows). The
    candidates are fitted side by side: a fit is a row of short jobs that
    leaves most of the slots idle."""
    split = M.chronological_split(model_table, test_size).cache()
    train = split.where(~F.col("is_test"))
    test = split.where(F.col("is_test"))
    options = {"max_iter": max_iter} if max_iter else {}
    fits = {"logistic_regression": lambda: fit_logistic(train, features, label, scale=True, **options),
            "gradient_boosting": lambda: fit_gbt(train, features, label, **options)}
    for name in candidates:
        if name not in fits:
            raise ValueError(f"no such candidate: {name!r}")

    def fit_and_evaluate(name: str):
        model = fits[name]()
        scored = score(model, test).withColumn("model", F.lit(name))
        return model, scored, evaluate(scored, label)

    spark = model_table.sparkSession
    with ThreadPoolExecutor(max(1, len(candidates))) as pool:
        # one wrapper a candidate: each takes its own copy of the caller's local properties
        running = [pool.submit(inheritable_thread_target(spark)(fit_and_evaluate), name) for name in candidates]
        done = [r.result() for r in running]
    rows, models, scored_all = [], {}, None
    for pos, (name, (model, scored, m)) in enumerate(zip(candidates, done, strict=True)):
        rows.append((name, pos, m["accuracy"], m["macro_f1"]))
        models[name] = model
        scored_all = scored if scored_all is None else scored_all.unionByName(scored)
    results = spark.createDataFrame(rows, "model string, position int, accuracy double, macro_f1 double")
    return results, models, scored_all
