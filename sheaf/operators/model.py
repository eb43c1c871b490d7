"""Formula features, classifiers, grid search and importances (E8, L1-L6, L10), on ``pyspark.ml``."""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence
from functools import partial
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import RFormula
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from sheaf.operators.columns import q

# The workload's search grids.
LR_GRID = {"regParam": (0.1, 0.01), "maxIter": (50, 100, 150)}
RF_GRID = {"numTrees": (150, 200, 300)}
FOLDS = 10
SEED = 42


def rformula(train: DataFrame, label: str, exclude: Sequence[str] = ("business_id",),
             features_col: str = "features", label_col: str = "label",
             handle_invalid: str = "error"):
    """Fit ``label ~ . - exclude`` on the training rows.

    Text columns are indexed by descending frequency (ties alphabetical) and one-hot encoded with the
    last level dropped. ``handle_invalid="keep"`` sends null and unseen values to an extra level
    (which then is the dropped one) instead of failing. Fit on training data only and apply the
    fitted model to every part.
    """
    formula = " - ".join([f"{label} ~ ."] + list(exclude))
    return RFormula(formula=formula, featuresCol=features_col, labelCol=label_col,
                    handleInvalid=handle_invalid).fit(train)


def _grid(estimator, grid: Mapping[str, Sequence]):
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(estimator.getParam(name), list(values))
    return b.build()


def cross_validate(estimator, grid: Mapping[str, Sequence], train: DataFrame, folds: int = FOLDS,
                   seed: int = SEED, parallelism: int = 8, label_col: str = "label",
                   fold_col: str | None = None) -> CrossValidatorModel:
    """k-fold cross-validation of ``Pipeline([estimator])`` over ``grid``, best by AUC-ROC (L3, L4).

    With ``fold_col`` (see ``fold_number``) a row's fold is its own, whatever the partitioning; without, rows are
    dealt at random by ``seed``. ``train`` is kept in the executors' memory, or on their disks, while the folds are
    fitted; checkpoint it first, so that a lost executor is cheap to recover.

    ``parallelism`` fits run at once, of whatever folds: ``CrossValidator`` waits for a fold's slowest fit before it
    begins the next, and its cores wait with it. Fits, folds and metrics are the same.
    """
    ev = BinaryClassificationEvaluator(labelCol=label_col)
    pipeline, points = Pipeline(stages=[estimator]), _grid(estimator, grid)
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        scores = _fold_scores(pipeline, points, ev, train, folds, seed, parallelism, fold_col)
        mean, std = np.mean(scores, axis=0).tolist(), np.std(scores, axis=0).tolist()
        best = int(np.argmax(mean))
        cv = CrossValidatorModel(pipeline.fit(train, points[best]), mean, None, std)
    finally:
        train.unpersist()
    known = {"estimator": pipeline, "estimatorParamMaps": points, "evaluator": ev, "numFolds": folds, "seed": seed}
    for name, value in (known | ({"foldCol": fold_col} if fold_col else {})).items():
        cv.set(cv.getParam(name), value)
    return cv


def _fold_scores(est, points: list, ev, train: DataFrame, folds: int, seed: int, parallelism: int,
                 fold_col: str | None) -> list[list[float]]:
    """The metric of every grid point on every fold. A fold's rows are kept until its last fit ends."""
    own = fold_col or "_fold"
    rows = train if fold_col else train.withColumn(own, F.floor(F.rand(seed) * folds).cast("int"))
    sizes = rows.agg(*[F.count_if(F.col(own) == i) for i in range(folds)], F.count(F.lit(1))).first()
    if sum(sizes[:-1]) < sizes[-1]:
        raise ValueError(f"fold numbers must be in range [0, {folds})")
    for i, n in enumerate(sizes[:-1]):
        if n == 0 or n == sizes[-1]:
            raise ValueError(f"The {'training' if n else 'validation'} data at fold {i} is empty.")
    parts = [tuple(rows.filter(c).persist(StorageLevel.MEMORY_AND_DISK) for c in (F.col(own) != i, F.col(own) == i))
             for i in range(folds)]
    scores, waiting = [[0.0] * len(points) for _ in range(folds)], [len(points)] * folds

    def fit(i: int, j: int) -> tuple[int, int, float]:
        model = est.fit(parts[i][0], points[j])
        return i, j, ev.evaluate(model.transform(parts[i][1], points[j]))

    in_thread = inheritable_thread_target(train.sparkSession)
    jobs = [in_thread(partial(fit, i, j)) for i in range(folds) for j in range(len(points))]
    try:
        with ThreadPool(min(parallelism, len(jobs))) as pool:
            for i, j, score in pool.imap_unordered(lambda job: job(), jobs):
                scores[i][j] = score
                waiting[i] -= 1
                if not waiting[i]:
                    for part in parts[i]:
                        part.unpersist()
    finally:
        for part in itertools.chain(*parts):
            part.unpersist()
    return scores


def logistic_certificate(model, train: DataFrame, features_col: str = "features",
                         label_col: str = "label") -> DataFrame:
    """feature (-1: intercept), mean, std, coefficient, gradient of the penalised loss at the fitted coefficients.

    Where all gradients are zero the coefficients are the optimum, as the loss is convex: a check of a fit that
    needs no second fit. The loss is the mean log loss plus ``regParam / 2`` times the squared coefficients of the
    standardised features (``elasticNetParam`` 0, standardisation on). One aggregation over (row, feature) pairs.
    """
    if model.getOrDefault("elasticNetParam") or not model.getOrDefault("standardization"):
        raise ValueError("the gradient is that of a ridge penalty on standardised features")
    spark = train.sparkSession
    beta = [float(v) for v in model.coefficients]  # of the features, which are columns
    known = spark.createDataFrame([*enumerate(beta), (-1, float(model.intercept))], "feature int, coefficient double")
    scored = model.transform(train).select(
        (vector_to_array(model.getProbabilityCol())[1] - F.col(label_col)).alias("off"), vector_to_array(features_col).alias("x"))
    pairs = scored.select("off", F.posexplode(F.concat(F.array(F.lit(1.0)), "x")).alias("at", "x"))
    sums = pairs.groupBy((F.col("at") - 1).alias("feature")).agg(
        F.avg("x").alias("mean"),
        F.when(F.min("x") == F.max("x"), 0.0).otherwise(F.stddev_samp("x")).alias("std"), F.avg(F.col("off") * F.col("x")).alias("slope"))
    scaled = F.when(F.col("std") > 0, F.col("slope") / F.col("std") + F.lit(float(model.getRegParam()))
                    * F.col("coefficient") * F.col("std")).otherwise(F.col("coefficient"))
    return sums.join(F.broadcast(known), "feature").select(
        "feature", "mean", "std", "coefficient",
        F.when(F.col("feature") < 0, F.col("slope")).otherwise(scaled).alias("gradient"))


def logistic_cv(train: DataFrame, grid=LR_GRID, **kw) -> CrossValidatorModel:
    return cross_validate(LogisticRegression(), grid, train, **kw)


def spread(rows: DataFrame, least_bytes: int = 1 << 22, features_col: str = "features") -> DataFrame:
    """``rows`` in partitions of ``least_bytes`` of features or more, up to one per core, for fits whose passes are long.

    A forest's pass updates a histogram per tree and row, so a table that a linear fit reads best in one task keeps that
    task busy for minutes. A task costs histograms of its own, which are shuffled: more tasks than cores do not pay.

    Every partition is in the order of its features: a pass updates far more counts than a core's cache holds, and like
    rows that follow each other update the same ones. The other plain columns settle ties, so a partition's rows have one
    order, however they were fetched. Tables below two pieces stay as they are.
    """
    width = rows.schema[features_col].metadata.get("ml_attr", {}).get("num_attrs")
    if width is None:
        one = rows.select(features_col).first()
        width = one[0].size if one and one[0] is not None else 0
    most = rows.sparkSession.sparkContext.defaultParallelism
    pieces = rows.count() * (8 * width + 64) // least_bytes
    if pieces < 2:
        return rows
    parts = min(most, pieces)
    dealt = rows.repartition(parts) if parts > rows.rdd.getNumPartitions() else rows
    plain = [q(f.name) for f in rows.schema if isinstance(f.dataType, AtomicType)]
    own = "_order"  # a column, so that the vector is turned into an array once a row, not once a comparison
    return dealt.withColumn(own, vector_to_array(features_col)).sortWithinPartitions(own, *plain).drop(own)


def forest_cv(train: DataFrame, grid=RF_GRID, seed: int = SEED, **kw) -> CrossValidatorModel:
    """The trees' node of every row is kept from level to level: the same forests without a walk from the roots per level.

    A fit keeps some bytes per row and tree, so few run at once: one more than a fold of the workload's grid has.
    """
    return cross_validate(RandomForestClassifier(seed=seed, cacheNodeIds=True), grid, spread(train), seed=seed,
                          **{"parallelism": 4} | kw)


def grid_metrics(spark: SparkSession, cv: CrossValidatorModel) -> DataFrame:
    """One row per grid point: its parameters, mean and std of the fold AUCs, and the winner."""
    maps = cv.getEstimatorParamMaps()
    names = sorted({p.name for m in maps for p in m})
    best = max(range(len(maps)), key=lambda i: cv.avgMetrics[i])
    std = list(cv.stdMetrics) if cv.stdMetrics else [None] * len(maps)
    rows = [tuple(float(next(v for p, v in m.items() if p.name == n)) for n in names)
            + (float(cv.avgMetrics[i]), None if std[i] is None else float(std[i]), i == best)
            for i, m in enumerate(maps)]
    schema = ", ".join([f"{n} double" for n in names]
                       + ["avg_auc double", "std_auc double", "is_best boolean"])
    return spark.createDataFrame(rows, schema)


def best_params(cv: CrossValidatorModel) -> dict:
    """Parameters of the winning model, through public getters."""
    m = cv.bestModel.stages[-1]
    return {p.name: m.getOrDefault(p) for p in m.params if m.isDefined(p) and p.name in
            ("regParam", "maxIter", "numTrees", "maxDepth", "elasticNetParam")}


def predictions(model, df: DataFrame, keep: Sequence[str] = ("business_id", "label")) -> DataFrame:
    """Score a table (L6): kept columns, hard prediction and probability of class 1."""
    return model.transform(df).select(
        *keep, "prediction", vector_to_array("probability")[1].alias("probability"))


def feature_importances(spark: SparkSession, importances, df: DataFrame,
                        features_col: str = "features", top: int | None = 10) -> DataFrame:
    """Importance per feature name, largest first.

    Names come from the ``ml_attr`` metadata of the features column, matched by index: the metadata
    groups attributes by type, which is not vector order.
    """
    attrs = df.schema[features_col].metadata["ml_attr"]["attrs"]
    named = sorted(((a["idx"], a["name"]) for group in attrs.values() for a in group))
    rows = [(name, int(idx), float(importances[int(idx)])) for idx, name in named]
    out = (spark.createDataFrame(rows, "feature string, idx int, score double")
           .orderBy(F.desc("score"), F.asc("idx")))
    return out.limit(top) if top else out
