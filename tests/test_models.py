"""Invariants of the model stages (small grids and few folds keep the test quick)."""

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.mllib.evaluation import BinaryClassificationMetrics
from pyspark.sql import functions as F

from sheaf.operators.metrics import auc_roc, hard_label_metrics
from sheaf.operators.model import (cross_validate, feature_importances, forest_cv, grid_metrics,
                                   predictions)
from sheaf.plans.catalog import FIX, tables
from sheaf.plans.features import LABEL, base_table, model_inputs

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def inputs(spark):
    return model_inputs(tables(spark, SF), FIX)


def test_split_covers_labelled_rows(spark, inputs):
    bt = base_table(tables(spark, SF), FIX)
    assert inputs.train.count() + inputs.test.count() == bt.filter(F.col(LABEL).isNotNull()).count()
    assert bt.filter(F.col(LABEL).isNull()).count() > 0  # kept, with a null label
    nulls = bt.select([F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in bt.columns if c != LABEL]).first()
    assert sum(nulls) == 0  # nothing left unimputed


def test_lr_grid_and_determinism(spark, inputs):
    from pyspark.ml.classification import LogisticRegression
    grid = {"regParam": (0.1, 0.01), "maxIter": (20,)}
    cv = cross_validate(LogisticRegression(), grid, inputs.train, folds=3)
    g = grid_metrics(spark, cv).collect()
    assert len(g) == 2 and sum(r.is_best for r in g) == 1
    assert all(0.0 <= r.avg_auc <= 1.0 for r in g)
    p1 = [tuple(r) for r in predictions(cv, inputs.test).orderBy("business_id").collect()]
    cv2 = cross_validate(LogisticRegression(), grid, inputs.train, folds=3)
    p2 = [tuple(r) for r in predictions(cv2, inputs.test).orderBy("business_id").collect()]
    assert p1 == p2


def test_forest_importances(spark, inputs):
    cv = forest_cv(inputs.train, grid={"numTrees": (10,)}, folds=2)
    imp = feature_importances(spark, cv.bestModel.stages[-1].featureImportances, inputs.train,
                              top=None)
    assert sum(r.score for r in imp.collect()) == pytest.approx(1.0)
    assert imp.count() == len(inputs.train.first().features)


def test_metrics_agree_with_spark(spark, inputs):
    from pyspark.ml.classification import LogisticRegression
    model = LogisticRegression(maxIter=20).fit(inputs.train)
    scored = model.transform(inputs.test)
    exact = BinaryClassificationEvaluator(numBins=0).evaluate(scored)
    assert auc_roc(scored, "label", "rawPrediction") == pytest.approx(exact)
    hard = hard_label_metrics(scored).first()
    rdd = scored.select("prediction", "label").rdd.map(lambda r: (float(r[0]), float(r[1])))
    m = BinaryClassificationMetrics(rdd)
    assert hard.auc_roc == pytest.approx(m.areaUnderROC)
    assert hard.auc_pr == pytest.approx(m.areaUnderPR)


def test_forest_search_spreads_its_rows_and_keeps_its_forests(spark, inputs, monkeypatch):
    """Rows that one task took are dealt to several; the search fits what a plain classifier fits."""
    from pyspark.ml.classification import RandomForestClassifier

    from sheaf.operators import model as M
    one = inputs.train.coalesce(1)
    assert M.spread(one).rdd.getNumPartitions() == 1  # too few rows to deal
    dealt = M.spread(one, least_bytes=1 << 12)
    assert 1 < dealt.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert sorted(r[0] for r in dealt.select("business_id").collect()) == sorted(
        r[0] for r in one.select("business_id").collect())
    seen = []
    monkeypatch.setattr(M, "cross_validate", lambda est, grid, train, **kw: seen.append((est, train)))
    monkeypatch.setattr(M, "spread", lambda rows: dealt)
    M.forest_cv(one)
    (est, train), = seen
    assert train is dealt and est.getCacheNodeIds()
    rows = train.cache()
    plain = RandomForestClassifier(seed=M.SEED, numTrees=12).fit(rows)
    assert est.copy({est.numTrees: 12}).fit(rows).toDebugString.split("\n")[1:] == plain.toDebugString.split("\n")[1:]


def test_spread_of_vectors_without_metadata(spark):
    from pyspark.ml.functions import array_to_vector

    from sheaf.operators.model import spread
    df = spark.range(0, 1000, 1, 1).select("id", array_to_vector(F.array(F.lit(1.0), F.lit(2.0))).alias("features"))
    dealt = spread(df, least_bytes=1 << 12)
    assert dealt.rdd.getNumPartitions() == min(spark.sparkContext.defaultParallelism, 1000 * 80 // 4096)
    assert dealt.count() == 1000 and spread(df.limit(0)).count() == 0


def test_spread_keeps_like_rows_together(spark):
    """A partition's rows are in the order of their features, ties by the other columns, whatever order they came in."""
    from pyspark.ml.functions import array_to_vector

    from sheaf.operators.model import spread
    k = F.col("id")
    x = array_to_vector(F.array((k * 7 % 5).cast("double"), F.when(k % 3 > 0, (k * 11 % 4).cast("double")).otherwise(-1.5)))
    df = spark.range(0, 1000, 1, 3).select((-k).alias("id"), x.alias("features"), (k % 2).cast("double").alias("label"))
    one = df.coalesce(1)
    for rows, parts in ((one, min(spark.sparkContext.defaultParallelism, 19)), (df.repartition(40), 40)):
        dealt = spread(rows, least_bytes=1 << 12)
        assert dealt.columns == df.columns and dealt.rdd.getNumPartitions() == parts
        groups = [[(r.features.toArray().tolist(), r.id, r.label) for r in g] for g in dealt.rdd.glom().collect()]
        assert all(g == sorted(g) for g in groups) and any(len(g) > 1 for g in groups)
        assert sorted(r for g in groups for r in g) == sorted((r.features.toArray().tolist(), r.id, r.label) for r in df.collect())
    small = spread(one, least_bytes=1 << 20)
    assert [r.id for r in small.collect()] == [r.id for r in one.collect()]


def _as_cross_validator(estimator, grid, train, folds):
    from pyspark.ml import Pipeline
    from pyspark.ml.tuning import CrossValidator

    from sheaf.operators.model import SEED, _grid
    return CrossValidator(estimator=Pipeline(stages=[estimator]), estimatorParamMaps=_grid(estimator, grid), numFolds=folds,
                          evaluator=BinaryClassificationEvaluator(labelCol="label"), seed=SEED, foldCol="fold").fit(train)


def test_fits_of_several_folds_run_at_once_and_score_as_spark_scores_them(spark, inputs, monkeypatch):
    """Every fit of the search waits for a fit of another fold: folds that follow each other would wait in vain."""
    import threading

    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    grid = {"regParam": (0.1, 0.01), "maxIter": (5, 20)}
    spark_cv = _as_cross_validator(LogisticRegression(), grid, inputs.train, 10)
    kept = set(spark.sparkContext._jsc.getPersistentRDDs())
    plain, meet, broken = Pipeline.fit, threading.Barrier(8), []

    def fit(self, rows, params=None):
        if threading.current_thread() is not threading.main_thread():
            try:
                meet.wait(60)
            except threading.BrokenBarrierError:
                broken.append(params)
        return plain(self, rows, params)
    monkeypatch.setattr(Pipeline, "fit", fit)
    cv = cross_validate(LogisticRegression(), grid, inputs.train, fold_col="fold")
    assert not broken
    assert cv.avgMetrics == pytest.approx(spark_cv.avgMetrics) and cv.stdMetrics == pytest.approx(spark_cv.stdMetrics)
    assert cv.bestModel.stages[-1].coefficients == spark_cv.bestModel.stages[-1].coefficients
    assert [list(m.values()) for m in cv.getEstimatorParamMaps()] == [list(m.values()) for m in spark_cv.getEstimatorParamMaps()]
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= kept


def test_folds_must_be_in_range_and_have_rows(spark, inputs):
    from pyspark.ml.classification import LogisticRegression
    lr, grid = LogisticRegression(), {"maxIter": (2,)}
    with pytest.raises(ValueError, match="range"):
        cross_validate(lr, grid, inputs.train, folds=9, fold_col="fold")
    with pytest.raises(ValueError, match="validation data at fold 3 is empty"):
        cross_validate(lr, grid, inputs.train.filter("fold <> 3"), fold_col="fold")
    with pytest.raises(ValueError, match="training data at fold 0 is empty"):
        cross_validate(lr, grid, inputs.train.filter("fold = 0"), fold_col="fold")
