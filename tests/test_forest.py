"""A forest's node table against the model itself and against DuckDB; the optimum of the logistic regression."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from sheaf.operators.forest import RECURSIVE_SQL, importances_of_nodes, node_table, score_by_joins
from sheaf.operators.model import cross_validate, logistic_certificate
from sheaf.operators.split import fold_number


@pytest.fixture(scope="module")
def data(spark):
    r = np.random.default_rng(1)
    x = np.round(r.normal(size=(400, 5)), 2)
    x[:, 4] = 7.0
    y = (x[:, 0] + x[:, 1] * x[:, 2] + r.normal(scale=0.5, size=400) > 0).astype(float)
    rows = [(int(i), float(t), v.tolist()) for i, (t, v) in enumerate(zip(y, x))]
    df = spark.createDataFrame(rows, "business_id long, label double, x array<double>")
    return df.select("business_id", "label", array_to_vector("x").alias("features")).cache()


@pytest.fixture(scope="module")
def forest(data):
    return RandomForestClassifier(seed=3, numTrees=12, maxDepth=4).fit(data)


def test_votes_by_joins_and_by_recursion(spark, data, forest):
    import duckdb
    nodes = node_table(spark, forest)
    got = {r.business_id: r for r in score_by_joins(nodes, data, 12, 4).collect()}
    want = forest.transform(data).select("business_id", vector_to_array("rawPrediction").alias("raw"), "prediction",
                                         vector_to_array("probability").alias("p")).collect()
    assert len(got) == len(want) == 400
    con = duckdb.connect()
    con.register("nodes", nodes.toArrow())
    con.register("rows_", data.select(F.col("business_id").alias("key"), vector_to_array("features").alias("x")).toArrow())
    sql = {k: (a, b) for k, a, b in con.execute(RECURSIVE_SQL).fetchall()}
    for r in want:
        assert got[r.business_id].raw == pytest.approx(r.raw, abs=1e-9)
        assert sql[r.business_id] == pytest.approx(r.raw, abs=1e-9)
        assert got[r.business_id].probability == pytest.approx(r.p, abs=1e-9)
        assert got[r.business_id].prediction == r.prediction or abs(r.raw[0] - r.raw[1]) < 1e-9


def test_categorical_splits(spark):
    """A feature of few values, declared nominal, is split by sets of categories."""
    from pyspark.ml.feature import VectorAssembler, VectorIndexer
    rows = [(i, float(i % 5 in (1, 3)), float(i % 5), float(i % 7)) for i in range(200)]
    df = spark.createDataFrame(rows, "business_id long, label double, c double, z double")
    df = VectorAssembler(inputCols=["c", "z"], outputCol="raw").transform(df)
    df = VectorIndexer(inputCol="raw", outputCol="features", maxCategories=6).fit(df).transform(df)
    model = RandomForestClassifier(seed=1, numTrees=5, maxDepth=3).fit(df)
    nodes = node_table(spark, model)
    assert nodes.filter("categories IS NOT NULL").count() > 0
    got = {r.business_id: r.raw for r in score_by_joins(nodes, df, 5, 3).collect()}
    for r in model.transform(df).select("business_id", vector_to_array("rawPrediction").alias("raw")).collect():
        assert got[r.business_id] == pytest.approx(r.raw, abs=1e-9)


def test_importances(spark, forest):
    got = {r.feature: r.score for r in importances_of_nodes(node_table(spark, forest)).collect()}
    assert [got.get(i, 0.0) for i in range(5)] == pytest.approx(list(forest.featureImportances.toArray()), abs=1e-9)


def test_a_tree_without_a_split(spark, data):
    model = RandomForestClassifier(seed=3, numTrees=2, maxDepth=0).fit(data)
    nodes = node_table(spark, model)
    assert nodes.count() == 2 and importances_of_nodes(nodes).count() == 0
    assert score_by_joins(nodes, data, 2, 0).count() == 400


@pytest.mark.parametrize("reg", [0.1, 0.01])
def test_certificate_holds_at_the_optimum_only(data, reg):
    model = LogisticRegression(regParam=reg, maxIter=150, tol=1e-10).fit(data)
    rows = {r.feature: r for r in logistic_certificate(model, data).collect()}
    assert sorted(rows) == [-1, 0, 1, 2, 3, 4]
    assert max(abs(r.gradient) for r in rows.values()) < 1e-4, rows
    assert rows[4].std == 0 and rows[4].coefficient == 0
    x = np.array([r.features.toArray() for r in data.collect()])
    assert rows[0].mean == pytest.approx(x[:, 0].mean()) and rows[1].std == pytest.approx(x[:, 1].std(ddof=1))
    early = LogisticRegression(regParam=reg, maxIter=2).fit(data)
    assert max(abs(r.gradient) for r in logistic_certificate(early, data).collect()) > 1e-3


def test_folds_are_the_rows_own(spark, data):
    df = data.withColumn("fold", fold_number("business_id", 4))
    sizes = [r["count"] for r in df.groupBy("fold").count().collect()]
    assert len(sizes) == 4 and min(sizes) > 60
    grid = {"regParam": (0.1, 0.01)}
    a = cross_validate(LogisticRegression(maxIter=20), grid, df, folds=4, fold_col="fold")
    b = cross_validate(LogisticRegression(maxIter=20), grid, df.repartition(7), folds=4, fold_col="fold")
    assert a.avgMetrics == pytest.approx(b.avgMetrics, abs=1e-9)
