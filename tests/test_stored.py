"""Rollups kept in buckets, and profiles observed on a write."""

import os
import re

import pytest
from pyspark.sql import functions as F

from sheaf.operators.bucketed import (bucket_count, bucket_rollups, bucketed_star_join, drop_bucketed, write_bucketed)
from sheaf.operators.joins import star_join
from sheaf.operators.observed import write_observed
from sheaf.operators.profile import missing_counts, missing_share, sparse_columns
from sheaf.plans import catalog as C
from sheaf.plans.features import base_table, feature_table, stored_rollups
from sheaf.plans.queries.common import FIX, tables

SF = "/root/testdata/sf0.01"


def _plan(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def _rows(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


@pytest.fixture
def sides(spark):
    facts = spark.range(4000).select((F.col("id") % 700).alias("k"), (F.col("id") % 11).alias("x"))
    facts = facts.union(spark.createDataFrame([(None, 5)], "k long, x long"))
    return [facts.groupBy("k").agg(F.sum("x").alias("s")), facts.filter("k % 3 = 0").groupBy("k").agg(F.count("x").alias("n"))]


def test_stored_rollups_are_not_dealt_again(spark, sides):
    entity = spark.range(1000).select(F.when(F.col("id") % 50 > 0, F.col("id")).alias("k"), F.lit("e").alias("e"))
    stored = bucket_rollups(sides, "k", 4)
    joined = bucketed_star_join(entity, stored, "k")
    plan = _plan(joined)
    assert len(re.findall(r"Exchange hashpartitioning\(k#\d+L, 4\)", plan)) == 1 and plan.count("Exchange ") == 1
    assert plan.count("SortMergeJoin") == 2 and "Broadcast" not in plan
    assert _rows(joined) == _rows(star_join(entity, sides, "k"))
    kept = write_bucketed(entity, "k", 4)
    plan = _plan(bucketed_star_join(kept.read(spark), stored, "k"))
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 2
    drop_bucketed(spark, [*stored, kept])
    assert not any(spark.catalog.tableExists(s.name) for s in (*stored, kept))


def test_a_bucket_is_one_file(spark, sides):
    t = write_bucketed(sides[0], "k", 8)
    files = [f for f in os.listdir(t.path.removeprefix("file:")) if f.endswith(".parquet")]
    assert len(files) == 8 and _rows(t.read(spark)) == _rows(sides[0])


def test_buckets_must_agree(spark, sides):
    stored = [write_bucketed(sides[0], "k", 4), write_bucketed(sides[1], "k", 8)]
    with pytest.raises(ValueError, match="same key"):
        bucketed_star_join(spark.range(3).withColumnRenamed("id", "k"), stored, "k")


def test_bucket_count_follows_the_largest():
    assert bucket_count([]) == bucket_count([0, 1]) == 1
    assert bucket_count([5, 100], bucket_bytes=10) == 16 and bucket_count([160], bucket_bytes=10) == 16
    assert bucket_count([161], bucket_bytes=10) == 32


def test_feature_tables_over_stored_rollups(spark):
    t = tables(spark, SF)
    stored = stored_rollups(t, FIX, 4)
    feat = feature_table(t, FIX, stored=stored)
    assert feat.schema == feature_table(t, FIX).schema and _rows(feat) == _rows(feature_table(t, FIX))
    plan = _plan(feat)
    assert not any(x in plan for x in ("orders.parquet", "events.parquet", "labels.parquet"))


def test_observed_profile_equals_the_passes(spark, tmp_path):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, "", None, 1), (nan, "NaN", None, None), (None, None, None, 2), (2.0, "x", None, 3)],
                               "`a.b` double, t string, d date, `c d` int")
    table, p = write_observed(df, str(tmp_path / "t"))
    assert _rows(table) == _rows(df) and p.rows == 4
    assert p.missing == missing_counts(df).first().asDict()
    assert p.missing_or_empty == missing_counts(df, empty_as_missing=True).first().asDict()
    assert {c: p.share(c) for c in df.columns} == missing_share(df).first().asDict()
    for threshold, keep in ((0.4, ()), (0.2, ("d",)), (0.25, ())):
        assert p.sparse_columns(threshold, keep) == sparse_columns(df, threshold, keep)
    assert [r.missing for r in p.to_frame(spark).collect()] == [2, 2, 4, 1]
    empty, none = write_observed(df.limit(0), str(tmp_path / "e"), nulls_only=True)
    assert empty.count() == 0 and none.rows == 0 and none.sparse_columns() == [] and none.missing is None
    assert [r.share for r in none.to_frame(spark).collect()] == [None] * 4


def test_observed_after_a_shuffle(spark, tmp_path):
    df = spark.range(0, 4000, 1, 4).select("id", F.when(F.col("id") % 4 > 0, F.col("id")).alias("x"))
    _, p = write_observed(df.repartition(8, "id"), str(tmp_path / "r"))
    assert (p.rows, p.nulls["x"]) == (4000, 1000)


def test_observing_leaves_the_session_usable_for_models(spark, tmp_path):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector
    df = spark.range(200).select((F.col("id") % 2).cast("double").alias("label"),
                                 F.array((F.col("id") % 7).cast("double"), (F.col("id") % 2).cast("double")).alias("x"))
    table, p = write_observed(df, str(tmp_path / "m"))
    train = table.select("label", array_to_vector("x").alias("features"))
    model = LogisticRegression(regParam=0.1).fit(train)
    assert model.transform(train).filter("prediction = label").count() == p.rows == 200


def test_observed_write_keeps_the_sessions_settings(spark, tmp_path, ansi):
    from pyspark.sql import SparkSession
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.createDataFrame([("1",), ("x",), (None,)], "t string").groupBy("t").agg(F.expr("try_cast(t AS int)").alias("n"))
        table, p = write_observed(df, str(tmp_path / "s"))
        assert len(list((tmp_path / "s").glob("part-*.parquet"))) <= 3 and p.nulls == {"t": 1, "n": 2}
        assert _rows(table) == _rows(df) and SparkSession.getActiveSession() is not None
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert not [t for t in spark.catalog.listTables("global_temp") if t.name.startswith("sheaf_")]


def test_base_table_needs_no_sparse_pass(spark, monkeypatch):
    from sheaf.plans import features
    t = tables(spark, SF)
    want = _rows(base_table(t, FIX))

    def fail(*a, **kw):
        raise AssertionError("a pass for sparse columns")
    monkeypatch.setattr(features, "drop_sparse", fail)
    assert _rows(base_table(t, FIX)) == want


def test_queries_are_registered():
    assert {"feature_join_bucketed", "profile_on_write"} <= set(C.QUERIES) & set(C.ORACLE)


def test_observed_writes_run_compiled(spark):
    """A generated method that HotSpot would interpret is not used in the write; the caller's session keeps its setting."""
    from sheaf.operators import observed
    limit = "spark.sql.codegen.hugeMethodLimit"
    old = spark.conf.get(limit)
    with observed._in_own_session(spark.range(1)) as table:
        assert int(table.sparkSession.conf.get(limit)) == 8000
    assert spark.conf.get(limit) == old
    spark.conf.set(limit, "500")
    try:
        with observed._in_own_session(spark.range(1)) as table:
            assert table.sparkSession.conf.get(limit) == "500"
    finally:
        spark.conf.set(limit, old)
