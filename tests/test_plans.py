"""Plan properties that matter at scale."""

import re
import uuid

from pyspark.sql import functions as F

from sheaf.operators.encode import OneHotEncoder
from sheaf.operators.impute import MeanImputer
from sheaf.operators.profile import missing_counts
from sheaf.plans import catalog as C


def jobs_of(spark, fn):
    sc = spark.sparkContext
    group = uuid.uuid4().hex
    sc.setJobGroup(group, "count jobs")
    try:
        fn()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group))


def wide(spark, n):
    return spark.range(1000).select(*[(F.col("id") % (i + 3)).alias(f"c{i}") for i in range(n)],
                                    (F.col("id") % 7).cast("string").alias("s"))


def test_imputer_is_one_aggregation_whatever_the_width(spark):
    one = jobs_of(spark, lambda: MeanImputer(["c0"]).fit(wide(spark, 1)))
    many = jobs_of(spark, lambda: MeanImputer([f"c{i}" for i in range(12)]).fit(wide(spark, 12)))
    assert one == many


def test_profile_is_one_aggregation_whatever_the_width(spark):
    one = jobs_of(spark, lambda: missing_counts(wide(spark, 1)).collect())
    many = jobs_of(spark, lambda: missing_counts(wide(spark, 30)).collect())
    assert one == many


def test_one_hot_levels_in_one_scan(spark):
    df = wide(spark, 3)
    one = jobs_of(spark, lambda: OneHotEncoder(["s"]).fit(df))
    three = jobs_of(spark, lambda: OneHotEncoder(["s", "c0", "c1"]).fit(df))
    assert one == three


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_star_join_reuses_rollup_partitioning(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(C.feat(spark, "/root/testdata/sf0.01"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # customer, part (fixture join), review x2 (per (key, id), per key), check-in, tip, target:
    # one exchange per aggregation input, none added by the joins
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 7
    assert plan.count("SortMergeJoin") == 5 and "BroadcastNestedLoopJoin" not in plan


def test_top_k_is_not_a_global_sort(spark):
    plan = _plan(C.QUERIES["top_k_tokens"](spark, "/root/testdata/sf0.01"))
    assert "TakeOrderedAndProject" in plan


def test_allow_list_is_a_literal_set(spark):
    plan = _plan(C.QUERIES["allow_list_filter"](spark, "/root/testdata/sf0.01"))
    assert re.search(r"\bIn(Set)?\(", plan) or " INSET " in plan.upper()


def test_review_rollup_spreads_a_hot_key(spark):
    plan = _plan(C.QUERIES["review_rollup"](spark, "/root/testdata/sf0.01"))
    parts = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    assert any("business_id" in p and "_id" in p.replace("business_id", "") for p in parts)
    assert "Generate inline" in plan or "Generate" in plan


def test_one_hot_reads_no_fact_table(spark):
    plan = _plan(C.QUERIES["one_hot"](spark, "/root/testdata/sf0.01"))
    assert "customer.parquet" in plan
    assert not any(t in plan for t in ("orders.parquet", "events.parquet", "labels.parquet"))


def test_quantiles_in_three_passes(spark, monkeypatch):
    """One pass sketches, at most one narrows and one ranks, with a third of the rows at one value."""
    from sheaf.operators import quantiles as Q
    passes = []
    for name in ("_sketch_pass", "_rank_pass"):
        def counted(*a, name=name, call=getattr(Q, name)):
            passes.append(name)
            return call(*a)
        monkeypatch.setattr(Q, name, counted)
    n = 200_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.pmod(F.xxhash64("id"), F.lit(n)) / n).alias("v"))
    got = Q.exact_quantiles_multi(df, ["v"], [0.1, 0.25, 0.5, 0.75, 0.9])["v"]
    assert passes == ["_sketch_pass", "_rank_pass"]
    passes.clear()
    small = Q.exact_quantiles_multi(df, ["v"], [0.1, 0.25, 0.5, 0.75, 0.9], max_exact_rows=1000, accuracy=1024)["v"]
    assert passes == ["_sketch_pass", "_sketch_pass", "_rank_pass"]
    values = sorted(r.v for r in df.collect())
    assert got == small == [values[-(-int(p * 100) * n // 100) - 1] for p in (0.1, 0.25, 0.5, 0.75, 0.9)]


def test_quantiles_mend_ends_that_miss(spark, monkeypatch):
    """Ends that do not enclose the rank are found out by the counts and moved apart."""
    from sheaf.operators import quantiles as Q
    monkeypatch.setattr(Q, "sketch_error", lambda k: 1e-6)
    df = spark.range(5000).select((F.pmod(F.xxhash64("id"), F.lit(2500)) - 1000).cast("double").alias("v"))
    values = sorted(r.v for r in df.collect())
    for most in (20, 10_000):
        got = Q.exact_quantiles(df, "v", [0.01, 0.5, 0.99], max_exact_rows=most, accuracy=8)
        assert got == [values[49], values[2499], values[4949]]


def test_quantiles_of_odd_values(spark):
    from sheaf.operators.quantiles import exact_quantiles_multi
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(-inf, None, 1), (inf, None, 1), (nan, nan, 1), (None, None, 1), (0.0, None, 1), (-0.0, None, 1)],
                               "a double, b double, `c.d` int")
    got = exact_quantiles_multi(df, ["a", "b", "c.d"], [0.0, 0.5, 1.0])
    assert got == {"a": [-inf, 0.0, inf], "b": [None, None, None], "c.d": [1.0, 1.0, 1.0]}
    assert exact_quantiles_multi(df.limit(0), ["a"], [0.5]) == {"a": [None]}


def test_businesses_are_dealt_before_their_texts_are_parsed(spark):
    """Hours are parsed on rows dealt by the key, not in the few tasks that read a small file. (Where the businesses come
    out of a join on the key they are dealt already: test_star_join_reuses_rollup_partitioning.)"""
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        steps = _plan(C.feat(spark, "/root/testdata/sf0.01")).split("\n")  # printed from the last step to the first
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    parsed = next(i for i, s in enumerate(steps) if "AS Days_open" in s)
    dealt = next(i for i, s in enumerate(steps) if "REPARTITION_BY_COL" in s)
    assert parsed < dealt < next(i for i, s in enumerate(steps) if "customer.parquet" in s)
    assert sum("REPARTITION_BY_COL" in s for s in steps) == 1
