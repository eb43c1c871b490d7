"""The original semantics, randomSplit, JSON inputs and the forest's grid."""

from __future__ import annotations


from pyspark.sql import functions as F

from sheaf.operators.rollups import review_rollup
from sheaf.plans import oracle as O
from sheaf.plans.features import KEY, prepare_business
from sheaf.session import materialize, scratch_path
from sheaf.sources import fixtures as fx
from sheaf.sources.json import read_table, write_json
from sheaf.plans.queries.common import FIX, feat, register
from sheaf.plans.queries.models import fitted


# ------------------------------------------------------------------ original-semantics variants

@register("binary_flags_compat", O.sql(
    "SELECT business_id, t AS attributes_RestaurantsTakeOut, d AS attributes_RestaurantsDelivery, "
    "CASE WHEN t = 1 OR d = 1 THEN 1 ELSE 0 END AS pseudo_target FROM (SELECT business_id, "
    "CASE WHEN \"attributes.RestaurantsTakeOut\" = 'False' OR \"attributes.RestaurantsTakeOut\" "
    "IS NULL THEN 0 ELSE 1 END AS t, CASE WHEN \"attributes.RestaurantsDelivery\" = 'False' "
    "THEN 0 ELSE 1 END AS d FROM business)", "business"))
def q_binary_flags_compat(spark, sf):
    from dataclasses import replace
    b = prepare_business(fx.business(spark, sf), replace(FIX, compat=True))
    return b.select(KEY, "attributes_RestaurantsTakeOut", "attributes_RestaurantsDelivery",
                    "pseudo_target")


@register("random_split")
def q_random_split(spark, sf):
    """``randomSplit([0.7, 0.3], seed=42)`` as in the original; depends on input partitioning."""
    from sheaf.operators.split import seeded_split
    keys = materialize(feat(spark, sf).select(KEY), "keys")  # both parts must see the same rows
    parts = seeded_split(keys, FIX.split_weights, seed=42)
    return (parts[0].withColumn("split", F.lit("train"))
            .unionByName(parts[1].withColumn("split", F.lit("test"))))


@register("random_split_checked", O.sql(
    "SELECT business_id, CAST(1 AS BIGINT) AS times, TRUE AS in_a_part FROM feat", "feat"))
def q_random_split_checked(spark, sf):
    """The seeded split holds every key once."""
    return q_random_split(spark, sf).groupBy(KEY).agg(
        F.count(F.lit(1)).alias("times"), F.min(F.col("split").isin("train", "test")).alias("in_a_part"))


@register("review_rollup_json", O.sql(
    "SELECT CAST(business_id AS VARCHAR) AS business_id, * EXCLUDE (business_id) FROM rev", "rev"))
def q_review_rollup_json(spark, sf):
    """The review rollup over JSON-lines input: text keys and ``'yyyy-MM-dd HH:mm:ss'`` dates."""
    r = fx.review(spark, sf).select(
        "review_id", "user_id", F.col(KEY).cast("string").alias(KEY), "stars", "useful", "funny",
        "cool", F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("date"))
    path = write_json(r, scratch_path(spark, "json-review"))
    return review_rollup(read_table(spark, "review", path), FIX.review_as_of)


@register("rf_grid_metrics")
def q_rf_grid_metrics(spark, sf):
    from sheaf.operators.model import grid_metrics
    return grid_metrics(spark, fitted(spark, sf, "rf")[0])
