"""Queries of the checked JSON source and of distinct counts by bitmap."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheaf.operators.rollups import distinct_by_bitmap
from sheaf.plans.queries.common import register
from sheaf.session import scratch_path
from sheaf.sources.json import read_json_checked
from sheaf.sources.tables import load

_ORDER = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderstatus", T.StringType()),
                       T.StructField("o_shippriority", T.IntegerType())])


@register("json_rejects", """
SELECT kind, count(*) AS n, CAST(sum(CASE WHEN kind IN ('row', 'drifted') THEN o_orderkey END) AS BIGINT) AS key_sum
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN 'malformed' WHEN o_orderkey % 101 = 0 THEN 'not an object'
                              WHEN o_orderkey % 89 = 0 THEN 'drifted' ELSE 'row' END AS kind FROM orders)
GROUP BY kind""")
def q_json_rejects(spark, sf):
    """The orders as JSON lines, of which some are cut off, some are bare numbers and some hold text where a
    number belongs; read back, every line counts once."""
    key = F.col("o_orderkey")
    line = F.to_json(F.struct("o_orderkey", "o_orderstatus", F.when(key % 89 == 0, "none").otherwise("7").alias(
        "o_shippriority")))
    lines = load(spark, sf, "orders").select("o_orderkey", line.alias("line"))
    cut = F.when(key % 97 == 0, F.expr("substring(line, 1, length(line) - 3)")).when(
        key % 101 == 0, key.cast("string")).otherwise(F.col("line"))
    path = scratch_path(spark, "orders-json")
    lines.select(cut.alias("value")).write.text(path)
    rows, rejects = read_json_checked(spark, path, _ORDER)
    kind = F.when(F.size("drifted") > 0, "drifted").otherwise("row")
    every = rows.select(kind.alias("kind"), F.col("o_orderkey").alias("key")).unionByName(
        rejects.select(F.col("reason").alias("kind"), F.lit(None).cast("long").alias("key")))
    return every.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum("key").alias("key_sum"))


@register("distinct_by_bitmap", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(DISTINCT o_custkey) AS n_customers FROM orders GROUP BY 1""")
def q_distinct_by_bitmap(spark, sf):
    return distinct_by_bitmap(load(spark, sf, "orders"), F.col("o_custkey"), {"year": F.year("o_orderdate")}, "n_customers")
