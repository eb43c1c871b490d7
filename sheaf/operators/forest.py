"""A fitted forest as a table of nodes: scoring by joins, importances by sums.

The model's own ``transform`` scores faster; the table serves engines without the model, audits, and edits that
Spark's model class has no method for. Everything here reads the node table only.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.operators.columns import q


def node_table(spark: SparkSession, model) -> DataFrame:
    """tree, node, left, right (-1 at a leaf), feature, threshold, categories, gain, rows, stats, votes.

    The model is saved in the shared checkpoint folder and its data read back, so no node passes through the
    driver. ``categories`` are those that go left, for categorical splits (``threshold`` is null then); ``votes`` are the
    class shares of the node's rows.
    """
    from sheaf.session import scratch_path
    path = scratch_path(spark, "forest")
    model.write().save(path)
    raw = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    total = F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x)
    numeric = F.col("split.numCategories") < 0
    test = F.col("split.leftCategoriesOrThreshold")
    leaf = F.col("leftChild") < 0
    return raw.select(
        F.col("treeID").alias("tree"), F.col("id").alias("node"), F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"), F.when(~leaf, F.col("split.featureIndex")).alias("feature"),
        F.when(~leaf & numeric, F.get(test, F.lit(0))).alias("threshold"),
        F.when(~leaf & ~numeric, test).alias("categories"), F.when(~leaf, F.col("gain")).alias("gain"),
        total.alias("rows"), F.col("impurityStats").alias("stats"),
        F.transform("impurityStats", lambda x: x / total).alias("votes"))


def score_by_joins(nodes: DataFrame, df: DataFrame, trees: int, depth: int, key: str = "business_id",
                   features_col: str = "features") -> DataFrame:
    """key, raw (the summed votes of each class), probability, prediction: rows walk all trees, a level per join.

    Every (row, tree) pair joins the node that it is at; the joins are equi-joins on (tree, node), broadcast if Spark finds
    the table small enough. A pair at a leaf stays. Ties go to the lower class, as in the model.
    """
    at = df.select(q(key).alias("key"), vector_to_array(features_col).alias("x"),
                   F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), F.lit(0).alias("node"))
    step = nodes.select("tree", "node", "left", "right", "feature", "threshold", "categories")
    value = F.get("x", F.col("feature"))
    goes_left = F.when(F.col("categories").isNull(), value <= F.col("threshold")).otherwise(
        F.array_contains("categories", value))
    for _ in range(depth):
        went = F.when(F.col("left") < 0, F.col("node")).when(goes_left, F.col("left")).otherwise(F.col("right"))
        at = at.join(step, ["tree", "node"]).select("key", "x", "tree", went.alias("node"))
    votes = at.select("key", "tree", "node").join(nodes.select("tree", "node", "votes"), ["tree", "node"])
    sums = (votes.select("key", F.posexplode("votes").alias("class", "vote")).groupBy("key", "class")
            .agg(F.sum("vote").alias("vote")))
    pairs = sums.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("class", "vote"))).alias("pairs"))
    total = F.aggregate("pairs", F.lit(0.0), lambda a, x: a + x["vote"])
    best = F.array_max(F.transform("pairs", lambda x: F.struct(x["vote"].alias("vote"), (-x["class"]).alias("class"))))
    return pairs.select(F.col("key").alias(key), F.transform("pairs", lambda x: x["vote"]).alias("raw"),
                        F.transform("pairs", lambda x: x["vote"] / total).alias("probability"),
                        (-best["class"]).cast("double").alias("prediction"))


def importances_of_nodes(nodes: DataFrame) -> DataFrame:
    """feature, score: gain times rows summed by feature, to one per tree, then to one over the forest."""
    own = nodes.filter("feature IS NOT NULL").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("rows")).alias("s"))
    per_tree = own.groupBy("tree").agg(F.sum("s").alias("of")).filter("of > 0")
    share = (own.join(per_tree, "tree").groupBy("feature").agg(F.sum(F.col("s") / F.col("of")).alias("share")))
    total = share.agg(F.sum("share").alias("total"))
    total = total.first()["total"] or 1.0
    return share.select("feature", (F.col("share") / F.lit(total)).alias("score"))


#: A forest's score in plain SQL over ``nodes`` and ``rows_`` (key, x): the walk as a recursive query.
RECURSIVE_SQL = """
WITH RECURSIVE walk AS (
  SELECT key, tree, 0 AS node FROM rows_ CROSS JOIN (SELECT DISTINCT tree FROM nodes)
  UNION ALL
  SELECT w.key, w.tree, CASE WHEN CASE WHEN n.categories IS NULL THEN r.x[n.feature + 1] <= n.threshold
                                       ELSE list_contains(n.categories, r.x[n.feature + 1]) END
                             THEN n."left" ELSE n."right" END
  FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node JOIN rows_ r ON r.key = w.key
  WHERE n."left" >= 0)
SELECT w.key, sum(n.votes[1]) AS raw0, sum(n.votes[2]) AS raw1
FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node WHERE n."left" < 0 GROUP BY w.key
"""
