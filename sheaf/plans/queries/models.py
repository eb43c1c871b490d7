"""Metrics, the formula, the flagship base table and the model queries."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.functions.safe import round_half_up
from sheaf.operators.columns import q
from sheaf.operators.metrics import accuracy, auc_roc, hard_label_metrics
from sheaf.plans import oracle as O
from sheaf.plans.features import KEY, TARGET
from sheaf.plans.queries.common import (FIX, CARDS, PRICE, HOURS_FEATURES, register, tables, biz,
                                        feat, STATES, BUCKET_SQL)


# ----------------------------------------------------------------------------------- metrics

def _scored(spark, sf) -> DataFrame:
    """Rows with a target and a score: target vs average review stars."""
    return (feat(spark, sf).filter(q(TARGET).isNotNull() & F.col("avg_stars").isNotNull())
            .select(KEY, q(TARGET).cast("double").alias("label"),
                    F.col("avg_stars").alias("score"),
                    F.when(F.col("avg_stars") >= 3.0, 1.0).otherwise(0.0).alias("prediction")))


_SCORED = ('SELECT CAST("delivery or takeout" AS DOUBLE) AS y, avg_stars AS s, '
           'CASE WHEN avg_stars >= 3.0 THEN 1.0 ELSE 0.0 END AS p FROM feat '
           'WHERE "delivery or takeout" IS NOT NULL AND avg_stars IS NOT NULL')


@register("auc_roc", O.sql(f"""
SELECT {O.r2("(sum(CASE WHEN y = 1 THEN rk END) - max(P) * (max(P) + 1) / 2) / (max(P) * max(N))", 6)} AS auc_roc
FROM (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS rk,
             sum(y) OVER () AS P, count(*) OVER () - sum(y) OVER () AS N
      FROM ({_SCORED}))""", "feat"))
def q_auc_roc(spark, sf):
    v = auc_roc(_scored(spark, sf), "label", "score")
    return spark.range(1).select(round_half_up(F.lit(v), 6).alias("auc_roc"))


_CONF = ("SELECT CAST(count_if(y = 1 AND p = 1) AS DOUBLE) AS tp, "
         "CAST(count_if(y = 0 AND p = 1) AS DOUBLE) AS fp, "
         "CAST(count_if(y = 0 AND p = 0) AS DOUBLE) AS tn, "
         f"CAST(count_if(y = 1 AND p = 0) AS DOUBLE) AS fn FROM ({_SCORED})")


@register("hard_label_auc", O.sql(f"""
SELECT {O.r2("(1.0 + tpr - fpr) / 2", 6)} AS auc_roc,
       {O.r2("tpr * prec + (1.0 - tpr) * (prec + prev) / 2", 6)} AS auc_pr,
       {O.r2("(tp + tn) / (tp + fp + tn + fn)", 6)} AS accuracy
FROM (SELECT *, tp / (tp + fn) AS tpr, fp / (fp + tn) AS fpr,
             COALESCE(tp / NULLIF(tp + fp, 0), (tp + fn) / (tp + fp + tn + fn)) AS prec,
             (tp + fn) / (tp + fp + tn + fn) AS prev
      FROM ({_CONF}))""", "feat"))
def q_hard_label_auc(spark, sf):
    m = hard_label_metrics(_scored(spark, sf))
    return m.select(*[round_half_up(c, 6).alias(c) for c in m.columns])


@register("accuracy", O.sql(
    f"SELECT {O.r2('avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END)', 6)} AS accuracy FROM ({_SCORED})",
    "feat"))
def q_accuracy(spark, sf):
    a = accuracy(_scored(spark, sf))
    return a.select(round_half_up("accuracy", 6).alias("accuracy"))


# ------------------------------------------------------------------------- formula and models

_RF_COLS = ["business_id", "pseudo_target", "stars", "review_count", "Days_open", "city"]


def _rformula_sql(n_levels: int = 25) -> str:
    onehot = ", ".join(f"CAST(CASE WHEN lv.idx = {j} THEN 1 ELSE 0 END AS DOUBLE) AS f{3 + j}"
                       for j in range(n_levels - 1))
    return O.sql(f"""
SELECT r.business_id, CAST(r.pseudo_target AS DOUBLE) AS label, CAST(r.stars AS DOUBLE) AS f0,
  CAST(r.review_count AS DOUBLE) AS f1, CAST(r.Days_open AS DOUBLE) AS f2, {onehot}
FROM rest r JOIN (SELECT city, row_number() OVER (ORDER BY count(*) DESC, city) - 1 AS idx
                  FROM rest GROUP BY city) lv USING (city)""", "rest")


@register("rformula_features", _rformula_sql())
def q_rformula_features(spark, sf):
    from sheaf.operators.model import rformula
    from sheaf.plans.features import restaurants
    rest = restaurants(biz(spark, sf), FIX).select(*_RF_COLS)
    m = rformula(rest, "pseudo_target", exclude=(KEY,))
    out = m.transform(rest)
    n = out.schema["features"].metadata["ml_attr"]["num_attrs"]
    arr = vector_to_array("features")
    return out.select(KEY, "label", *[arr[i].alias(f"f{i}") for i in range(n)])


def fitted(spark, sf, kind: str):
    """(cross-validated model, inputs), fitted anew: "lr" or "rf"."""
    from sheaf.operators.model import forest_cv, logistic_cv
    from sheaf.plans.features import FOLD, model_inputs
    inputs = model_inputs(tables(spark, sf), FIX)
    return (logistic_cv if kind == "lr" else forest_cv)(inputs.train, fold_col=FOLD), inputs


def base_table_sql() -> str:
    """The flagship end to end, for sf0.01 (levels and sparse columns as observed there)."""
    woe_cols = ["cat1", "cat2", "cat3"]
    num = (["stars", "review_count", "is_open"] + woe_cols + HOURS_FEATURES
           + ["avg_stars", "nbr_reviews", "total_cool", "total_funny", "total_useful",
              "total_votes", "avg_votes", "recent_review", "ratio_cool", "ratio_funny",
              "ratio_useful"])
    card = (f"CASE WHEN {CARDS} = 'True' THEN 'Yes' WHEN {CARDS} = 'False' THEN 'No' "
            f"ELSE 'Missing' END")
    hot = ([(f"state_{v}", f"state = '{v}'") for v in STATES]
           + [(f"BusinessAcceptsCreditCards_{v}", f"{card} = '{v}'") for v in ("No", "Yes")]
           + [(f"RestaurantsPriceRange_{v}", f"COALESCE({PRICE}, '0') = '{v}'")
              for v in ("1", "2", "3", "4")])
    feats = num + [n for n, _ in hot]
    stats = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c} AS level, sum(y) AS pos, count(y) AS n FROM tr GROUP BY {c}"
        for c in woe_cols)
    zero = "CAST(0 AS DOUBLE)"
    body = f"""
, enc AS (SELECT business_id, {", ".join(num)}, "delivery or takeout" AS delivery_or_takeout,
            {", ".join(f"CASE WHEN {cond} THEN 1 ELSE 0 END AS {n}" for n, cond in hot)}
          FROM feat),
sp AS (SELECT *, CASE WHEN {BUCKET_SQL} < 7000 THEN 'train' ELSE 'test' END AS split FROM enc),
tr AS (SELECT *, CAST(delivery_or_takeout AS DOUBLE) AS y FROM sp
       WHERE split = 'train' AND delivery_or_takeout IS NOT NULL),
tot AS (SELECT CAST(sum(y) AS DOUBLE) AS p, CAST(count(y) AS DOUBLE) AS n FROM tr),
st AS ({stats}),
mp AS (SELECT feature, level, CASE WHEN st.n = 1 THEN {zero} ELSE {O.r2(
         "ln(((st.pos + 1.0) / (tot.p + 2.0)) / ((st.n - st.pos + 1.0) / (tot.n - tot.p + 2.0)))",
         6)} END AS woe FROM st, tot),
w AS (SELECT sp.* REPLACE ({", ".join(f"COALESCE(m{i}.woe, {zero}) AS {c}"
                                       for i, c in enumerate(woe_cols))})
      FROM sp {" ".join(f"LEFT JOIN mp m{i} ON m{i}.feature = '{c}' AND "
                        f"m{i}.level IS NOT DISTINCT FROM sp.{c}" for i, c in enumerate(woe_cols))}),
mu AS (SELECT {", ".join(f"{O.r2(f'avg(COALESCE(CAST({c} AS DOUBLE), {zero}))')} AS {c}"
                         for c in feats)} FROM w WHERE split = 'train' AND delivery_or_takeout IS NOT NULL)
SELECT w.business_id, {", ".join(f"COALESCE(CAST(w.{c} AS DOUBLE), mu.{c}) AS {c}" for c in feats)},
  w.delivery_or_takeout, w.split
FROM w, mu"""
    base = O.sql("SELECT 1", "feat")
    return base[: base.rindex("\nSELECT 1")] + body


@register("base_table", base_table_sql())
def q_base_table(spark, sf):
    from sheaf.plans.features import base_table
    return base_table(tables(spark, sf), FIX)


def _predict(spark, sf, kind: str) -> DataFrame:
    from sheaf.operators.model import predictions
    cv, inputs = fitted(spark, sf, kind)
    return predictions(cv, inputs.test)


def _metrics(spark, sf, kind: str) -> DataFrame:
    from sheaf.operators.model import predictions
    cv, inputs = fitted(spark, sf, kind)
    auc = auc_roc(cv.transform(inputs.test), "label", "rawPrediction")
    return hard_label_metrics(predictions(cv, inputs.test)).select(
        F.lit(auc).alias("auc_roc_scores"), F.col("auc_roc").alias("auc_roc_labels"),
        F.col("auc_pr").alias("auc_pr_labels"), "accuracy")


@register("lr_predict")
def q_lr_predict(spark, sf):
    return _predict(spark, sf, "lr")


@register("rf_predict")
def q_rf_predict(spark, sf):
    return _predict(spark, sf, "rf")


@register("lr_metrics")
def q_lr_metrics(spark, sf):
    return _metrics(spark, sf, "lr")


@register("rf_metrics")
def q_rf_metrics(spark, sf):
    return _metrics(spark, sf, "rf")


@register("cv_grid_metrics")
def q_cv_grid_metrics(spark, sf):
    from sheaf.operators.model import grid_metrics
    return grid_metrics(spark, fitted(spark, sf, "lr")[0])


@register("feature_importance")
def q_feature_importance(spark, sf):
    from sheaf.operators.model import feature_importances
    cv, inputs = fitted(spark, sf, "rf")
    return feature_importances(spark, cv.bestModel.stages[-1].featureImportances, inputs.train)


_FOLD_SQL = "(CAST(('0x' || substr(md5(CAST(business_id AS VARCHAR)), 9, 8)) AS BIGINT) % 10)"


@register("cv_folds", O.sql(f"""
SELECT CAST({_FOLD_SQL} AS INTEGER) AS fold, count(*) AS n,
       CAST(sum(CAST("delivery or takeout" AS DOUBLE)) AS DOUBLE) AS positives FROM feat
WHERE "delivery or takeout" IS NOT NULL AND {BUCKET_SQL} < 7000 GROUP BY 1""", "feat"))
def q_cv_folds(spark, sf):
    """Rows and positive labels of every fold that cross-validation uses."""
    from sheaf.plans.features import FOLD, model_inputs
    train = model_inputs(tables(spark, sf), FIX).train
    return train.groupBy(FOLD).agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("positives"))


def _certificate_sql() -> str:
    return f"""
WITH bt AS ({base_table_sql()}),
long AS (UNPIVOT (SELECT * EXCLUDE (business_id, delivery_or_takeout, split) FROM bt
                  WHERE split = 'train' AND delivery_or_takeout IS NOT NULL)
         ON COLUMNS(*) INTO NAME feature VALUE x),
stats AS (SELECT feature, {O.r2("avg(x)", 6)} AS mean, {O.r2("stddev_samp(x)", 6)} AS std FROM long GROUP BY feature
          UNION ALL SELECT '(intercept)', 1.0, 0.0)
SELECT CAST(p.reg AS DOUBLE) AS reg_param, feature, mean, std, TRUE AS at_optimum
FROM stats, (VALUES (0.1), (0.01)) p(reg)"""


@register("lr_certificate", _certificate_sql())
def q_lr_certificate(spark, sf):
    """For every penalty of the grid and every feature: its moments, and that the gradient of the penalised loss
    vanishes at the fitted coefficients (below 1e-4), which only the optimum does."""
    from pyspark.ml.classification import LogisticRegression

    from sheaf.operators.model import LR_GRID, logistic_certificate
    from sheaf.plans.features import model_inputs
    train = model_inputs(tables(spark, sf), FIX).train
    attrs = train.schema["features"].metadata["ml_attr"]["attrs"]
    names = spark.createDataFrame([(-1, "(intercept)"), *((a["idx"], a["name"]) for g in attrs.values() for a in g)],
                                  "feature int, name string")
    out = []
    for reg in LR_GRID["regParam"]:
        model = LogisticRegression(regParam=reg, maxIter=max(LR_GRID["maxIter"]), tol=1e-10).fit(train)
        out.append(logistic_certificate(model, train).join(names, "feature").select(
            F.lit(float(reg)).alias("reg_param"), F.col("name").alias("feature"), round_half_up("mean", 6).alias("mean"),
            round_half_up("std", 6).alias("std"), (F.abs("gradient") < 1e-4).alias("at_optimum")))
    return out[0].unionByName(out[1])


def _forest_facts(spark, cv, inputs) -> dict:
    """Whether the node table alone gives the model's votes and importances."""
    from sheaf.operators.forest import importances_of_nodes, node_table, score_by_joins
    model = cv.bestModel.stages[-1]
    nodes = node_table(spark, model)
    own = score_by_joins(nodes, inputs.test, model.getNumTrees, model.getOrDefault("maxDepth"))
    theirs = cv.transform(inputs.test).select(KEY, vector_to_array("rawPrediction").alias("votes"),
                                              F.col("prediction").alias("p"))
    off = F.abs(F.col("raw")[1] - F.col("votes")[1]) + F.abs(F.col("raw")[0] - F.col("votes")[0])
    same = own.join(theirs, KEY, "full").agg(
        F.coalesce(F.max(F.coalesce(off, F.lit(1.0))) < 1e-9, F.lit(True)).alias("votes"),
        F.coalesce(F.bool_and((F.col("prediction") == F.col("p")) | (F.abs(F.col("raw")[0] - F.col("raw")[1]) < 1e-9)),
                   F.lit(True)).alias("labels")).first()
    mine = {r["feature"]: r["score"] for r in importances_of_nodes(nodes).collect()}  # one per feature
    given = model.featureImportances
    close = all(abs(mine.get(i, 0.0) - given[i]) < 1e-9 for i in range(given.size))
    return {"votes_from_nodes": F.lit(bool(same["votes"])), "labels_from_nodes": F.lit(bool(same["labels"])),
            "importances_from_nodes": F.lit(close)}


@register("forest_importance_of_nodes")
def q_forest_importance_of_nodes(spark, sf):
    """Importances of a forest of the grid's smallest size, from its node table."""
    from pyspark.ml.classification import RandomForestClassifier

    from sheaf.operators.forest import importances_of_nodes, node_table
    from sheaf.operators.model import RF_GRID, SEED
    from sheaf.plans.features import model_inputs
    train = model_inputs(tables(spark, sf), FIX).train
    model = RandomForestClassifier(seed=SEED, numTrees=min(RF_GRID["numTrees"])).fit(train)
    return importances_of_nodes(node_table(spark, model))


# Model results have no SQL form; their invariants have. Every test row is checked, and the facts that
# hold for the whole model are on each row.

_CHECKED = ("SELECT business_id, CAST(\"delivery or takeout\" AS DOUBLE) AS label, TRUE AS prediction_is_a_label, "
            "TRUE AS probability_in_range, TRUE AS prediction_follows, CAST({points} AS BIGINT) AS grid_points, "
            "TRUE AS fold_aucs_in_range, CAST(1 AS BIGINT) AS winners, TRUE AS winner_has_top_auc, "
            "TRUE AS refit_uses_winner, TRUE AS accuracy_recomputed{more} FROM feat "
            f"WHERE \"delivery or takeout\" IS NOT NULL AND {BUCKET_SQL} >= 7000")


def _checked(spark, sf, kind: str) -> DataFrame:
    from sheaf.operators.model import best_params, feature_importances, grid_metrics, predictions
    cv, inputs = fitted(spark, sf, kind)
    scored = predictions(cv, inputs.test)
    grid = [r.asDict() for r in grid_metrics(spark, cv).collect()]
    won = [r for r in grid if r["is_best"]]
    best = best_params(cv)
    names = [n for n in grid[0] if n not in ("avg_auc", "std_auc", "is_best")]
    share = scored.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    hard = hard_label_metrics(scored).first()
    facts = {"grid_points": F.lit(len(grid)).cast("long"),
             "fold_aucs_in_range": F.lit(all(0 <= r["avg_auc"] <= 1 for r in grid)),
             "winners": F.lit(len(won)).cast("long"),
             "winner_has_top_auc": F.lit(won[0]["avg_auc"] == max(r["avg_auc"] for r in grid)),
             "refit_uses_winner": F.lit(all(float(best[n]) == won[0][n] for n in names)),
             "accuracy_recomputed": F.lit(abs(share - hard["accuracy"]) < 1e-12)}
    if kind == "rf":
        imp = [r["score"] for r in feature_importances(
            spark, cv.bestModel.stages[-1].featureImportances, inputs.train, top=None).collect()]
        facts |= {"importances_sum_to_one": F.lit(abs(sum(imp) - 1) < 1e-9),
                  "importances_in_order": F.lit(imp == sorted(imp, reverse=True) and min(imp) >= 0)}
        facts |= _forest_facts(spark, cv, inputs)
    p = F.col("probability")
    follows = F.col("prediction") == (p > 0.5).cast("double")
    return scored.select(KEY, "label", F.col("prediction").isin(0.0, 1.0).alias("prediction_is_a_label"),
                         p.between(0, 1).alias("probability_in_range"), (follows | (p == 0.5)).alias("prediction_follows"),
                         *[e.alias(n) for n, e in facts.items()])


@register("lr_checked", O.sql(_CHECKED.format(points=6, more=""), "feat"))
def q_lr_checked(spark, sf):
    return _checked(spark, sf, "lr")


@register("rf_checked", O.sql(_CHECKED.format(
    points=3, more=", TRUE AS importances_sum_to_one, TRUE AS importances_in_order, TRUE AS votes_from_nodes, "
                  "TRUE AS labels_from_nodes, TRUE AS importances_from_nodes"), "feat"))
def q_rf_checked(spark, sf):
    return _checked(spark, sf, "rf")
