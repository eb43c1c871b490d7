"""The whole workload from the six JSON-lines files: features, both searches, scores, metrics.

    from sheaf.plans.workload import tables_from_json, run
    t = tables_from_json(spark, {"business": ".../business.json", "review": ..., "checkin": ...,
                                 "tip": ..., "covid": ...})
    out = run(t, Params())          # DataFrames, and each model's AUC as a number
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from sheaf.plans.features import Params, Tables, base_table, inputs_of
from sheaf.session import materialize
from sheaf.sources.json import read_table


def tables_from_json(spark: SparkSession, paths: Mapping[str, str]) -> Tables:
    """The five tables the plan joins, read with their declared schemas (business records with flat
    dotted fields or with nested objects). The user table is read by ``read_table`` and prepared by
    ``plans.features.user_features``; the plan does not join it.
    """
    return Tables(*[read_table(spark, name, paths[name])
                    for name in ("business", "review", "checkin", "tip", "covid")])


def run(t: Tables, p: Params = Params(), folds: int = 10, parallelism: int = 4) -> dict:
    """Base table, model inputs, cross-validated LR and RF, test scores, metrics, importances."""
    from sheaf.operators.metrics import auc_roc, hard_label_metrics
    from sheaf.operators.model import (feature_importances, forest_cv, grid_metrics,
                                       logistic_cv, predictions)
    spark = t.business.sparkSession
    table = materialize(base_table(t, p), "base-table")
    inputs = inputs_of(table)
    out: dict[str, DataFrame | float] = {"base_table": table}
    for name, fit in (("lr", logistic_cv), ("rf", forest_cv)):
        cv = fit(inputs.train, folds=folds, parallelism=parallelism)
        scored = cv.transform(inputs.test)
        out[f"{name}_grid"] = grid_metrics(spark, cv)
        out[f"{name}_predictions"] = predictions(cv, inputs.test)
        out[f"{name}_hard_label_metrics"] = hard_label_metrics(scored)
        out[f"{name}_auc_roc"] = auc_roc(scored, "label", "rawPrediction")
        if name == "rf":
            out["rf_importances"] = feature_importances(
                spark, cv.bestModel.stages[-1].featureImportances, inputs.train)
    return out
