"""Classification metrics.

Hard-label metrics come from the four confusion counts of one aggregation, as closed forms of the
curves Spark's binary metrics draw through a single threshold:

    AUC-ROC = (1 + TPR - FPR) / 2
    AUC-PR  = R * P + (1 - R) * (P + prevalence) / 2      (P = prevalence when nothing is predicted 1)
"""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.operators.columns import q


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    y, p = q(label).cast("double") > 0.5, q(prediction).cast("double") > 0.5
    return df.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
                  F.count_if(~y & ~p).alias("tn"), F.count_if(y & ~p).alias("fn"))


def hard_label_metrics(df: DataFrame, label: str = "label",
                       prediction: str = "prediction") -> DataFrame:
    """AUC-ROC, AUC-PR and accuracy of 0/1 predictions, one row."""
    c = confusion(df, label, prediction)
    tp, fp, tn, fn = (F.col(x).cast("double") for x in ("tp", "fp", "tn", "fn"))
    pos, neg = tp + fn, fp + tn
    n = pos + neg
    tpr, fpr = F.try_divide(tp, pos), F.try_divide(fp, neg)
    prevalence = F.try_divide(pos, n)
    precision = F.coalesce(F.try_divide(tp, tp + fp), prevalence)
    return c.select(
        ((F.lit(1.0) + tpr - fpr) / 2).alias("auc_roc"),
        (tpr * precision + (F.lit(1.0) - tpr) * (precision + prevalence) / 2).alias("auc_pr"),
        F.try_divide(tp + tn, n).alias("accuracy"))


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of rows where the prediction equals the label (L9), one row."""
    hit = (q(label).cast("double") == q(prediction).cast("double")).cast("double")
    return df.agg(F.avg(hit).alias("accuracy"))


def auc_roc(df: DataFrame, label: str = "label", score: str = "rawPrediction") -> float:
    """Exact area under the ROC curve of a score column or raw-prediction vector.

    ``numBins=0`` turns off curve down-sampling. Spark sorts the scores in a distributed sort and
    accumulates the counts per partition, so nothing is gathered in one task; tied scores form one
    curve step (the mid-rank formula).
    """
    col = df.schema[score].dataType.simpleString()
    data = df if col == "vector" else df.withColumn(score, q(score).cast("double"))
    ev = BinaryClassificationEvaluator(rawPredictionCol=score, labelCol=label,
                                       metricName="areaUnderROC", numBins=0)
    return float(ev.evaluate(data.withColumn(label, q(label).cast("double"))))
