"""Weighted classification metrics in one pass.

``weighted_metrics`` gives the same four figures as MLlib's multiclass
evaluator with a weight column (weighted recall, weighted precision,
accuracy, weighted F1) from one weighted confusion table instead of four
passes over the predictions. Classes are the label values present.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion(pred: DataFrame, label: str = "churn", prediction: str = "prediction",
              weight: str | None = "weightCol") -> DataFrame:
    """``label, prediction, w``: summed weight per cell (at most classes^2 rows)."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    return pred.groupBy(F.col(label).cast("double").alias("label"),
                        F.col(prediction).cast("double").alias("prediction")).agg(
        F.sum(w).alias("w"))


def weighted_metrics(pred: DataFrame, label: str = "churn", prediction: str = "prediction",
                     weight: str | None = "weightCol") -> DataFrame:
    """One row: ``recall, precision, accuracy, f1`` (all class-weighted)."""
    cm = confusion(pred, label, prediction, weight)
    # each cell counts towards its label's row total and its prediction's column total
    cells = cm.select(F.inline(F.array(
        F.struct(F.col("label").alias("c"), F.col("w").alias("lw"),
                 F.when(F.col("label") == F.col("prediction"), F.col("w")).otherwise(0.0).alias("tp"),
                 F.lit(0.0).alias("pw"), F.lit(1).alias("is_label")),
        F.struct(F.col("prediction").alias("c"), F.lit(0.0).alias("lw"), F.lit(0.0).alias("tp"),
                 F.col("w").alias("pw"), F.lit(0).alias("is_label")))))
    per_class = (cells.groupBy("c").agg(F.sum("lw").alias("lw"), F.sum("tp").alias("tp"),
                                        F.sum("pw").alias("pw"), F.max("is_label").alias("is_label"))
                 .filter(F.col("is_label") == 1))
    rec = F.when(F.col("lw") == 0, 0.0).otherwise(F.col("tp") / F.col("lw"))
    prec = F.when(F.col("pw") == 0, 0.0).otherwise(F.col("tp") / F.col("pw"))
    per_class = per_class.select("lw", "tp", rec.alias("r"), prec.alias("p"))
    f1 = F.when(F.col("p") + F.col("r") == 0, 0.0).otherwise(
        2 * F.col("p") * F.col("r") / (F.col("p") + F.col("r")))
    total = F.sum("lw")
    return per_class.agg(
        (F.sum(F.col("r") * F.col("lw")) / total).alias("recall"),
        (F.sum(F.col("p") * F.col("lw")) / total).alias("precision"),
        (F.sum("tp") / total).alias("accuracy"),
        (F.sum(f1 * F.col("lw")) / total).alias("f1"))


def evaluator_metrics(pred: DataFrame, label: str = "churn", weight: str = "weightCol") -> dict:
    """The four figures from MLlib's evaluator (four passes), for cross-checks."""
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction",
                                           weightCol=weight)
    names = {"recall": "weightedRecall", "precision": "weightedPrecision",
             "accuracy": "accuracy", "f1": "f1"}
    return {k: ev.evaluate(pred, {ev.metricName: m}) for k, m in names.items()}
