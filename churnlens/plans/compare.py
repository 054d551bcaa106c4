"""Model comparison: metrics records of several models -> one long table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnlens.sources import read_metrics


def compare_models(spark: SparkSession, model_paths: dict[str, str]) -> DataFrame:
    """``Algorithm, Metric, Score`` for every model and metric."""
    wide = read_metrics(spark, model_paths).drop("Path")
    return wide.unpivot(["Algorithm"], ["Recall", "Precision", "Accuracy", "F1"],
                        "Metric", "Score")
