"""Evaluation job: model + validation table -> metrics record (JSON)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.operators.metrics import weighted_metrics
from churnlens.sources import load_model, read_parquet, write_metrics


def evaluate(model: PipelineModel, validation: DataFrame, model_path: str | None = None,
             label: str = "churn") -> DataFrame:
    """One row: ``model_path, recall, precision, accuracy, f1`` (class-weighted)."""
    scored = model.transform(validation)
    m = weighted_metrics(scored, label=label)
    return m.select(F.lit(model_path).cast("string").alias("model_path"), *m.columns)


def run_evaluation(spark: SparkSession, validation_path: str, model_path: str) -> DataFrame:
    """Score the validation table with a saved model and write the record next to it."""
    metrics = evaluate(load_model(model_path), read_parquet(spark, validation_path), model_path)
    path = write_metrics(metrics, model_path)
    return spark.read.schema(metrics.schema).json(path)  # the record, not a second scoring
