"""Sinks (and their matching readers) for job hand-offs.

Everything is written through Spark's Hadoop filesystem layer, so any shared
filesystem or object store the cluster mounts works; nothing goes through the
driver.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

METRIC_COLUMNS = ["model_path", "recall", "precision", "accuracy", "f1"]


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists",
                  partition_by: list[str] | None = None) -> str:
    """Parquet sink; by default refuses to overwrite an existing path."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_event_log_json(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Write rows as JSON lines (the raw log's format)."""
    df.write.mode(mode).json(path)
    return path


def save_model(model: PipelineModel, path: str) -> str:
    """Persist a fitted pipeline, replacing an older one at ``path``."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def metrics_path(model_path: str) -> str:
    """Where the metrics record of a model lives (next to the model)."""
    return model_path.rstrip("/") + "/evaluation_results.json"


def write_metrics(metrics: DataFrame, model_path: str) -> str:
    """Write a one-row metrics frame as JSON next to the model."""
    path = metrics_path(model_path)
    metrics.coalesce(1).write.mode("overwrite").json(path)
    return path


def write_fold_scores(spark: SparkSession, model_path: str, means: list[float], spreads: list[float]) -> str:
    """Write the cross-validation scores (one row per parameter map) next to the model."""
    path = model_path.rstrip("/") + "/fold_scores.json"
    rows = [(i, float(m), float(s)) for i, (m, s) in enumerate(zip(means, spreads))]
    (spark.createDataFrame(rows, "param_map int, f1_mean double, f1_std double")
     .coalesce(1).write.mode("overwrite").json(path))
    return path


def read_fold_scores(spark: SparkSession, model_path: str) -> DataFrame:
    """What ``write_fold_scores`` wrote: ``param_map, f1_mean, f1_std``."""
    return spark.read.schema("param_map int, f1_mean double, f1_std double").json(
        model_path.rstrip("/") + "/fold_scores.json")


def read_metrics(spark: SparkSession, model_paths: dict[str, str]) -> DataFrame:
    """Read the metrics records of several models, tagged with the algorithm.

    Returns ``Path, Recall, Precision, Accuracy, F1, Algorithm``.
    """
    schema = "model_path string, recall double, precision double, accuracy double, f1 double"
    frames = [
        spark.read.schema(schema).json(metrics_path(p)).withColumn("Algorithm", F.lit(algo))
        for algo, p in model_paths.items()
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.withColumnsRenamed({
        "model_path": "Path", "recall": "Recall", "precision": "Precision",
        "accuracy": "Accuracy", "f1": "F1",
    })
