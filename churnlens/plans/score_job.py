"""Scoring jobs: a self-contained scorer trained once, then raw log -> scored users."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.operators.joins import materialize
from churnlens.operators.scoring import train_scorer
from churnlens.session import ensure_core_conf, scratch
from churnlens.sources import load_model, read_event_log, read_parquet, save_model, write_parquet


def run_scorer_training(spark: SparkSession, algo: str, train_path: str, model_path: str, *,
                        cross_validate: bool = True) -> str:
    """Train one algorithm with its system encoding and save it behind the stage from the raw log."""
    with scratch(spark):
        return save_model(train_scorer(read_parquet(spark, train_path), algo, cross_validate=cross_validate), model_path)


def scored_users(scored: DataFrame) -> DataFrame:
    """userId, churn (already cancelled in this log), prediction and, where the model gives one,
    the score of class 1: its probability, or the margin of a linear machine."""
    score = next((vector_to_array(c).getItem(1) for c in ("probability", "rawPrediction") if c in scored.columns), F.lit(None))
    return scored.select("userId", "churn", "prediction", score.cast("double").alias("score"))


def run_scoring(spark: SparkSession, log_path: str, model_path: str, output_path: str, *, fmt: str = "json",
                mode: str = "errorifexists") -> str:
    """Score every user of a raw log with a saved scorer. Text input is parsed once."""
    ensure_core_conf(spark)
    with scratch(spark):
        log = read_event_log(spark, log_path, fmt)
        if fmt not in ("parquet", "orc"):
            log = materialize(log, "raw-log")
        return write_parquet(scored_users(load_model(model_path).transform(log)), output_path, mode)
