"""Feature job: cleaned log -> per-user features, split, weighted, written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.operators.features import user_features
from churnlens.operators.joins import materialize
from churnlens.operators.ml import encode_systems
from churnlens.operators.split import split_column, train_validation_split, with_class_weights
from churnlens.session import ensure_core_conf, scratch
from churnlens.sources import read_parquet
from churnlens.sources.table_sets import publish, write_together


def feature_table(cleaned: DataFrame) -> DataFrame:
    """Per-user features with the system index and one-hot vector.

    Materialised once: the encoder fit, the split, the weights and both
    writes read the checkpoint instead of re-aggregating the log.
    """
    features = materialize(user_features(cleaned), "user-features")
    encoded, _ = encode_systems(features)
    return encoded


def weighted_split(features: DataFrame, method: str = "hash") -> tuple[DataFrame, DataFrame]:
    """(train, validation), each with class weights computed inside its part."""
    if method == "hash":
        tagged = features.withColumn("split", split_column())
        weighted = with_class_weights(tagged, by=["split"], groups=2)  # train / validation
        return (weighted.filter(F.col("split") == "train").drop("split"),
                weighted.filter(F.col("split") == "validation").drop("split"))
    train, validation = train_validation_split(features, method=method)
    return with_class_weights(train), with_class_weights(validation)


def run_features(spark: SparkSession, cleaned_path: str, train_path: str,
                 validation_path: str, *, method: str = "hash",
                 mode: str = "errorifexists") -> tuple[str, str]:
    """Write the two weighted tables; neither appears before both are complete."""
    ensure_core_conf(spark)  # month of activity is computed in UTC
    cleaned = read_parquet(spark, cleaned_path)
    with scratch(spark):
        train, validation = weighted_split(feature_table(cleaned), method)
        write_together(spark, {train_path: train, validation_path: validation}, mode)
    return train_path, validation_path


def publish_features(spark: SparkSession, cleaned_path: str, root: str, *, method: str = "hash") -> int:
    """The feature job with its two tables published together below ``root``, as ``train`` and
    ``validation``: a reader sees both of a run or none. The version's number."""
    ensure_core_conf(spark)
    with scratch(spark):
        train, validation = weighted_split(feature_table(read_parquet(spark, cleaned_path)), method)
        return publish(spark, root, {"train": train, "validation": validation})
