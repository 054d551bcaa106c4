"""Train/validation split and balanced class weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.operators.joins import join_null_safe
from churnlens.schema import SPLIT_SEED, VALIDATION_FRACTION

_HEX_DIGITS = 15


def split_column(key: str = "userId", fraction: float = VALIDATION_FRACTION,
                 seed: int = SPLIT_SEED) -> Column:
    """'validation' for about ``fraction`` of the keys, else 'train'.

    Decided by 60 bits of ``md5(seed:key)``: the same user lands in the same
    part on every run, whatever the partitioning, and a recomputed partition
    (lost executor) gives the same rows. A NULL key trains.
    """
    if fraction >= 1:
        return F.lit("validation")
    cut = format(round(fraction * 16 ** _HEX_DIGITS), f"0{_HEX_DIGITS}x")
    prefix = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), 1, _HEX_DIGITS)
    return F.when(prefix < F.lit(cut), F.lit("validation")).otherwise(F.lit("train"))


def train_validation_split(df: DataFrame, method: str = "hash",
                           fraction: float = VALIDATION_FRACTION,
                           seed: int = SPLIT_SEED) -> tuple[DataFrame, DataFrame]:
    """(train, validation).

    ``method='hash'`` (default) uses ``split_column``; ``method='random'`` is
    ``randomSplit([1 - fraction, fraction], seed)``, which depends on the
    input's partitioning and row order.
    """
    if method == "random":
        train, validation = df.randomSplit([1.0 - fraction, fraction], seed=seed)
        return train, validation
    tagged = df.withColumn("__split", split_column(fraction=fraction, seed=seed))
    return (tagged.filter(F.col("__split") == "train").drop("__split"),
            tagged.filter(F.col("__split") == "validation").drop("__split"))


def with_class_weights(df: DataFrame, label: str = "churn", by: list[str] | None = None,
                       name: str = "weightCol", groups: int | None = None) -> DataFrame:
    """``weightCol`` = 0.5 / (rows of the row's class): each class sums to 0.5.

    Class 0 is ``label = 0``, every other label value is the positive class.
    Computed per ``by`` group (e.g. per split; NULL is a group) when given. The class counts
    (one row per group and class) are joined back broadcast; an absent class
    never divides by zero because none of its rows exist. The count table has
    at most 2 rows per group: without ``by``, or with ``groups`` (the number of
    ``by`` values, when the caller knows it), that bound is proven and the
    broadcast needs no size check.
    """
    by = list(by or [])
    cls = F.when(F.col(label) == 0, 0).otherwise(1)
    tagged = df.withColumn("__cls", cls)
    counts = tagged.groupBy(*by, "__cls").agg(F.count(F.lit(1)).alias("__n"))
    bound = 2 if not by else (2 * groups if groups else None)
    out = join_null_safe(tagged, counts, by + ["__cls"], proven_rows=bound)
    return out.withColumn(name, F.lit(0.5) / F.col("__n")).select(*df.columns, name)
