"""Histograms per group, computed distributed.

Replaces plotting-library histograms: a bin index from arithmetic on each row,
then ``groupBy(group, bin).count()``. With ``bins=n`` the range of each group
is its own [min, max] (a one-value group uses [v - 0.5, v + 0.5]) split into n
equal bins, the last one closed. With explicit edges, values outside
[edges[0], edges[-1]] are dropped and the last bin is closed. ``density``
divides each count by (group count in range * bin width).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.operators.joins import join_null_safe, materialize


def histogram(df: DataFrame, value: str, group: tuple[str, ...] | list[str] = ("churn",),
              bins: int | list[float] = 10, density: bool = False,
              groups: int | None = None) -> DataFrame:
    """``group..., bin, bin_lo, bin_hi, cnt[, density]`` for the non-null values of ``value``.

    A NULL group is a group. ``groups`` bounds the number of groups when the
    caller knows it: their ranges are then broadcast with no written table.
    """
    group = list(group)
    x = (df.select(*group, F.col(value).cast("double").alias("__x"))
           .filter(F.col("__x").isNotNull() & ~F.isnan("__x")))
    if isinstance(bins, int):
        n = bins
        if groups is None:
            x = materialize(x, "histogram-values")  # read twice: range per group, then bins
        rng = x.groupBy(*group).agg(F.min("__x").alias("__a"), F.max("__x").alias("__b"))
        rng = rng.select(
            *group,
            F.when(F.col("__b") > F.col("__a"), F.col("__a")).otherwise(F.col("__a") - 0.5).alias("__lo"),
            F.when(F.col("__b") > F.col("__a"), F.col("__b")).otherwise(F.col("__b") + 0.5).alias("__hi"))
        # one row per group: broadcast on its known bound, else after the size check
        if group:
            x = join_null_safe(x, rng, group, proven_rows=groups)
        else:
            ends = rng.first()
            x = x.withColumns({c: F.lit(ends[c]).cast("double") for c in ("__lo", "__hi")})
        width = (F.col("__hi") - F.col("__lo")) / n
        x = x.withColumn("bin", F.least(F.floor((F.col("__x") - F.col("__lo")) / width),
                                        F.lit(n - 1)).cast("int"))
        h = x.groupBy(*group, "bin", "__lo", "__hi").agg(F.count(F.lit(1)).alias("cnt"))
        width = (F.col("__hi") - F.col("__lo")) / n
        h = h.select(*group, "bin",
                     (F.col("__lo") + F.col("bin") * width).alias("bin_lo"),
                     (F.col("__lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
                     "cnt")
    else:
        edges = [float(e) for e in bins]
        n = len(edges) - 1
        x = x.filter((F.col("__x") >= edges[0]) & (F.col("__x") <= edges[-1]))
        idx = None
        for i in range(n - 1):
            cond = F.col("__x") < edges[i + 1]
            idx = F.when(cond, F.lit(i)) if idx is None else idx.when(cond, F.lit(i))
        idx = F.lit(n - 1) if idx is None else idx.otherwise(F.lit(n - 1))
        h = x.withColumn("bin", idx.cast("int")).groupBy(*group, "bin").agg(
            F.count(F.lit(1)).alias("cnt"))
        lo = F.array(*[F.lit(e) for e in edges[:-1]])
        hi = F.array(*[F.lit(e) for e in edges[1:]])
        h = h.select(*group, "bin", F.element_at(lo, F.col("bin") + 1).alias("bin_lo"),
                     F.element_at(hi, F.col("bin") + 1).alias("bin_hi"), "cnt")
    if density:
        # window over the histogram itself: at most groups x bins rows
        w = Window.partitionBy(*group) if group else Window.partitionBy()
        h = h.withColumn("density", F.col("cnt") / (F.sum("cnt").over(w)
                                                     * (F.col("bin_hi") - F.col("bin_lo"))))
    return h
