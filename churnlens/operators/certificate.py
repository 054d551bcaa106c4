"""Optimality of a fitted linear classifier, checked in one distributed pass.

Both losses are convex in (weights, intercept), so a point is optimal when 0 is a subgradient
there. The pass needs the assembled, scaled features, the label and the weight of every row, and the
coefficients; it adds up one vector per side of the loss (a weighted sum of feature vectors, in the
JVM) and returns one row.

* Logistic regression: the gradient of the weighted mean log loss.
* Linear SVM: rows within ``EDGE`` of the hinge's corner may count with any share between 0 and 1,
  so each coordinate's subgradient is an interval; its distance from 0 is a lower bound for
  the norm of every subgradient.

``residual`` is the largest entry, taken in the space of features divided by their deviation, where
the solvers work (and relative to the same figure at zero weights): scale does not flatter it.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows whose margin is this close to 1 are at the corner of the hinge loss.
EDGE = 1e-2


def margin(features: Column, coefficients: Sequence[float], intercept: float) -> Column:
    w = F.array(*[F.lit(float(c)) for c in coefficients])
    return F.aggregate(F.zip_with(vector_to_array(features), w, lambda x, c: x * c), F.lit(float(intercept)), lambda a, x: a + x)


def _pulls(rows: DataFrame, pull: Column, side: Column) -> tuple[dict[str, tuple[np.ndarray, float]], np.ndarray, float]:
    """Per side the sums of pull x features and of pull (both with the rows' weight), the features'
    deviations and the total weight: two aggregates of at most three rows."""
    x = rows.withColumn("__pull", pull).withColumn("__side", side)
    got = x.filter(F.col("__pull") > 0).groupBy("__side").agg(
        Summarizer.sum(F.col("f"), F.col("__pull")).alias("s"), F.sum("__pull").alias("n")).collect()
    std, total = x.agg(Summarizer.std(F.col("f"), F.col("w")), F.sum("w")).first()
    return {r["__side"]: (r["s"].toArray(), r["n"]) for r in got}, std.toArray(), total


def _size(low: np.ndarray, high: np.ndarray, std: np.ndarray) -> float:
    """Largest distance of 0 from the intervals, coordinates (the last is the intercept) per deviation."""
    off = np.maximum(np.maximum(low, -high), 0)
    scale = np.append(np.where(std > 0, 1 / np.where(std > 0, std, 1), 0), 1)
    return float((off * scale).max())


def certificate(rows: DataFrame, kind: str, coefficients: Sequence[float], intercept: float, *, features: str = "features_scaled",
                label: str = "churn", weight: str = "weightCol", edge: float = EDGE) -> dict[str, float]:
    """``objective`` (weighted mean loss), ``residual`` and ``rows`` of kind 'lr' or 'svm' at a point.

    No regularisation: the classifiers here have none."""
    if kind not in ("lr", "svm"):
        raise ValueError(f"no certificate for {kind!r}")
    x = rows.select(F.col(features).alias("f"), F.col(label).cast("double").alias("y"), F.col(weight).cast("double").alias("w"))
    here = _one(x, kind, coefficients, intercept, edge)
    start = _one(x, kind, [0.0] * len(coefficients), 0.0, edge)
    return {"objective": here[0], "residual": here[1] / start[1] if start[1] else here[1], "rows": here[2]}


def _one(x: DataFrame, kind: str, coefficients: Sequence[float], intercept: float, edge: float) -> tuple[float, float, int]:
    m = margin(F.col("f"), coefficients, intercept)
    sign = F.when(F.col("y") > 0, 1.0).otherwise(-1.0)
    z = x.withColumn("__z", sign * m)  # the margin towards the row's own class
    if kind == "lr":
        loss = F.when(F.col("__z") > 0, F.log1p(F.exp(-F.col("__z")))).otherwise(F.log1p(F.exp(F.col("__z"))) - F.col("__z"))
        pull, free = F.col("w") / (1 + F.exp(F.col("__z"))), F.lit(False)
    else:
        loss = F.greatest(F.lit(0.0), 1 - F.col("__z"))
        pull = F.when(F.col("__z") <= 1 + edge, F.col("w")).otherwise(0.0)
        free = F.abs(F.col("__z") - 1) <= edge
    side = F.concat(F.when(F.col("y") > 0, F.lit("+")).otherwise(F.lit("-")), F.when(free, F.lit("free")).otherwise(F.lit("")))
    sums, std, total = _pulls(z, pull, side)
    low = np.zeros(len(std) + 1)
    high = low.copy()
    for name, (s, n) in sums.items():  # a row pulls the gradient to -y x
        g = np.append(s, n) / total * (-1 if name[0] == "+" else 1)
        if name.endswith("free"):
            # each free row adds any share of its pull; features are not signed alike, so the parts
            # are bounded by the sums of their positive and negative entries
            pos, neg = _signed(z, name, pull, side, total)
            low, high = low - (pos if name[0] == "+" else neg), high + (neg if name[0] == "+" else pos)
        else:
            low, high = low + g, high + g
    objective, n = z.agg(F.sum(F.col("w") * loss) / F.sum("w"), F.count(F.lit(1))).first()
    return float(objective), _size(low, high, std), int(n)


def _signed(z: DataFrame, name: str, pull: Column, side: Column, total: float) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the positive and of the negative entries (as positive numbers) of a side's rows."""
    rows = z.withColumn("__pull", pull).filter(side == name).filter("__pull > 0").select("__pull", F.posexplode(vector_to_array("f")).alias("i", "v"))
    part = rows.groupBy("i").agg(F.sum(F.greatest("v", F.lit(0.0)) * F.col("__pull")).alias("p"),
                                 F.sum(F.greatest(-F.col("v"), F.lit(0.0)) * F.col("__pull")).alias("n")).orderBy("i").collect()
    weight = z.withColumn("__pull", pull).filter(side == name).agg(F.sum("__pull")).first()[0] or 0.0
    pos = np.append([r["p"] for r in part], weight) / total
    neg = np.append([r["n"] for r in part], 0.0) / total
    return pos, neg
