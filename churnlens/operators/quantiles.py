"""Quartiles per group from mergeable sketches.

A KLL sketch holds a column's distribution in a few kilobytes, however many rows: sketches of
parts (days, partitions, jobs) are stored as binary columns and merged later, so a profile of new
data never reads old data again. Quantiles carry an error in rank: with the default size a
quantile's rank is off by more than ``RANK_ERROR`` in about one of a hundred.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of the sketches and twice the two-sided rank error (99 %) that belongs to it.
SKETCH_SIZE = 400
RANK_ERROR = 0.02
QUARTILES = (0.25, 0.5, 0.75)


def sketch(column: str, size: int = SKETCH_SIZE) -> Column:
    """Aggregate: the sketch of a column; NULL and NaN are left out."""
    value = F.nanvl(F.col(f"`{column}`").cast("double"), F.lit(None).cast("double"))
    return F.kll_sketch_agg_double(value, F.lit(size))


def quantile_columns(of: Column, ranks: Sequence[float] = QUARTILES) -> list[Column]:
    """``q25``, ``q50`` ... of a sketch (NULL without values)."""
    return [F.when(F.kll_sketch_get_n_double(of) > 0, F.kll_sketch_get_quantile_double(of, F.lit(float(r)))).alias(f"q{round(r * 100)}")
            for r in ranks]


def quantile_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), size: int = SKETCH_SIZE) -> DataFrame:
    """One row per group and column: the columns ``by``, ``column``, ``sketch`` (binary). NULL and NaN
    values are left out; one pass, merged before the shuffle."""
    wide = df.groupBy(*by).agg(*[sketch(c, size).alias(f"__{i}") for i, c in enumerate(columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"__{i}").alias("sketch")) for i, c in enumerate(columns)])
    return wide.select(*by, F.inline(rows)).filter("sketch IS NOT NULL")


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of the union, per group ``by`` and column."""
    return sketches.groupBy(*by, "column").agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def quantiles(sketches: DataFrame, ranks: Sequence[float] = QUARTILES) -> DataFrame:
    """The sketches' groups with ``n`` and one column ``q25``, ``q50`` ... per rank (NULL without values)."""
    keys = [c for c in sketches.columns if c != "sketch"]
    return sketches.select(*keys, F.kll_sketch_get_n_double("sketch").alias("n"), *quantile_columns(F.col("sketch"), ranks))


def rank_errors(df: DataFrame, found: DataFrame, column: str, by: Sequence[str] = (),
                ranks: Sequence[float] = QUARTILES) -> DataFrame:
    """How far each quantile's place among the values is from its rank, in shares of the rows:
    the group, ``n`` and ``e25`` ... . One pass over the values, beside the (small) quantiles."""
    from churnlens.operators.joins import join_null_safe

    names = [f"q{round(r * 100)}" for r in ranks]
    value = F.col(f"`{column}`").cast("double")
    mine = found.filter(F.col("column") == column).select(*by, *names)
    good = df.filter(value.isNotNull() & ~F.isnan(value)).select(*by, value.alias("__v"))
    if by:
        x = join_null_safe(good, mine, list(by))
    else:  # a single row of quantiles
        only = mine.first() or {q: None for q in names}
        x = good.withColumns({q: F.lit(only[q]).cast("double") for q in names})
    counts = x.groupBy(*by).agg(F.count(F.lit(1)).alias("n"),
                                *[F.sum((F.col("__v") < F.col(q)).cast("long")).alias(f"lt_{q}") for q in names],
                                *[F.sum((F.col("__v") <= F.col(q)).cast("long")).alias(f"le_{q}") for q in names])

    def off(r, q):
        low, high = F.col(f"lt_{q}") / F.col("n"), F.col(f"le_{q}") / F.col("n")
        return F.greatest(F.lit(0.0), low - r, r - high).alias(f"e{q[1:]}")
    return counts.select(*by, "n", *[off(r, q) for r, q in zip(ranks, names)])
