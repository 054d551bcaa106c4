"""Cleaning of the raw event log and the churn label.

Each step is ``DataFrame -> DataFrame``; ``clean`` chains them. Filters and the
final projection are pushed into the scan by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.functions import page_flag, user_system
from churnlens.operators.joins import join_small, materialize
from churnlens.schema import CANCEL_PAGE, KEPT_COLUMNS


def with_user_system(df: DataFrame) -> DataFrame:
    """Add ``userSystem`` (system name from the agent) and drop ``userAgent``."""
    return df.withColumn("userSystem", user_system("userAgent")).drop("userAgent")


def drop_anonymous(df: DataFrame) -> DataFrame:
    """Keep rows with a user: ``userId <> ''`` (NULL ids fail the test too)."""
    return df.filter(F.col("userId") != "")


def keep_columns(df: DataFrame) -> DataFrame:
    """Project to the ten analysed columns."""
    return df.select(*KEPT_COLUMNS)


def with_cancel_flag(df: DataFrame) -> DataFrame:
    """``cancel_event`` = 1 on cancellation rows, else 0."""
    return df.withColumn("cancel_event", page_flag(CANCEL_PAGE))


def user_cancellations(df: DataFrame) -> DataFrame:
    """``(userId, churn)`` for users with at least one cancellation.

    The page filter reaches the parquet scan; the count is partially
    aggregated per map task, so a hot user costs one row per task.
    """
    return (df.filter(F.col("page") == CANCEL_PAGE)
            .groupBy("userId").agg(F.count(F.lit(1)).alias("churn")))


def with_churn(df: DataFrame, *, max_rows: int | None = None) -> DataFrame:
    """``churn`` = the user's total number of cancellations, on every row.

    Same values as a sum of the cancel flag over a window partitioned by user,
    but planned as aggregate + join so no task ever holds a whole user: the
    (small) table of cancelling users is broadcast when its size allows, and
    joined with hot-user salting otherwise. Users without a cancellation get 0.
    """
    joined = join_small(df, user_cancellations(df), "userId", "left", max_rows=max_rows)
    return joined.select(*df.columns, F.coalesce(F.col("churn"), F.lit(0).cast("long")).alias("churn"))


#: Users with more cancellations than this take the windowed form of the running label.
MANY_CANCELLATIONS = 1000


def with_churn_phase(df: DataFrame, bucket_ms: int = 60_000, *, max_rows: int | None = None) -> DataFrame:
    """``churn_phase`` = the user's cancellations up to and including this ``ts``.

    The running (ordered) variant of the label. Rows with equal ``ts`` share a
    value (RANGE frame), so the result does not depend on row order; NULL ``ts``
    comes first. Cancellations are rare: their times are gathered per
    cancelling user and joined to the events behind the size check, so the
    events are not shuffled. Users with more than ``MANY_CANCELLATIONS`` go
    through a two-level prefix sum instead.
    """
    cancels = materialize(df.filter(F.col("page") == CANCEL_PAGE).select("userId", "ts"), "cancellations")
    many = materialize(cancels.groupBy("userId").count().filter(F.col("count") > MANY_CANCELLATIONS)
                       .select("userId"), "many-cancellations")
    some = not many.isEmpty()
    if some:
        cancels = join_small(cancels, many, "userId", "left_anti", already_materialized=True)
    times = cancels.groupBy("userId").agg(  # at most MANY_CANCELLATIONS each
        F.count_if(F.col("ts").isNull()).alias("__null"), F.collect_list("ts").alias("__times"))
    upto = F.size(F.filter("__times", lambda t: t <= F.col("ts")))
    phase = F.coalesce(F.col("__null"), F.lit(0)) + F.when(
        F.col("__times").isNull() | F.col("ts").isNull(), 0).otherwise(upto)
    rest = join_small(df, many, "userId", "left_anti", already_materialized=True) if some else df
    out = (join_small(rest, times, "userId", "left", max_rows=max_rows)
           .select(*df.columns, phase.cast("long").alias("churn_phase")))
    if some:
        hot = join_small(df, many, "userId", "left_semi", already_materialized=True)
        out = out.unionByName(_running_cancellations(hot, bucket_ms))
    return out


def _running_cancellations(df: DataFrame, bucket_ms: int) -> DataFrame:
    """Running cancellation count as a two-level prefix sum.

    Per-(user, bucket) counts, a prefix over the user's buckets (bounded by
    the time span / ``bucket_ms``), then a running sum inside each (user,
    bucket). With one-minute buckets a user holding a third of a 60-day log
    is spread over ~86k sort partitions, and the prefix sees at most ~86k rows
    per user.
    """
    x = (df.withColumn("__b", F.floor(F.col("ts") / bucket_ms))
           .withColumn("__f", page_flag(CANCEL_PAGE)))
    per_bucket = x.groupBy("userId", "__b").agg(F.sum("__f").alias("__n"))
    w_user = Window.partitionBy("userId").orderBy("__b")
    prior = per_bucket.select(
        "userId", "__b",
        (F.sum("__n").over(w_user.rowsBetween(Window.unboundedPreceding, Window.currentRow))
         - F.col("__n")).alias("__prior"))
    w_in = Window.partitionBy("userId", "__b").orderBy("ts")
    prior = prior.withColumnsRenamed({"userId": "__u", "__b": "__pb"})
    same = F.col("userId").eqNullSafe(F.col("__u")) & F.col("__b").eqNullSafe(F.col("__pb"))
    return (x.join(prior, same, "inner").drop("__u", "__pb")
             .withColumn("churn_phase", (F.col("__prior") + F.sum("__f").over(w_in)).cast("long"))
             .drop("__b", "__f", "__prior"))


def clean(raw: DataFrame, *, max_rows: int | None = None, stage: bool = False) -> DataFrame:
    """Raw log -> cleaned log: system name, no anonymous rows, ten columns, churn.

    The label needs two reads of the kept rows (the cancelling users, then
    every row). On columnar input the first read is a pushed-down scan of two
    columns. ``stage=True`` (for text input such as JSON) writes the kept rows
    once as parquet to the shared folder so the raw text is parsed only once.
    """
    kept = keep_columns(drop_anonymous(with_user_system(raw)))
    if stage:
        kept = materialize(kept, "kept-log")
    return with_churn(kept, max_rows=max_rows)
