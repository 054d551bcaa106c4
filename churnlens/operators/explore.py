"""Group comparisons between loyal and cancelled users, and data profiles.

All functions take the cleaned log (``churn`` on every row). Because ``churn``
is constant per user, "events of loyal users" is simply ``churn = 0``: the
share queries filter instead of joining with a user list. ``rows_of_users``
(in ``joins``) is the general semi-join for arbitrary user lists.

Windows here only run over already aggregated tables whose size is bounded
by the number of buckets, systems or churn values, never over events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.functions import page_flag, to_day, to_days, to_hour, to_minutes, to_month
from churnlens.operators.features import page_clicks
from churnlens.operators.quantiles import quantile_columns, sketch
from churnlens.schema import CANCEL_PAGE, DOWNGRADE_PAGE, SONG_PAGE, UPGRADE_PAGE

BY_CHURN_USER = ("churn", "userId")


# --- Profiles --------------------------------------------------------------------

def first_rows(df: DataFrame, n: int = 10, order: list[str] | None = None) -> DataFrame:
    """``n`` rows for a look at the data: any ``n`` rows, or the first ``n`` by ``order``.

    With an order Spark plans a distributed top-k (each task keeps its best
    ``n``), not a global sort.
    """
    return df.orderBy(*order).limit(n) if order else df.limit(n)


def unique_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column."""
    return df.select(column).distinct()


def null_profile(df: DataFrame) -> DataFrame:
    """One row: per column, the number of NULL values (plus NaN for floats)."""
    exprs = []
    for f in df.schema.fields:
        missing = F.col(f.name).isNull()
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            missing = missing | F.isnan(f.name)
        exprs.append(F.count_if(missing).alias(f.name))
    return df.agg(*exprs)


def describe_strings(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The string columns' part of ``describe``: count, min and max, one row per column."""
    cols = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    wide = df.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(cols)
                    for n, f in (("n", F.count), ("min", F.min), ("max", F.max))])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("count"),
                 F.col(f"min{i}").alias("min"), F.col(f"max{i}").alias("max")) for i, c in enumerate(cols)])))


def describe_numeric(df: DataFrame, columns: list[str] | None = None, *, quartiles: bool = False) -> DataFrame:
    """Typed ``describe``: one row per numeric column with count, mean, stddev, min, max
    and, if asked for, q25, q50 and q75 (see ``operators.quantiles`` for their rank error).

    One aggregate pass (partial per task), then the one-row result is turned
    into rows. ``DataFrame.describe`` gives the same figures as strings.
    """
    numeric = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
    cols = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, numeric)]
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(c).alias(f"n{i}"), F.avg(c).alias(f"mean{i}"),
                 F.stddev_samp(c).alias(f"sd{i}"),
                 F.min(c).cast("double").alias(f"min{i}"), F.max(c).cast("double").alias(f"max{i}")]
        if quartiles:
            aggs.append(sketch(c).alias(f"sketch{i}"))
    wide = df.agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("count"),
                 F.col(f"mean{i}").alias("mean"), F.col(f"sd{i}").alias("stddev"),
                 F.col(f"min{i}").alias("min"), F.col(f"max{i}").alias("max"),
                 *(quantile_columns(F.col(f"sketch{i}")) if quartiles else ()))
        for i, c in enumerate(cols)])
    return wide.select(F.inline(rows))


# --- User groups -----------------------------------------------------------------

def cancelled_users(cleaned: DataFrame) -> DataFrame:
    return (cleaned.groupBy("userId").agg(F.max("churn").alias("m"))
            .filter(F.col("m") > 0).select("userId"))


def loyal_users(cleaned: DataFrame) -> DataFrame:
    return (cleaned.groupBy("userId").agg(F.max("churn").alias("m"))
            .filter(F.col("m") == 0).select("userId"))


def loyal() -> Column:
    """Rows of users who never cancelled."""
    return F.col("churn") == 0


def cancelled() -> Column:
    """Rows of users who cancelled at least once."""
    return F.col("churn") > 0


def gender_by_churn(cleaned: DataFrame) -> DataFrame:
    """Users (not events) per (churn, gender); a NULL gender counts 0."""
    return (cleaned.select("churn", "userId", "gender").distinct()
            .groupBy("churn", "gender").agg(F.count("gender").alias("cnt")))


def system_counts(cleaned: DataFrame | None = None, sessions: DataFrame | None = None) -> DataFrame:
    """Users per (churn, preferred system), the system being the user's greatest name."""
    per_user = _sessions(cleaned, sessions).groupBy(*BY_CHURN_USER).agg(
        F.max("system").alias("pref_user_system"))
    return per_user.groupBy("churn", "pref_user_system").agg(F.count(F.lit(1)).alias("cnt"))


def system_share(cleaned: DataFrame | None = None, sessions: DataFrame | None = None) -> DataFrame:
    """Share of users per preferred system within each churn group."""
    counts = system_counts(cleaned, sessions)
    w = Window.partitionBy("churn")
    return counts.select("churn", "pref_user_system",
                         (F.col("cnt") / F.sum("cnt").over(w)).alias("percentage"))


def with_time_parts(cleaned: DataFrame) -> DataFrame:
    """Add ``hour``, ``month`` and ``weekday`` (Monday = 0) of ``ts``."""
    return cleaned.withColumns({"hour": to_hour("ts"), "month": to_month("ts"),
                                "weekday": to_day("ts")})


def bucket_share(cleaned: DataFrame, bucket: str, group: Column | DataFrame | None = None) -> DataFrame:
    """Share of a group's events per time bucket (``hour`` or ``weekday``), largest first.

    ``group`` is a row predicate (e.g. ``loyal()``) or a user-id frame. The
    denominator (all of the group's events) comes out of the same aggregate,
    so the log is read once; the window runs over at most one row per bucket.
    """
    parts = {"hour": to_hour, "weekday": to_day, "month": to_month}
    df = cleaned
    if isinstance(group, DataFrame):
        from churnlens.operators.joins import rows_of_users
        df = rows_of_users(df, group)
    elif group is not None:
        df = df.filter(group)
    df = df.withColumn(bucket, parts[bucket]("ts")) if bucket in parts else df
    g = df.groupBy(bucket).agg(F.count(bucket).alias("__n"), F.count(F.lit(1)).alias("__all"))
    total = F.sum("__all").over(Window.partitionBy())
    return (g.select(bucket, (F.col("__n") / total).alias("count"))
            .orderBy(F.desc("count")))


def time_bucket_counts(cleaned: DataFrame) -> DataFrame:
    """Events per (group, hour, weekday), group 'loyal' / 'cancelled'.

    One pass over the log serves all four time-share tables
    (``share_from_counts``); the result has at most 2 x 25 x 8 rows.
    """
    group = F.when(cancelled(), F.lit("cancelled")).otherwise(F.lit("loyal"))
    return cleaned.groupBy(group.alias("group"), to_hour("ts").alias("hour"),
                           to_day("ts").alias("weekday")).agg(F.count(F.lit(1)).alias("n"))


def share_from_counts(counts: DataFrame, bucket: str, group: str) -> DataFrame:
    """``bucket_share`` of one group, from ``time_bucket_counts``."""
    g = (counts.filter(F.col("group") == group).groupBy(bucket)
         .agg(F.coalesce(F.sum(F.when(F.col(bucket).isNotNull(), F.col("n"))), F.lit(0).cast("long"))
              .alias("__n"), F.sum("n").alias("__all")))
    total = F.sum("__all").over(Window.partitionBy())
    return (g.select(bucket, (F.col("__n") / total).alias("count"))
            .orderBy(F.desc("count")))


def cancel_level(cleaned: DataFrame) -> DataFrame:
    """Plan level at the cancellation event, per churn group."""
    return (cleaned.filter(F.col("page") == CANCEL_PAGE)
            .groupBy("churn", "level").agg(F.count("level").alias("cnt")))


# --- Per-user and per-session distributions ---------------------------------------
#
# These read a (churn, user, session) summary instead of the log. Called with
# the cleaned log alone they build it on the fly (one aggregate, partially
# combined per task); an analysis running several of them passes
# ``sessions=summarize(cleaned)`` — the summary written once to the shared
# folder — and every comparison then reads a table orders of magnitude
# smaller than the log.

def session_summary(cleaned: DataFrame) -> DataFrame:
    """One row per (churn, user, session) with what the comparisons need."""
    return cleaned.groupBy("churn", "userId", "sessionId").agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
        F.sum(page_flag(UPGRADE_PAGE)).alias("n_upgrades"),
        F.sum(page_flag(DOWNGRADE_PAGE)).alias("n_downgrades"),
        F.max("userSystem").alias("system"),
        F.sum("length").alias("len_sum"), F.count("length").alias("len_n"),
        F.sum("itemInSession").alias("item_sum"), F.count("itemInSession").alias("item_n"),
        F.collect_set("gender").alias("genders"), F.count_if(F.col("gender").isNull()).alias("no_gender"))


def mean_from_sums(sessions: DataFrame, total: str, n: str, name: str) -> DataFrame:
    """A per-(churn, user) mean from the sessions' sums and counts (NULL without values)."""
    return sessions.groupBy(*BY_CHURN_USER).agg((F.sum(total) / F.nullif(F.sum(n), F.lit(0))).alias(name))


def sess_p_day_from_summary(sessions: DataFrame) -> DataFrame:
    """Sessions per day of activity per (churn, user)."""
    days = to_days(F.max("last_ts") - F.min("first_ts")) + 1
    return sessions.groupBy(*BY_CHURN_USER).agg((F.count("sessionId") / days).alias("avg_sess_p_day"))


def gender_from_summary(sessions: DataFrame) -> DataFrame:
    """Distinct users per (churn, gender)."""
    each = F.when(F.col("no_gender") > 0, F.array_append("genders", F.lit(None))).otherwise(F.col("genders"))
    return (sessions.select(*BY_CHURN_USER, F.explode(each).alias("gender")).distinct()
            .groupBy("churn", "gender").agg(F.count("gender").alias("cnt")))


def summarize(cleaned: DataFrame) -> DataFrame:
    """``session_summary`` written to the shared folder, for reuse."""
    from churnlens.operators.joins import materialize
    return materialize(session_summary(cleaned), "session-summary")


def _sessions(cleaned: DataFrame | None, sessions: DataFrame | None) -> DataFrame:
    return sessions if sessions is not None else session_summary(cleaned)


def lifetimes(cleaned: DataFrame | None = None, sessions: DataFrame | None = None) -> DataFrame:
    """Days between first and last event per (churn, user)."""
    return _sessions(cleaned, sessions).groupBy(*BY_CHURN_USER).agg(
        to_days(F.max("last_ts") - F.min("first_ts")).alias("lifetime"))


def lifetime_stats(cleaned: DataFrame | None = None, sessions: DataFrame | None = None) -> DataFrame:
    return lifetimes(cleaned, sessions).groupBy("churn").agg(
        F.avg("lifetime").alias("avg"), F.min("lifetime").alias("min"),
        F.max("lifetime").alias("max"))


def session_durations(cleaned: DataFrame | None = None, ordered: bool = True,
                      sessions: DataFrame | None = None) -> DataFrame:
    """Minutes per (churn, user, session), sorted by user and session start."""
    s = _sessions(cleaned, sessions).select(
        "churn", "userId", "sessionId",
        to_minutes(F.col("last_ts") - F.col("first_ts")).alias("session_duration"), "first_ts")
    if ordered:
        s = s.orderBy(F.asc("userId"), F.asc("first_ts"))
    return s.select("churn", "userId", "sessionId", "session_duration")


def session_stats(cleaned: DataFrame | None = None, sessions: DataFrame | None = None) -> DataFrame:
    """Mean, min and max session minutes per (churn, user)."""
    return session_durations(cleaned, ordered=False, sessions=sessions).groupBy(*BY_CHURN_USER).agg(
        F.avg("session_duration").alias("avg"), F.min("session_duration").alias("min"),
        F.max("session_duration").alias("max"))


def up_down_grades(cleaned: DataFrame | None = None, sessions: DataFrame | None = None) -> DataFrame:
    """Submitted upgrades and downgrades per (churn, user).

    The per-user totals of the two flags; an aggregate rather than a window
    over all of a user's rows.
    """
    return _sessions(cleaned, sessions).groupBy(*BY_CHURN_USER).agg(
        F.sum("n_upgrades").alias("num_upgrades"), F.sum("n_downgrades").alias("num_downgrades"))


def melt(df: DataFrame, ids: list[str], value_type: str = "double") -> DataFrame:
    """Wide -> long: ``ids..., variable, value`` over all other columns."""
    values = [c for c in df.columns if c not in ids]
    typed = df.select(*ids, *[F.col(c).cast(value_type).alias(c) for c in values])
    return typed.unpivot(ids, values, "variable", "value")


def page_clicks_by_churn(cleaned: DataFrame) -> DataFrame:
    """Mean monthly clicks per (churn, user, page) without song plays."""
    return page_clicks(cleaned, BY_CHURN_USER, exclude=(SONG_PAGE,))


def page_click_means(cleaned: DataFrame) -> DataFrame:
    """Group mean of the per-user monthly clicks, per (page, churn)."""
    return (page_clicks_by_churn(cleaned).groupBy("page", "churn")
            .agg(F.avg("avg_mhly_cnt").alias("mean_clicks")))
