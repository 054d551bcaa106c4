"""Per-user features of the cleaned log.

The single-feature functions (``avg_sess_p_day`` ... ``page_pivot``) are the
building blocks; each takes ``by`` grouping columns so the exploration can run
them per ``(churn, userId)``. ``user_features`` is the combined job: instead of
one aggregate and one join per feature it runs

1. one aggregate of the log at (user, session, page) grain — the only pass
   over the events; partial aggregation runs before its shuffle, so a hot user
   or session costs one row per map task and page;
2. a session roll-up and a user roll-up of that table for the scalar features;
3. month and user roll-ups plus the page pivot for the click features;
4. one join of the two per-user tables (co-partitioned on ``userId``).

The (user, session, page) table is written to the shared folder because
both branches read it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.functions import gender_flag, to_days, to_minutes, to_month
from churnlens.operators.joins import materialize
from churnlens.schema import FEATURE_PAGES, UNKNOWN_SYSTEM

BY_USER = ("userId",)


# --- Feature formulas over aggregated columns ----------------------------------

def sessions_per_day(n_sessions: Column, first_ts: Column, last_ts: Column) -> Column:
    """Distinct sessions divided by the days spanned (+1), as double."""
    return n_sessions / (to_days(last_ts - first_ts) + 1)


def ml_label(churn: Column) -> Column:
    """Binary label: 1 when the user cancelled at least once."""
    return F.when(churn > 0, 1).otherwise(0).cast("long")


def usable_system(system: Column) -> Column:
    """System name for the encoder: NULL and '' (no parentheses) become 'unknown'."""
    return F.coalesce(F.nullif(system, F.lit("")), F.lit(UNKNOWN_SYSTEM))


# --- Single features -------------------------------------------------------------

def user_label(cleaned: DataFrame, by=BY_USER) -> DataFrame:
    """``churn`` = the user's number of cancellations (0 = loyal)."""
    return cleaned.groupBy(*by).agg(F.max("churn").alias("churn"))


def avg_sess_p_day(cleaned: DataFrame, by=BY_USER) -> DataFrame:
    return cleaned.groupBy(*by).agg(
        sessions_per_day(F.count_distinct("sessionId"), F.min("ts"), F.max("ts"))
        .alias("avg_sess_p_day"))


def avg_length(cleaned: DataFrame, by=BY_USER, name: str = "avg_length") -> DataFrame:
    """Mean song length; NULL for users without songs."""
    return cleaned.groupBy(*by).agg(F.avg("length").alias(name))


def avg_items_p_sess(cleaned: DataFrame, by=BY_USER, name: str = "avg_items_p_sess") -> DataFrame:
    """Mean ``itemInSession`` over all of the user's events."""
    return cleaned.groupBy(*by).agg(F.avg("itemInSession").alias(name))


def acc_age(cleaned: DataFrame, by=BY_USER, name: str = "acc_age") -> DataFrame:
    """Whole days between the user's first and last event."""
    return cleaned.groupBy(*by).agg(to_days(F.max("ts") - F.min("ts")).alias(name))


def session_lengths(cleaned: DataFrame, by=BY_USER, name: str = "len") -> DataFrame:
    """One row per (user, session): minutes between first and last event."""
    return cleaned.groupBy(*by, "sessionId").agg(
        to_minutes(F.max("ts") - F.min("ts")).alias(name),
        F.min("ts").alias("first_ts"))


def avg_sess_len(cleaned: DataFrame, by=BY_USER) -> DataFrame:
    return (session_lengths(cleaned, by).groupBy(*by)
            .agg(F.avg("len").alias("avg_sess_len")))


def bin_gender(cleaned: DataFrame, by=BY_USER) -> DataFrame:
    return cleaned.groupBy(*by).agg(F.max(gender_flag()).alias("bin_gender"))


def pref_user_system(cleaned: DataFrame, by=BY_USER, *, mode: bool = False) -> DataFrame:
    """The user's system: the greatest name (default) or the most frequent one."""
    agg = F.mode("userSystem") if mode else F.max("userSystem")
    return cleaned.groupBy(*by).agg(agg.alias("pref_user_system"))


def session_page_counts(cleaned: DataFrame, by=BY_USER) -> DataFrame:
    """Clicks per (user, session, page) and the month of their mean time."""
    return cleaned.groupBy(*by, "sessionId", "page").agg(
        F.count("page").alias("cnt"), to_month(F.avg("ts")).alias("month"))


def monthly_page_clicks(counts: DataFrame, by=BY_USER) -> DataFrame:
    """Mean clicks per session, per (user, month, page)."""
    return counts.groupBy(*by, "month", "page").agg(F.avg("cnt").alias("avg_cnt"))


def page_clicks(cleaned: DataFrame, by=BY_USER, exclude: tuple[str, ...] = ()) -> DataFrame:
    """``avg_mhly_cnt``: mean over months of the mean clicks per session."""
    monthly = monthly_page_clicks(session_page_counts(cleaned, by), by)
    if exclude:
        monthly = monthly.filter(~F.col("page").isin(*exclude))
    return monthly.groupBy(*by, "page").agg(F.avg("avg_cnt").alias("avg_mhly_cnt"))


def page_pivot(clicks: DataFrame, pages: list[str] | None = None,
               value: str = "avg_mhly_cnt") -> DataFrame:
    """One column per page (spaces -> '_'), 0 where the user never clicked it.

    By default the pages found in the data (one extra job; more of them than
    ``spark.sql.pivotMaxValues`` is an error). The training table passes its
    fixed list, so that every column exists even when a page never occurs.
    """
    if pages is None:
        pages = sorted(r[0] for r in clicks.select("page").filter("page IS NOT NULL").distinct()
                       .limit(int(clicks.sparkSession.conf.get("spark.sql.pivotMaxValues")) + 1).collect())
        if len(pages) > int(clicks.sparkSession.conf.get("spark.sql.pivotMaxValues")):
            raise ValueError("more pages than spark.sql.pivotMaxValues")
    wide = clicks.groupBy("userId").pivot("page", pages).agg(F.sum(value)).fillna(0)
    return wide.withColumnsRenamed({p: p.replace(" ", "_") for p in pages if " " in p})


# --- Combined job ----------------------------------------------------------------

def base_aggregate(cleaned: DataFrame) -> DataFrame:
    """The one pass over the log: everything later steps need, per (user, session, page)."""
    return cleaned.groupBy("userId", "sessionId", "page").agg(
        F.count("page").alias("cnt"),
        F.avg("ts").alias("avg_ts"),
        F.min("ts").alias("min_ts"),
        F.max("ts").alias("max_ts"),
        F.sum("length").alias("len_sum"),
        F.count("length").alias("len_n"),
        F.sum("itemInSession").alias("item_sum"),
        F.count("itemInSession").alias("item_n"),
        F.max(gender_flag()).alias("gender_f"),
        F.max("userSystem").alias("system"),
        F.max("churn").alias("churn"),
    )


def scalar_features(base: DataFrame) -> DataFrame:
    """Per-user scalar features from the base aggregate (two roll-ups)."""
    sessions = base.groupBy("userId", "sessionId").agg(
        F.min("min_ts").alias("min_ts"), F.max("max_ts").alias("max_ts"),
        F.sum("len_sum").alias("len_sum"), F.sum("len_n").alias("len_n"),
        F.sum("item_sum").alias("item_sum"), F.sum("item_n").alias("item_n"),
        F.max("gender_f").alias("gender_f"), F.max("system").alias("system"),
        F.max("churn").alias("churn"))
    users = sessions.groupBy("userId").agg(
        F.max("churn").alias("churn"),
        F.count("sessionId").alias("n_sess"),
        F.min("min_ts").alias("first_ts"), F.max("max_ts").alias("last_ts"),
        F.sum("len_sum").alias("len_sum"), F.sum("len_n").alias("len_n"),
        F.sum("item_sum").alias("item_sum"), F.sum("item_n").alias("item_n"),
        F.avg(to_minutes(F.col("max_ts") - F.col("min_ts"))).alias("avg_sess_len"),
        F.max("gender_f").alias("bin_gender"),
        F.max("system").alias("system"))
    return users.select(
        "userId",
        ml_label(F.col("churn")).alias("churn"),
        sessions_per_day(F.col("n_sess"), F.col("first_ts"), F.col("last_ts")).alias("avg_sess_p_day"),
        F.when(F.col("len_n") > 0, F.col("len_sum") / F.col("len_n")).alias("avg_length"),
        F.when(F.col("item_n") > 0, F.col("item_sum") / F.col("item_n")).alias("avg_items_p_sess"),
        to_days(F.col("last_ts") - F.col("first_ts")).alias("acc_age"),
        "avg_sess_len",
        "bin_gender",
        usable_system(F.col("system")).alias("pref_user_system"),
    )


def click_features(base: DataFrame, pages: list[str] = FEATURE_PAGES) -> DataFrame:
    """Per-user page-click pivot from the base aggregate."""
    monthly = (base.withColumn("month", to_month(F.col("avg_ts")))
               .groupBy("userId", "month", "page").agg(F.avg("cnt").alias("avg_cnt")))
    clicks = monthly.groupBy("userId", "page").agg(F.avg("avg_cnt").alias("avg_mhly_cnt"))
    return page_pivot(clicks, pages)


def user_features(cleaned: DataFrame, *, materialize_base: bool = True) -> DataFrame:
    """One row per user: binary ``churn``, scalar features, system, page clicks.

    ``churn`` here is the ML label (1 = cancelled at least once); the raw
    cancellation count is ``user_label``. ``pref_user_system`` is the greatest
    system name with NULL and '' mapped to 'unknown'.
    """
    base = base_aggregate(cleaned)
    if materialize_base:
        base = materialize(base, "session-page-base")
    return scalar_features(base).join(click_features(base), "userId", "inner")
