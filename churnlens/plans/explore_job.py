"""Exploration job: every loyal-vs-cancelled comparison, written as tables.

The cleaned log is read four times: summarised per (churn, user, session) and
per (group, hour, weekday), for the plan level at cancellation (a pushed-down
filter) and for the clicks; every other comparison reads a summary. Results
are written as Spark partitions them: tables per user or session stay
distributed. The tables do not depend on each other, so several are written at a time
and small ones fill the executors that a long one leaves idle.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from churnlens.operators import explore as X
from churnlens.operators.histogram import histogram
from churnlens.operators.joins import materialize
from churnlens.session import carried, ensure_core_conf, scratch
from churnlens.sources import read_parquet, write_parquet


def comparisons(cleaned: DataFrame, sessions: DataFrame,
                times: DataFrame) -> dict[str, Callable[[], DataFrame]]:
    by = X.BY_CHURN_USER
    stats = lambda: X.melt(X.session_stats(sessions=sessions), list(by))
    grades = lambda: X.melt(X.up_down_grades(sessions=sessions), list(by), "long")
    return {
        "gender_by_churn": lambda: X.gender_from_summary(sessions),
        "system_by_churn": lambda: X.system_counts(sessions=sessions),
        "system_share": lambda: X.system_share(sessions=sessions),
        "hour_share_loyal": lambda: X.share_from_counts(times, "hour", "loyal"),
        "hour_share_cancelled": lambda: X.share_from_counts(times, "hour", "cancelled"),
        "weekday_share_loyal": lambda: X.share_from_counts(times, "weekday", "loyal"),
        "weekday_share_cancelled": lambda: X.share_from_counts(times, "weekday", "cancelled"),
        "lifetimes": lambda: X.lifetimes(sessions=sessions),
        "lifetime_stats": lambda: X.lifetime_stats(sessions=sessions),
        "session_durations": lambda: X.session_durations(ordered=False, sessions=sessions),
        "session_stats_long": stats,
        "up_down_grades_long": grades,
        "cancel_level": lambda: X.cancel_level(cleaned),
        "page_click_means": lambda: X.page_click_means(cleaned),
        "hist_avg_length": lambda: histogram(X.mean_from_sums(sessions, "len_sum", "len_n", "avg_len"), "avg_len"),
        "hist_items_p_sess": lambda: histogram(X.mean_from_sums(sessions, "item_sum", "item_n", "avg"), "avg"),
        "hist_sess_p_day": lambda: histogram(X.sess_p_day_from_summary(sessions), "avg_sess_p_day",
                                             bins=[0, 1, 2, 3, 4, 5]),
        "hist_lifetime": lambda: histogram(X.lifetimes(sessions=sessions), "lifetime", density=True),
        "hist_session_duration": lambda: histogram(X.session_durations(ordered=False, sessions=sessions),
                                                   "session_duration", density=True),
        "hist_session_stats": lambda: histogram(stats(), "value", ("churn", "variable"), density=True),
        "hist_up_down_grades": lambda: histogram(grades(), "value", ("churn", "variable"), density=True),
    }


def run_exploration(spark: SparkSession, cleaned_path: str, out_dir: str, *,
                    mode: str = "errorifexists", at_a_time: int = 4) -> list[str]:
    """Write every comparison under ``out_dir``, ``at_a_time`` of them together; returns the table names."""
    ensure_core_conf(spark)  # hours, weekdays and months in UTC
    cleaned = read_parquet(spark, cleaned_path)
    with scratch(spark):
        sessions = X.summarize(cleaned)
        times = materialize(X.time_bucket_counts(cleaned), "time-bucket-counts")
        tables = comparisons(cleaned, sessions, times)

        def write(name: str) -> str:
            write_parquet(tables[name](), f"{out_dir.rstrip('/')}/{name}", mode)
            return name
        with ThreadPoolExecutor(at_a_time) as pool:
            return list(pool.map(carried(spark, write), tables))
