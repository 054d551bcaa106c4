"""Daily re-runs: features from mergeable per-day states instead of the whole log.

A day's state is one row per (user, session, page) with sums, counts and extremes, from which
every feature and the label follow, and which merge by adding. A re-run of the service aggregates
the new day's rows only; features read the merged states, a fraction of the log. Old days'
states can be compacted into one. ``StateStore`` keeps the parts as a published table set, so a part
appears or is replaced as a whole: a day that is run again replaces itself and never counts twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.functions import gender_flag
from churnlens.operators.features import click_features, scalar_features
from churnlens.operators.joins import join_small, materialize
from churnlens.schema import CANCEL_PAGE
from churnlens.session import scratch_path
from churnlens.sources.table_sets import commit, manifests, publish

KEY = ("userId", "sessionId", "page")
#: Part name of the rows without a time.
NO_DAY = "none"
_SUMS = ("n_rows", "cnt", "ts_sum", "ts_n", "len_sum", "len_n", "item_sum", "item_n")
_LEAST = ("min_ts",)
_MOST = ("max_ts", "gender_f", "system")


def day_of(ts="ts"):
    """UTC date of a time in milliseconds, as text."""
    return F.coalesce(F.date_format(F.timestamp_millis(F.col(ts)), "yyyy-MM-dd"), F.lit(NO_DAY))


def day_state(kept: DataFrame, *by: str) -> DataFrame:
    """State of some rows of the kept log (no label needed): one row per user, session, page
    (and the columns ``by``)."""
    return kept.groupBy(*by, *KEY).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("page").alias("cnt"),
        F.sum(F.col("ts").cast("decimal(20,0)")).alias("ts_sum"), F.count("ts").alias("ts_n"),
        F.sum("length").alias("len_sum"), F.count("length").alias("len_n"),
        F.sum("itemInSession").alias("item_sum"), F.count("itemInSession").alias("item_n"),
        F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts"),
        F.max(gender_flag()).alias("gender_f"), F.max("userSystem").alias("system"),
    ).withColumn("ts_sum", F.col("ts_sum").cast("decimal(38,0)"))


def merge_states(*states: DataFrame) -> DataFrame:
    """The state of all the rows behind several states; partial sums merge before the shuffle."""
    every = states[0]
    for s in states[1:]:
        every = every.unionByName(s)
    merged = every.groupBy(*KEY).agg(
        *[F.sum(c).alias(c) for c in _SUMS], *[F.min(c).alias(c) for c in _LEAST], *[F.max(c).alias(c) for c in _MOST])
    return merged.withColumn("ts_sum", F.col("ts_sum").cast("decimal(38,0)")).select(*states[0].columns)


def state_label(state: DataFrame) -> DataFrame:
    """(userId, churn) of the users that have cancelled, from the state alone."""
    return (state.filter(F.col("page") == CANCEL_PAGE).groupBy("userId").agg(F.sum("n_rows").alias("churn")))


def features_from_state(state: DataFrame) -> DataFrame:
    """``user_features`` of the rows behind a state."""
    base = state.withColumn("avg_ts", F.col("ts_sum").cast("double") / F.nullif(F.col("ts_n"), F.lit(0)))
    base = join_small(base, state_label(state), "userId", "left")
    base = materialize(base.withColumn("churn", F.coalesce("churn", F.lit(0))), "state-base")
    return scalar_features(base).join(click_features(base), "userId", "inner")


class StateStore:
    """Day states below one folder: parts named by their day, or ``first..last`` when compacted."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _parts(self) -> dict[str, str]:
        every = manifests(self.spark, self.root)
        return every[max(every)] if every else {}

    def days(self) -> list[str]:
        return sorted(self._parts())

    def _free(self, days: list[str]) -> None:
        for name in self._parts():
            first, _, last = name.partition("..")
            inside = [d for d in days if last and first <= d <= last]
            if inside:
                raise ValueError(f"{inside} are compacted into {name}: add their late rows under another name, such as '{inside[0]}+1'")

    def add_day(self, day: str, kept: DataFrame) -> int:
        """Aggregate one day's rows; a day added again replaces its part."""
        self._free([day])
        keep = {k: v for k, v in self._parts().items() if k != day}
        return publish(self.spark, self.root, {day: day_state(kept)}, keep=keep)

    def add_days(self, kept: DataFrame) -> int:
        """Aggregate many days' rows in one job (a first load), a part for each day."""
        at = f"data/{scratch_path(self.spark, 'x').rsplit('-', 1)[1]}"
        state = day_state(kept.withColumn("day", day_of()), "day")
        state.repartition("day", "userId").write.partitionBy("day").parquet(f"{self.root}/{at}")
        days = [r[0] for r in self.spark.read.parquet(f"{self.root}/{at}").select(F.col("day").cast("string")).distinct().collect()]
        self._free(days)
        return commit(self.spark, self.root, {**self._parts(), **{d: f"{at}/day={d}" for d in days}})

    def compact(self, first: str, last: str) -> str:
        """Merge the parts of the days ``first`` to ``last`` into one; its name."""
        parts = self._parts()
        mine = [d for d in parts if first <= d.partition("..")[0] and (d.partition("..")[2] or d.partition("+")[0]) <= last]
        if not mine:
            raise ValueError(f"no part between {first} and {last}")
        name = f"{first}..{last}"
        publish(self.spark, self.root, {name: merge_states(self._read(mine))}, keep={k: v for k, v in parts.items() if k not in mine})
        return name

    def _read(self, names: list[str]) -> DataFrame:
        parts = self._parts()
        frames = self.spark.read.parquet(f"{self.root}/{parts[names[0]]}")
        return self.spark.read.schema(frames.schema).parquet(*[f"{self.root}/{parts[n]}" for n in names])

    def state(self) -> DataFrame:
        """The merged state of every part."""
        if not self.days():
            raise ValueError(f"no state below {self.root}")
        return merge_states(self._read(self.days()))

    def features(self) -> DataFrame:
        return features_from_state(self.state())
