"""Day states merge to the features of the whole log; sketches merge to quartiles."""

import pytest
from pyspark.sql import functions as F

from churnlens.operators import features as FE
from churnlens.operators import quantiles as Q
from churnlens.operators import state as S
from churnlens.plans.registry import cleaned, kept, rounded, with_nulls
from churnlens.session import scratch_path

from .conftest import SF001, ev, rows


def same(a, b):
    key = lambda df: sorted(map(repr, map(tuple, rounded(df.select(*sorted(df.columns))).collect())))
    return key(a) == key(b)


@pytest.fixture(scope="module")
def log(spark):
    return kept(spark, SF001).cache()


def test_days_one_by_one_equal_the_whole_log(spark, log):
    store = S.StateStore(spark, scratch_path(spark, "state"))
    days = sorted(r[0] for r in log.select(S.day_of()).distinct().collect())
    store.add_days(log.filter(S.day_of() <= days[-4]))
    for day in days[-3:]:
        store.add_day(day, log.filter(S.day_of() == day))
        if day == days[-2]:
            store.add_day(day, log.filter(S.day_of() == day))  # a re-run replaces, it does not add
    whole = FE.user_features(cleaned(spark, SF001))
    assert store.days() == days and same(store.features(), whole)
    store.compact(days[0], days[-3])
    assert store.days() == [f"{days[0]}..{days[-3]}", *days[-2:]] and same(store.features(), whole)
    with pytest.raises(ValueError, match="compacted"):
        store.add_day(days[1], log.limit(1))


def test_a_cancellation_today_changes_the_label_of_old_rows(spark):
    store = S.StateStore(spark, scratch_path(spark, "state"))
    from churnlens.operators import clean as C
    prepare = lambda data: C.keep_columns(C.drop_anonymous(C.with_user_system(rows(spark, data))))
    store.add_day("1970-01-01", prepare([ev(ts=1), ev(user="2", ts=2)]))
    churn = lambda: {r["userId"]: r["churn"] for r in store.features().collect()}
    assert churn() == {"1": 0, "2": 0}
    store.add_day("1970-01-02", prepare([ev(ts=86_400_001, page="Cancellation Confirmation")]))
    assert churn() == {"1": 1, "2": 0}
    store.add_day("1970-01-01+1", prepare([ev(user="3", ts=5, session=9)]))  # late rows under a name of their own
    assert churn() == {"1": 1, "2": 0, "3": 0}
    assert store.compact("1970-01-01", "1970-01-02") and store.days() == ["1970-01-01..1970-01-02"]
    assert churn() == {"1": 1, "2": 0, "3": 0}


def test_states_with_nulls(spark):
    log = with_nulls(spark, SF001)
    whole = FE.user_features(log)
    parts = [S.day_state(log.filter(S.day_of() < "2024-01-10")), S.day_state(log.filter(S.day_of() >= "2024-01-10"))]
    assert same(S.features_from_state(S.merge_states(*parts)), whole)
    store = S.StateStore(spark, scratch_path(spark, "state"))
    with pytest.raises(ValueError):
        store.state()
    store.add_days(log)
    assert S.NO_DAY in store.days() and same(store.features(), whole)


def test_merged_sketches_keep_their_rank_error(spark):
    df = spark.range(200_000).select(
        (F.col("id") % 3).alias("g"), F.when(F.col("id") % 10 > 0, F.pow(F.rand(7), 3) * 1000).alias("v"),
        (F.col("id") % 5).cast("double").alias("few"), F.lit(None).cast("double").alias("none"),
        (F.col("id") % 17).alias("day"))
    parts = Q.quantile_sketches(df, ["v", "few", "none"], ["g", "day"])
    found = Q.quantiles(Q.merge_sketches(parts, ["g"])).cache()
    assert {r["column"]: r["n"] for r in found.filter("g = 1").collect()} == {"v": 60000, "few": 66667} | (
        {"none": 0} if found.filter("column = 'none'").count() else {})
    for column in ("v", "few"):
        for r in Q.rank_errors(df, found, column, ["g"]).collect():
            assert max(r["e25"], r["e50"], r["e75"]) <= Q.RANK_ERROR
    everything = Q.quantiles(Q.merge_sketches(parts)).filter("column = 'few'").first()
    assert (everything["q25"], everything["q50"], everything["q75"]) == (1.0, 2.0, 3.0)
    off = found.withColumn("q50", F.col("q50") * 2)  # a wrong quantile shows
    assert Q.rank_errors(df, off, "v", ["g"]).filter("e50 > 0.05").count() == 3
    assert Q.rank_errors(df, Q.quantiles(Q.merge_sketches(parts)), "v").first()["e50"] <= Q.RANK_ERROR


def test_describe_with_quartiles(spark):
    from churnlens.operators.explore import describe_numeric

    df = spark.range(1000).select(F.col("id").alias("a"), F.lit(2.0).alias("b"), F.lit(None).cast("long").alias("c"))
    got = {r["column"]: r for r in describe_numeric(df, quartiles=True).collect()}
    assert all(abs(got["a"][f"q{p}"] - 10 * p) <= 20 for p in (25, 50, 75)) and got["b"]["q50"] == 2.0
    assert got["c"]["count"] == 0 and got["c"]["q25"] is None
    assert describe_numeric(df).columns == ["column", "count", "mean", "stddev", "min", "max"]
