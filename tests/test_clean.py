from pyspark.sql import functions as F

from churnlens.operators.clean import (
    clean, drop_anonymous, keep_columns, with_churn, with_churn_phase, with_user_system,
)
from churnlens.schema import CANCEL_PAGE, KEPT_COLUMNS
from tests.conftest import ev, rows


def test_anonymous_rows_dropped(spark):
    df = rows(spark, [ev(user=""), ev(user=None), ev(user="7")])
    assert [r.userId for r in drop_anonymous(df).collect()] == ["7"]


def test_user_system_extraction(spark):
    df = rows(spark, [ev(user="1", agent="curl/7.0"), ev(user="2", agent=None),
                      ev(user="3", agent="Mozilla/5.0 (Windows NT 6.1; WOW64)")])
    out = {r.userId: r.userSystem for r in with_user_system(df).collect()}
    assert out == {"1": "", "2": None, "3": "Windows NT 6.1"}
    assert "userAgent" not in with_user_system(df).columns


def test_two_cancellations_label_every_row(spark):
    df = rows(spark, [ev(user="1", page=CANCEL_PAGE, ts=1), ev(user="1", page=CANCEL_PAGE, ts=2),
                      ev(user="1", page="Home", ts=3), ev(user="2", ts=4)])
    out = clean(df)
    assert out.columns == KEPT_COLUMNS + ["churn"]
    got = sorted((r.userId, r.churn) for r in out.collect())
    assert got == [("1", 2), ("1", 2), ("1", 2), ("2", 0)]


def test_label_equals_window_total_on_test_data(spark):
    from churnlens.plans.registry import kept

    k = kept(spark, "/root/testdata/sf0.01")
    from pyspark.sql import Window
    ref = k.withColumn("ref", F.sum(F.when(F.col("page") == CANCEL_PAGE, 1).otherwise(0))
                       .over(Window.partitionBy("userId")))
    got = with_churn(ref)
    assert got.filter(F.col("ref") != F.col("churn")).count() == 0


def test_salted_path_gives_same_label(spark):
    from churnlens.plans.registry import kept

    k = kept(spark, "/root/testdata/sf0.001")
    a = {tuple(r) for r in with_churn(k).collect()}
    b = {tuple(r) for r in with_churn(k, max_rows=0).collect()}  # forces the shuffle + salt path
    assert a == b


def test_churn_phase_is_running_count(spark):
    df = keep_columns(with_user_system(rows(spark, [
        ev(user="1", ts=10), ev(user="1", page=CANCEL_PAGE, ts=20), ev(user="1", ts=20),
        ev(user="1", ts=7_200_000), ev(user="1", page=CANCEL_PAGE, ts=7_300_000),
        ev(user="1", ts=9_000_000), ev(user="2", ts=5)])))
    out = with_churn_phase(with_churn(df))
    got = sorted((r.userId, r.ts, r.churn_phase) for r in out.collect())
    assert got == [("1", 10, 0), ("1", 20, 1), ("1", 20, 1), ("1", 7_200_000, 1),
                   ("1", 7_300_000, 2), ("1", 9_000_000, 2), ("2", 5, 0)]


def test_cleaned_counts_match_fixture_notes(spark):
    from churnlens.plans.registry import cleaned

    c = cleaned(spark, "/root/testdata/sf0.01")
    assert c.count() == 9405
    per = c.groupBy("userId").agg(F.max("churn").alias("c")).groupBy("c").count().collect()
    assert {r.c: r["count"] for r in per} == {0: 85, 1: 51, 2: 4, 3: 1}


def test_churn_phase_without_label_column_and_with_it_agree(spark):
    df = keep_columns(with_user_system(rows(spark, [
        ev(user="1", ts=10), ev(user="1", page=CANCEL_PAGE, ts=20), ev(user="1", ts=60_000 * 5),
        ev(user="2", ts=5), ev(user="2", ts=6)])))
    a = sorted((r.userId, r.ts, r.churn_phase) for r in with_churn_phase(df).collect())
    b = sorted((r.userId, r.ts, r.churn_phase) for r in with_churn_phase(with_churn(df)).collect())
    assert a == b == [("1", 10, 0), ("1", 20, 1), ("1", 300_000, 1), ("2", 5, 0), ("2", 6, 0)]
