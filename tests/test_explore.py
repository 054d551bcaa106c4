from pyspark.sql import functions as F

from churnlens.operators import explore as X
from churnlens.operators.histogram import histogram
from churnlens.plans.registry import cleaned


def test_null_profile_string_column_no_cast_error(spark):
    df = spark.createDataFrame([(None, float("nan")), ("x", 1.0), ("y", None)], "s string, d double")
    r = X.null_profile(df).first()
    assert r.s == 1 and r.d == 2


def test_shares_sum_to_one(spark):
    c = cleaned(spark, "/root/testdata/sf0.01")
    for bucket in ("hour", "weekday"):
        for g in (X.loyal(), X.cancelled()):
            total = X.bucket_share(c, bucket, g).agg(F.sum("count")).first()[0]
            assert abs(total - 1.0) < 1e-9
    s = X.system_share(c).groupBy("churn").agg(F.sum("percentage").alias("p")).collect()
    assert all(abs(r.p - 1.0) < 1e-9 for r in s)


def test_share_by_user_frame_equals_predicate(spark):
    c = cleaned(spark, "/root/testdata/sf0.001")
    a = {tuple(r) for r in X.bucket_share(c, "hour", X.loyal_users(c)).collect()}
    b = {tuple(r) for r in X.bucket_share(c, "hour", X.loyal()).collect()}
    assert a == b


def test_share_is_sorted_descending(spark):
    c = cleaned(spark, "/root/testdata/sf0.01")
    vals = [r["count"] for r in X.bucket_share(c, "hour", X.loyal()).collect()]
    assert vals == sorted(vals, reverse=True)


def test_histogram_counts_sum_to_rows(spark):
    c = cleaned(spark, "/root/testdata/sf0.01")
    life = X.lifetimes(c)
    h = histogram(life, "lifetime", density=True)
    assert h.agg(F.sum("cnt")).first()[0] == life.count()
    dens = h.groupBy("churn").agg(F.sum(F.col("density") * (F.col("bin_hi") - F.col("bin_lo"))).alias("a"))
    assert all(abs(r.a - 1.0) < 1e-9 for r in dens.collect())


def test_histogram_edges_drop_outside_and_close_last_bin(spark):
    df = spark.createDataFrame([(0, v) for v in (-1.0, 0.0, 0.5, 4.99, 5.0, 6.0)], "churn int, v double")
    h = {r.bin: r.cnt for r in histogram(df, "v", bins=[0, 1, 2, 3, 4, 5]).collect()}
    assert h == {0: 2, 4: 2}


def test_histogram_single_value_group(spark):
    df = spark.createDataFrame([(0, 3.0), (0, 3.0)], "churn int, v double")
    r = histogram(df, "v").collect()
    assert len(r) == 1 and r[0].cnt == 2 and r[0].bin_lo <= 3.0 <= r[0].bin_hi


def test_melt_long_form(spark):
    c = cleaned(spark, "/root/testdata/sf0.001")
    stats = X.session_stats(c)
    long = X.melt(stats, ["churn", "userId"])
    assert long.count() == 3 * stats.count()
    assert sorted(r.variable for r in long.select("variable").distinct().collect()) == ["avg", "max", "min"]


def test_describe_matches_builtin(spark):
    c = cleaned(spark, "/root/testdata/sf0.001")
    mine = {r.column: r for r in X.describe_numeric(c, ["ts", "length"]).collect()}
    builtin = {r.summary: r for r in c.describe("ts", "length").collect()}
    assert int(builtin["count"].ts) == mine["ts"]["count"]
    assert abs(float(builtin["mean"].length) - mine["length"]["mean"]) < 1e-6


def test_session_summary_reuse_gives_same_results(spark):
    c = cleaned(spark, "/root/testdata/sf0.01")
    s = X.summarize(c)
    for fn in (X.lifetime_stats, X.session_stats, X.up_down_grades, X.system_share, X.system_counts):
        a = sorted(tuple(r) for r in fn(c).collect())
        b = sorted(tuple(r) for r in fn(sessions=s).collect())
        assert a == b, fn.__name__
    a = [tuple(r) for r in X.session_durations(c).collect()]
    b = [tuple(r) for r in X.session_durations(sessions=s).collect()]
    assert a == b


def test_time_shares_from_one_pass(spark):
    c = cleaned(spark, "/root/testdata/sf0.01")
    counts = X.time_bucket_counts(c)
    assert counts.count() <= 2 * 25 * 8
    for bucket in ("hour", "weekday"):
        for name, pred in (("loyal", X.loyal()), ("cancelled", X.cancelled())):
            a = sorted(tuple(r) for r in X.share_from_counts(counts, bucket, name).collect())
            b = sorted(tuple(r) for r in X.bucket_share(c, bucket, pred).collect())
            assert len(a) == len(b) and all(x[0] == y[0] and abs(x[1] - y[1]) < 1e-12 for x, y in zip(a, b))
