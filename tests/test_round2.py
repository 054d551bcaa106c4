"""Rows in equal rows out, and the command line keeps the submitter's settings."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from churnlens.operators import clean as C
from churnlens.operators import explore as X
from churnlens.operators import features as FE
from churnlens.operators import joins as J
from churnlens.operators.histogram import histogram
from churnlens.operators.split import split_column, with_class_weights
from churnlens.plans.clean_job import run_clean
from churnlens.plans.explore_job import run_exploration
from churnlens.sources import read_event_log, split_bad_lines, write_parquet

from .conftest import ev, rows

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_running_label_keeps_null_times(spark, monkeypatch):
    data = [ev(ts=1, page="Home"), ev(ts=5, page="Cancellation Confirmation"), ev(ts=5), ev(ts=9), ev(ts=None),
            ev(ts=None, page="Cancellation Confirmation"), ev(user="2", ts=None), ev(user="2", ts=3)]
    got = []
    for limit in (1000, 1):
        monkeypatch.setattr(C, "MANY_CANCELLATIONS", limit)
        df = C.clean(rows(spark, data))
        got.append(sorted((r.userId, r.ts or -1, r.churn_phase) for r in C.with_churn_phase(df).collect()))
    assert got[0] == got[1] == [("1", -1, 1), ("1", -1, 1), ("1", 1, 1), ("1", 5, 2), ("1", 5, 2), ("1", 9, 2),
                                ("2", -1, 0), ("2", 3, 0)]


def test_bad_json_lines_are_seen(spark, tmp_path):
    lines = [{"userId": "1", "page": "Home", "ts": 1, "location": "x"}, {"userId": "1", "page": "Home", "ts": 2.5, "status": 200}]
    (tmp_path / "log.json").write_text("\n".join([*map(json.dumps, lines), "{broken"]))
    path = f"file://{tmp_path}/log.json"
    with pytest.raises(Exception, match="(?i)malformed|corrupt|parse"):
        read_event_log(spark, path).collect()
    good, bad = split_bad_lines(read_event_log(spark, path, bad_lines="keep").cache())
    assert (good.count(), bad.count()) == (1, 2)
    wide = read_event_log(spark, path, bad_lines="keep", all_fields=True)
    assert {"location", "status"} <= set(wide.columns)
    out = run_clean(spark, path, f"file://{tmp_path}/out", bad_lines="keep")
    assert spark.read.parquet(out).count() == 1 and spark.read.parquet(f"{out}.bad-lines").count() == 2


def test_pivot_keeps_every_page(spark):
    df = C.clean(rows(spark, [ev(page="Submit Registration"), ev(page="Home"), ev(user="2", page="NextSong")]))
    wide = FE.page_pivot(FE.page_clicks(df))
    assert set(wide.columns) == {"userId", "Submit_Registration", "Home", "NextSong"}


def test_null_groups_are_kept(spark):
    df = spark.createDataFrame([("a", 1.0, 0), ("a", 2.0, 1), (None, 3.0, 0), (None, 5.0, 0)], "g string, v double, churn int")
    for bins in (4, [0, 2, 10]):
        for kw in ({}, {"groups": 2}):
            assert histogram(df, "v", ("g",), bins=bins, **kw).agg(F.sum("cnt")).first()[0] == 4
    assert histogram(df, "v", (), bins=3).agg(F.sum("cnt")).first()[0] == 4
    weights = with_class_weights(df, by=["g"]).collect()
    assert sorted((r.g or "", r.weightCol) for r in weights) == [("", 0.25), ("", 0.25), ("a", 0.5), ("a", 0.5)]


def test_split_uses_fraction_and_seed(spark):
    df = spark.range(10_000).select(F.col("id").cast("string").alias("userId"))

    def part(**kw):
        return {r[0] for r in df.filter(split_column(**kw) == "validation").collect()}
    assert len(part(fraction=1.0)) == 10_000 and not part(fraction=0.0)
    assert 400 < len(part(fraction=0.05)) < 600
    assert part(seed=1) != part(seed=7) and part(seed=7) == part(seed=7)


def test_equal_rows_of_a_hot_key_are_spread(spark):
    big = spark.createDataFrame([("hot",)] * 8001 + [(str(i),) for i in range(200)], "userId string")
    small = spark.createDataFrame([("hot", 1), ("5", 2)], "userId string, n int")
    joined = J.salted_join(big, small, "userId", "left")
    assert joined.filter("n = 1").count() == 8001 and joined.count() == 8201
    salted = big.withColumn("s", F.pmod(F.monotonically_increasing_id(), F.lit(16)))
    assert salted.filter("userId = 'hot'").select("s").distinct().count() == 16


def _scratch_tables(spark):
    from churnlens.session import shared_dir
    from churnlens.sources.table_sets import _children

    return set(_children(spark, f"{shared_dir(spark)}/churnlens"))


def test_jobs_leave_no_scratch_tables(spark, tmp_path):
    path = write_parquet(C.clean(rows(spark, [ev(), ev(user="2", ts=5)])), f"file://{tmp_path}/in")
    before = _scratch_tables(spark)
    (tmp_path / "log.json").write_text(json.dumps({"userId": "1", "page": "Home", "ts": 1}))
    run_clean(spark, f"file://{tmp_path}/log.json", f"file://{tmp_path}/out")
    run_exploration(spark, path, f"file://{tmp_path}/tables")
    assert _scratch_tables(spark) == before


def test_scratch_ends_with_its_own_tables_only(spark):
    from concurrent.futures import ThreadPoolExecutor

    from churnlens.session import scratch

    def other():
        return J.materialize(spark.range(5), "other-thread")
    before = J.materialize(spark.range(3), "before")
    with scratch(spark), ThreadPoolExecutor(1) as pool:
        mine = J.materialize(spark.range(4), "mine")
        theirs = pool.submit(other).result()
        with scratch(spark):
            inner = J.materialize(spark.range(2), "inner")
        assert mine.count() == 4
        with pytest.raises(Exception, match="(?i)exist"):
            inner.select("id").collect()
    assert before.count() == 3 and theirs.count() == 5
    with pytest.raises(Exception, match="(?i)exist"):
        mine.select("id").collect()


def test_wide_small_side_is_not_broadcast(spark):
    small = J.materialize(spark.range(10).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x")), "small")
    assert J.fits(small, 10) and not J.fits(small, 9)
    spark.conf.set("spark.churnlens.maxBroadcastBytes", "100")
    try:
        assert not J.fits(small, 10)
    finally:
        spark.conf.unset("spark.churnlens.maxBroadcastBytes")


def test_exploration_writes_per_user_tables_in_parallel(spark, tmp_path):
    data = [ev(user=str(u), ts=u * 1000 + s * 10**8, session=s, gender=None if u % 9 == 0 else "MF"[u % 2])
            for u in range(300) for s in range(2)]
    path = write_parquet(C.clean(rows(spark, data)), f"file://{tmp_path}/cleaned")
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1"}
    for k, v in small.items():  # so that adaptive execution has no reason to merge
        spark.conf.set(k, v)
    try:
        names = run_exploration(spark, path, f"file://{tmp_path}/out")
    finally:
        for k in small:
            spark.conf.unset(k)
    assert {"lifetimes", "session_durations", "system_by_churn"} <= set(names)
    for name in ("session_stats_long", "lifetimes", "session_durations"):
        assert len([f for f in os.listdir(f"{tmp_path}/out/{name}") if f.endswith(".parquet")]) > 1
    cleaned = spark.read.parquet(path)
    got = spark.read.parquet(f"file://{tmp_path}/out/gender_by_churn").collect()
    assert sorted(map(repr, got)) == sorted(map(repr, X.gender_by_churn(cleaned).collect()))


def test_command_line_keeps_the_submitters_session(spark, tmp_path):
    (tmp_path / "log.json").write_text(json.dumps({"userId": "1", "page": "Home", "ts": 1}))
    code = ("import sys; from churnlens.__main__ import main; "
            f"main(['clean', '-i', 'file://{tmp_path}/log.json', '-o', 'file://{tmp_path}/out']); "
            "from pyspark.sql import SparkSession; s = SparkSession.getActiveSession(); "
            "print('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'), s.conf.get('spark.driver.memory'))")
    submit = "--master local[2] --driver-memory 1g --conf spark.sql.shuffle.partitions=33 --conf spark.ui.enabled=false pyspark-shell"
    run = subprocess.run([sys.executable, "-c", code], cwd=REPO, capture_output=True, text=True, timeout=300,
                         env=os.environ | {"PYSPARK_SUBMIT_ARGS": submit})
    assert "GOT local[2] 33 1g" in run.stdout, run.stderr[-2000:]
