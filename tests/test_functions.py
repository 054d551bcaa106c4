import datetime

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from churnlens.functions import to_day, to_days, to_hour, to_minutes, to_month


def _py(ms):
    td = datetime.timedelta(milliseconds=ms)
    dt = datetime.datetime.fromtimestamp(ms / 1000.0, tz=datetime.timezone.utc)
    return td.days, int(td.seconds / 60.0), float(dt.hour), float(dt.month), float(dt.weekday())


def _spark(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "ms long")
    out = df.select("ms", to_days("ms").alias("d"), to_minutes("ms").alias("m"),
                    to_hour("ms").alias("h"), to_month("ms").alias("mo"), to_day("ms").alias("wd"))
    return {r.ms: (r.d, r.m, r.h, r.mo, r.wd) for r in out.collect()}


def test_25_hour_span(spark):
    got = _spark(spark, [90_000_000])[90_000_000]
    assert got[0] == 1 and got[1] == 60


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(min_value=-10**12, max_value=4 * 10**12), min_size=20, max_size=60))
def test_matches_timedelta_semantics(spark, values):
    got = _spark(spark, values)
    for v in values:
        assert got[v] == _py(v), v


def test_types_and_nulls(spark):
    df = spark.createDataFrame([(None,)], "ms long")
    r = df.select(to_days("ms").alias("d"), to_minutes("ms").alias("m"), to_hour("ms").alias("h")).first()
    assert r.d is None and r.m is None and r.h is None
    schema = df.select(to_days("ms"), to_hour("ms")).schema
    assert [f.dataType.simpleString() for f in schema] == ["int", "float"]


def test_month_of_average_timestamp(spark):
    # a double (mean of ms values) is floored to whole ms first
    df = spark.createDataFrame([(1706745599999.7,)], "ms double")  # 2024-01-31T23:59:59.999
    assert df.select(to_month(F.col("ms")).alias("m")).first().m == 1.0
