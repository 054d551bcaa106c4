from pyspark.sql import functions as F

from churnlens.operators.joins import hot_keys, join_small, rows_of_users, salted_join


def _big(spark):
    # key 0 holds half of all rows: a hot key
    return spark.range(20_000).select(
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 97).alias("k"),
        F.col("id").alias("v"))


def test_hot_keys_found_with_proportional_salts(spark):
    hot = [(r.k, r["__hot"]) for r in hot_keys(_big(spark), ["k"]).collect()]
    # key 0 holds 10000 even ids + 103 odd multiples of 97; fair share = 20000 / 8 = 2500
    assert hot == [(0, 9)]  # ceil(2 * 10103 / 2500)


def test_salted_join_equals_plain_join(spark):
    big = _big(spark)
    small = spark.range(0, 50).select(F.col("id").alias("k"), (F.col("id") * 10).alias("x"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = sorted(tuple(r) for r in big.join(small, "k", how).collect())
        salted = sorted(tuple(r) for r in salted_join(big, small, "k", how).collect())
        assert plain == salted, how


def test_join_small_broadcasts_within_bound(spark):
    big = _big(spark)
    small = spark.range(0, 50).select(F.col("id").alias("k"), F.lit(1).alias("x"))
    plan = join_small(big, small, "k", "left")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    over = join_small(big, small, "k", "left", max_rows=10)
    assert over.count() == big.count()


def test_rows_of_users(spark):
    ev = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "userId string, x int")
    users = spark.createDataFrame([("a",), ("a",)], "userId string")
    assert sorted(r.x for r in rows_of_users(ev, users).collect()) == [1, 3]


def test_salt_counts_are_bounded_for_any_skew(spark):
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shapes = {
        "one_third": F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 500),
        "zipf_like": F.floor(F.lit(1000) / (F.col("id") % 1000 + 1)).cast("long"),
        "uniform": F.col("id") % 5000,
    }
    for name, key in shapes.items():
        big = spark.range(60_000).select(key.alias("k"))
        total = 60_000
        share = total // n_parts
        hot = hot_keys(big, ["k"]).collect()
        salts = sum(r["__hot"] for r in hot)
        assert len(hot) < n_parts and salts <= 3 * n_parts, name
        counts = {r.k: r["count"] for r in big.groupBy("k").count().collect()}
        for r in hot:  # every salted piece holds at most half a fair share
            assert counts[r.k] / r["__hot"] <= share / 2 + 1, name


def test_only_scans_are_salted_as_they_are(spark):
    from churnlens.operators.joins import is_scan, materialize

    table = materialize(_big(spark), "big")
    assert is_scan(table) and is_scan(table.filter("v > 3").select("k"))
    for df in (table.repartition(3), table.groupBy("k").count(), table.join(table.select("k").distinct(), "k"), table.sort("v")):
        assert not is_scan(df)
    small = spark.range(0, 50).select(F.col("id").alias("k"), (F.col("id") * 10).alias("x"))
    shuffled = table.repartition(5, F.rand(1))
    assert salted_join(shuffled, small, "k").count() == table.join(small, "k").count()
