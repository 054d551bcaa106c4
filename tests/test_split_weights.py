from pyspark.sql import functions as F

from churnlens.operators.split import split_column, train_validation_split, with_class_weights
from churnlens.plans.feature_job import weighted_split
from churnlens.plans.registry import features


def test_weights_sum_to_half_per_class(spark):
    f = features(spark, "/root/testdata/sf0.01")
    train, validation = weighted_split(f)
    for part in (train, validation):
        sums = part.groupBy("churn").agg(F.sum("weightCol").alias("s")).collect()
        assert all(abs(r.s - 0.5) < 1e-9 for r in sums)


def test_one_class_only(spark):
    df = spark.createDataFrame([("a", 0), ("b", 0), ("c", 0), ("d", 0)], "userId string, churn long")
    out = with_class_weights(df).collect()
    assert all(abs(r.weightCol - 0.125) < 1e-12 for r in out)


def test_split_disjoint_complete_deterministic(spark):
    f = features(spark, "/root/testdata/sf0.01").select("userId", "churn")
    train, validation = train_validation_split(f)
    t = {r.userId for r in train.collect()}
    v = {r.userId for r in validation.collect()}
    assert not (t & v) and len(t | v) == 141 and 5 <= len(v) <= 30
    again = {r.userId for r in train_validation_split(f.repartition(5))[1].collect()}
    assert again == v


def test_random_split_variant(spark):
    f = features(spark, "/root/testdata/sf0.01").select("userId")
    train, validation = train_validation_split(f, method="random")
    assert train.count() + validation.count() == 141


def test_split_fraction_on_many_keys(spark):
    df = spark.range(200_000).select(F.col("id").cast("string").alias("userId"))
    share = df.filter(split_column() == "validation").count() / 200_000
    assert abs(share - 0.1) < 0.005
