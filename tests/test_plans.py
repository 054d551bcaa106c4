from pyspark.sql import functions as F

from churnlens.plans.registry import raw
from churnlens.plans.workflows import preprocess, train_and_evaluate
from churnlens.session import scratch_path
from churnlens.sources import read_parquet, write_event_log_json


def test_end_to_end_workflows(spark):
    root = scratch_path(spark, "e2e")
    log = write_event_log_json(raw(spark, "/root/testdata/sf0.01"), f"{root}/raw")
    preprocess(spark, log, f"{root}/cleaned", f"{root}/train", f"{root}/validation")
    cleaned = read_parquet(spark, f"{root}/cleaned")
    assert cleaned.count() == 9405 and "cancel_event" not in cleaned.columns
    train = read_parquet(spark, f"{root}/train")
    validation = read_parquet(spark, f"{root}/validation")
    assert train.count() + validation.count() == 141
    table = train_and_evaluate(spark, f"{root}/train", f"{root}/validation", f"{root}/models",
                               algos=("nb", "lr"))
    got = {(r.Algorithm, r.Metric) for r in table.collect()}
    assert got == {(a, m) for a in ("nb", "lr") for m in ("Recall", "Precision", "Accuracy", "F1")}
    assert table.filter((F.col("Score") < 0) | (F.col("Score") > 1)).count() == 0


def test_parquet_sink_refuses_existing_path(spark):
    import pytest
    from churnlens.sources import write_parquet

    path = scratch_path(spark, "sink")
    write_parquet(spark.range(3), path)
    with pytest.raises(Exception):
        write_parquet(spark.range(3), path)


def test_training_dispatcher_all_and_unknown(spark):
    import pytest
    from churnlens.plans.feature_job import weighted_split
    from churnlens.plans.registry import features
    from churnlens.plans.train_job import run_training
    from churnlens.sources import write_parquet

    root = scratch_path(spark, "dispatch")
    train_df, _ = weighted_split(features(spark, "/root/testdata/sf0.001"))
    write_parquet(train_df, f"{root}/train")
    models = run_training(spark, "all", f"{root}/train", f"{root}/models")
    assert sorted(models) == ["lr", "nb", "rf", "svm"]
    with pytest.raises(ValueError):
        run_training(spark, "xgb", f"{root}/train", f"{root}/m")


def test_sql_functions_match_column_functions(spark):
    from churnlens.functions import to_day, to_days, to_hour, to_minutes, to_month
    from churnlens.functions.sql import register_sql_functions

    register_sql_functions(spark)
    df = spark.createDataFrame([(v,) for v in (0, 1, 90_000_000, 1706745599999, 1717000000123)], "ms long")
    a = df.selectExpr("to_days(ms)", "to_minutes(ms)", "to_hour(ms)", "to_month(ms)", "to_day(ms)").collect()
    b = df.select(to_days("ms"), to_minutes("ms"), to_hour("ms"), to_month("ms"), to_day("ms")).collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b]
    plan = df.selectExpr("to_days(ms)")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_command_line_jobs(spark):
    from churnlens.__main__ import main

    root = scratch_path(spark, "cli")
    log = write_event_log_json(raw(spark, "/root/testdata/sf0.001"), f"{root}/raw")
    assert main(["clean", "-i", log, "-o", f"{root}/cleaned"]) == 0
    assert main(["clean", "-i", log, "-o", f"{root}/cleaned", "--mode", "overwrite"]) == 0  # rerun
    assert main(["features", "-i", f"{root}/cleaned", "-t", f"{root}/train", "-v", f"{root}/val"]) == 0
    assert main(["train", "-a", "nb", "-i", f"{root}/train", "-o", f"{root}/models/nb"]) == 0
    assert main(["evaluate", "-i", f"{root}/val", "-m", f"{root}/models/nb"]) == 0
    assert main(["compare", "-m", f"nb={root}/models/nb"]) == 0
    assert read_parquet(spark, f"{root}/cleaned").count() == 865


def test_exploration_job_writes_every_comparison(spark):
    from churnlens.__main__ import main
    from churnlens.plans.registry import cleaned
    from churnlens.sources import write_parquet

    root = scratch_path(spark, "explore")
    write_parquet(cleaned(spark, "/root/testdata/sf0.01"), f"{root}/cleaned")
    assert main(["explore", "-i", f"{root}/cleaned", "-o", f"{root}/out"]) == 0
    shares = read_parquet(spark, f"{root}/out/hour_share_loyal")
    assert shares.count() == 24
    assert read_parquet(spark, f"{root}/out/hist_lifetime").agg(F.sum("cnt")).first()[0] == 141


def test_training_job_scores_are_read_back(spark):
    """The job runs as shipped: cross-validated, its fold scores beside the model."""
    from churnlens.plans.registry import QUERIES

    got = QUERIES["training_job_scores"](spark, "/root/testdata/sf0.001").collect()
    assert [r.param_map for r in got] == list(range(len(got))) and got
    assert all(0 < r.f1_mean <= 1 and r.f1_std >= 0 for r in got)


def test_loyal_events_all_has_every_column(spark):
    from churnlens.plans.registry import QUERIES, cleaned

    assert set(QUERIES["loyal_events_all"](spark, "/root/testdata/sf0.001").columns) == set(cleaned(spark, "/root/testdata/sf0.001").columns)
