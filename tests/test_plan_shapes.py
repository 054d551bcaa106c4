"""Physical-plan checks: pushdown, no Python UDFs, no shuffle of raw events for the label."""

from churnlens.operators.features import user_features
from churnlens.plans.registry import cleaned, raw
from churnlens.operators.clean import clean


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_clean_broadcasts_and_never_shuffles_events(spark):
    plan = _plan(clean(raw(spark, "/root/testdata/sf0.01")))
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_features_read_log_once_and_use_no_python(spark):
    c = cleaned(spark, "/root/testdata/sf0.01")
    f = user_features(c, materialize_base=False)
    plan = _plan(f)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    materialized = _plan(user_features(c))
    # both branches read the written (user, session, page) table, not the log
    assert "events.parquet" not in materialized
    assert materialized.count("FileScan parquet") == 2


def test_page_filter_and_columns_pushed_to_parquet_scan(spark):
    from churnlens.operators.explore import cancel_level
    from churnlens.session import scratch_path
    from churnlens.sources import read_parquet, write_parquet

    path = write_parquet(cleaned(spark, "/root/testdata/sf0.001"), scratch_path(spark, "cleaned"))
    plan = _plan(cancel_level(read_parquet(spark, path)))
    assert "EqualTo(page,Cancellation Confirmation)" in plan
    assert "ReadSchema: struct<page:string,level:string,churn:bigint>" in plan
