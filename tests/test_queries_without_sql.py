"""Registered queries whose values SQL cannot know, tested against each other and by other means."""

import duckdb
import pytest
from pyspark.sql import functions as F

from churnlens.operators.metrics import weighted_metrics
from churnlens.operators.quantiles import RANK_ERROR
from churnlens.plans.all_queries import ORACLE, QUERIES
from churnlens.plans.feature_job import weighted_split
from churnlens.plans.oracle import ORACLE as CORE
from churnlens.plans.registry import features

from .conftest import SF001, SF01


def test_which_queries_have_no_sql():
    assert set(QUERIES) - set(ORACLE) == {"predictions_svm", "predictions_lr", "predictions_rf", "model_scores",
                                          "concurrent_training", "quartiles"}
    assert set(ORACLE) <= set(QUERIES) and set(CORE) <= set(QUERIES)


def test_scores_follow_from_the_predictions(spark):
    scores = {(r["Algorithm"], r["Metric"]): r["Score"] for r in QUERIES["model_scores"](spark, SF01).collect()}
    assert len(scores) == 16 and all(0 <= s <= 1 for s in scores.values())
    validation = weighted_split(features(spark, SF01))[1].select("userId", "weightCol")
    for algo in ("lr", "rf"):
        predicted = QUERIES[f"predictions_{algo}"](spark, SF01)
        assert predicted.filter(~F.col("prediction").isin(0.0, 1.0)).count() == 0
        m = weighted_metrics(predicted.join(validation, "userId")).first()
        for name in ("Recall", "Precision", "Accuracy", "F1"):
            assert m[name.lower()] == pytest.approx(scores[algo, name], abs=1e-6)


def test_concurrent_scores_equal_the_grid_search(spark):
    at_once = {r["algo"]: r for r in QUERIES["concurrent_training"](spark, SF001).collect()}
    assert set(at_once) == {"svm", "nb", "lr", "rf"}
    alone = QUERIES["grid_search_nb"](spark, SF001).filter("param_map = 1").first()
    assert (at_once["nb"]["f1_mean"], at_once["nb"]["f1_std"]) == pytest.approx((alone["f1_mean"], alone["f1_std"]), abs=1e-6)


def test_quartiles_are_near_the_exact_ones(spark):
    con = duckdb.connect()
    n = con.execute(f"SELECT count(*) FROM '{SF01}/events.parquet'").fetchone()[0]
    rows = {r["column"]: r for r in QUERIES["quartiles"](spark, SF01).collect()}
    assert set(rows) == {"length", "itemInSession", "ts", "sessionId"} and rows["ts"]["n"] == n
    for share, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75")):
        below, upto = con.execute(f"SELECT avg((event_id % 97 < {rows['itemInSession'][name]})::INT), avg((event_id % 97 <= {rows['itemInSession'][name]})::INT) "
                                  f"FROM '{SF01}/events.parquet'").fetchone()
        assert below - RANK_ERROR <= share <= upto + RANK_ERROR
