"""Forests as tables, certificates, scoring from a raw log, parameter search."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from churnlens.operators import certificate as K
from churnlens.operators import forest as T
from churnlens.operators import search as S
from churnlens.operators.joins import materialize
from churnlens.operators.ml import train, training_pipeline, train_with_scores
from churnlens.operators.scoring import UserFeatures, train_scorer
from churnlens.plans.feature_job import weighted_split
from churnlens.plans.registry import cleaned, features, raw
from churnlens.session import scratch_path
from churnlens.sources import load_model, save_model

from .conftest import SF01


@pytest.fixture(scope="module")
def parts(spark):
    return [materialize(x, "part") for x in weighted_split(features(spark, SF01))]


@pytest.fixture(scope="module")
def forest(spark, parts):
    model = train(parts[0], "rf", cross_validate=False)
    path = save_model(model, scratch_path(spark, "rf"))
    scored = materialize(model.transform(parts[0].unionByName(parts[1])).select(
        "userId", "features_scaled", "probability", "prediction"), "scored")
    return model, path, scored


def test_walk_equals_transform_for_every_user(spark, forest):
    model, path, scored = forest
    nodes = T.forest_nodes(spark, path)
    assert nodes.select("tree").distinct().count() == 20
    walked = {r["userId"]: r for r in T.walk_forest(scored, nodes).collect()}
    rows = scored.collect()
    assert len(rows) == len(walked) > 100
    for r in rows:
        assert walked[r["userId"]]["prediction"] == r["prediction"]
        assert np.allclose(walked[r["userId"]]["probability"], r["probability"].toArray(), atol=1e-12)
    importances = {r["feature"]: r["importance"] for r in T.feature_importances(nodes).collect()}
    theirs = model.stages[-1].featureImportances
    assert np.allclose([importances.get(i, 0) for i in range(theirs.size)], theirs.toArray(), atol=1e-9)


def test_sql_replays_the_walk(spark, forest):
    _, path, scored = forest
    con = duckdb.connect()
    con.register("n", T.forest_nodes(spark, path).select("tree", "node", "feature", "threshold", "left", "right", "share").toPandas())
    con.register("u", scored.select("userId", vector_to_array("features_scaled").alias("x"), "prediction").toPandas())
    wrong = con.execute("""
WITH RECURSIVE walk AS (SELECT userId, x, tree, 0 AS node FROM u, (SELECT DISTINCT tree FROM n) UNION ALL
  SELECT w.userId, w.x, w.tree, CASE WHEN w.x[n.feature + 1] <= n.threshold THEN n."left" ELSE n."right" END
  FROM walk w JOIN n ON n.tree = w.tree AND n.node = w.node AND n.feature >= 0),
votes AS (SELECT userId, sum(share[1]) AS a, sum(share[2]) AS b FROM walk w JOIN n ON n.tree = w.tree AND n.node = w.node AND n.feature < 0 GROUP BY userId)
SELECT count(*), count(*) FILTER (prediction <> CASE WHEN b > a THEN 1.0 ELSE 0.0 END) FROM votes JOIN u USING (userId)""").fetchone()
    assert wrong[0] == scored.count() and wrong[1] == 0


def test_walk_with_large_node_tables_and_categories(spark, forest):
    _, path, scored = forest
    nodes = T.forest_nodes(spark, path)
    spark.conf.set("spark.churnlens.maxBroadcastRows", "10")  # salted joins instead of a broadcast
    try:
        walked = T.walk_forest(scored.limit(20), nodes).count()
    finally:
        spark.conf.unset("spark.churnlens.maxBroadcastRows")
    assert walked == 20
    made = spark.createDataFrame(
        [(0, 0, 1, None, [0.0, 2.0], 1, 2, [3.0, 1.0], None), (0, 1, -1, None, None, -1, -1, [3.0, 0.0], [1.0, 0.0]),
         (0, 2, -1, None, None, -1, -1, [0.0, 1.0], [0.0, 1.0])],
        "tree int, node int, feature int, threshold double, categories array<double>, left int, right int, stats array<double>, share array<double>")
    users = spark.createDataFrame([(str(i), Vectors.dense([9.0, float(i)])) for i in range(4)], ["userId", "features_scaled"])
    assert {r["userId"]: r["prediction"] for r in T.walk_forest(users, made).collect()} == {"0": 0.0, "1": 1.0, "2": 0.0, "3": 1.0}


def scaled(model, df):
    return materialize(PipelineModel(model.stages[:2]).transform(df).select("features_scaled", "churn", "weightCol"), "x")


@pytest.mark.parametrize("algo", ["lr", "svm"])
def test_fitted_points_are_optimal_and_perturbed_ones_are_not(parts, algo):
    model = train(parts[0], algo, cross_validate=False)
    x, clf = scaled(model, parts[0]), model.stages[-1]
    fit = K.certificate(x, algo, clf.coefficients, clf.intercept)
    assert fit["residual"] < 1e-3 and fit["rows"] == x.count()
    history = clf.summary.objectiveHistory if algo == "lr" else clf.summary().objectiveHistory
    assert math.isclose(fit["objective"], history[-1], rel_tol=1e-6)
    for factor in (1.01, 0.9):
        other = K.certificate(x, algo, [c * factor for c in clf.coefficients], clf.intercept)
        assert other["residual"] > 1e-2 and other["objective"] > fit["objective"]
    with pytest.raises(ValueError):
        K.certificate(x, "nb", clf.coefficients, 0.0)


def test_certificate_against_numpy(spark):
    r = np.random.default_rng(4)
    x, y, w = r.normal(size=(200, 3)), r.integers(0, 2, 200), r.uniform(0.1, 2, 200)
    df = spark.createDataFrame([(Vectors.dense(a), int(b), float(c)) for a, b, c in zip(x, y, w)], ["features_scaled", "churn", "weightCol"])
    c, b = np.array([0.3, -0.2, 0.1]), 0.05

    def gradient(c, b, kind):
        s = np.where(y > 0, 1, -1)
        z = s * (x @ c + b)
        p = w / (1 + np.exp(z)) if kind == "lr" else w * (z <= 1)
        g = np.append((-s * p) @ x, (-s * p).sum()) / w.sum()
        mean = (w @ x) / w.sum()
        std = np.sqrt((w @ (x - mean) ** 2) / (w.sum() - (w ** 2).sum() / w.sum()))
        return np.abs(g * np.append(1 / std, 1)).max()
    for kind in ("lr", "svm"):
        got = K.certificate(df, kind, c, b, edge=0.0)
        assert math.isclose(got["residual"], gradient(c, b, kind) / gradient(c * 0, 0, kind), rel_tol=1e-6)


def test_reloaded_model_scores_a_raw_log(spark, parts):
    scorer = train_scorer(parts[0], "nb", cross_validate=False)
    again = load_model(save_model(scorer, scratch_path(spark, "scorer")))
    assert isinstance(again.stages[0], UserFeatures) and again.stages[0].getOrDefault("rawLog") is True
    log = raw(spark, SF01)
    odd = log.withColumn("userAgent", F.when(F.col("userId").cast("int") % 4 == 0, "x (BeOS 5)").otherwise(F.col("userAgent")))
    got = {r["userId"]: r["prediction"] for r in again.transform(odd).collect()}
    want = {r["userId"]: r["prediction"] for r in scorer.transform(odd).collect()}
    assert got == want and len(got) > 100
    plain = PipelineModel([UserFeatures(rawLog=False), *scorer.stages[1:]]).transform(cleaned(spark, SF01))
    assert {r["userId"]: r["prediction"] for r in plain.collect()} == {
        r["userId"]: r["prediction"] for r in scorer.transform(log).collect()}


def test_scoring_job_from_a_raw_json_log(spark, parts):
    from churnlens.plans.score_job import run_scorer_training, run_scoring
    from churnlens.sources import write_event_log_json, write_parquet

    root = scratch_path(spark, "score")
    write_parquet(parts[0], f"{root}/train")
    write_event_log_json(raw(spark, SF01), f"{root}/log")
    run_scorer_training(spark, "lr", f"{root}/train", f"{root}/model", cross_validate=False)
    out = spark.read.parquet(run_scoring(spark, f"{root}/log", f"{root}/model", f"{root}/scores"))
    assert out.columns == ["userId", "churn", "prediction", "score"] and out.count() > 100
    assert out.filter((F.col("score") > 0.5) != (F.col("prediction") == 1.0)).count() == 0


def test_search_job_saves_models_and_scores(spark, parts):
    from churnlens.plans.train_job import run_search
    from churnlens.sources import read_fold_scores, write_parquet

    root = scratch_path(spark, "search")
    write_parquet(parts[0], f"{root}/train")
    found = run_search(spark, f"{root}/train", f"{root}/models", ("nb",), grids={"nb": S.WIDE_GRIDS["nb"]})
    scores = read_fold_scores(spark, f"{root}/models/nb").orderBy("param_map").collect()
    assert [r["f1_mean"] for r in scores] == pytest.approx(found["nb"].means) and len(scores) == 6
    assert load_model(f"{root}/models/nb").transform(parts[1]).count() == found["nb"].model.transform(parts[1]).count()


def test_search_equals_the_cross_validator(spark, parts):
    folded = materialize(S.with_folds(parts[0]), "folded")
    for algo in ("nb", "lr"):
        theirs = train_with_scores(folded, algo, fold_col="fold")
        ours = S.search(folded, algo)
        assert np.allclose(ours.means, theirs.avgMetrics, atol=1e-9) and np.allclose(ours.spreads, theirs.stdMetrics, atol=1e-9)
        a, b = (m.transform(parts[1]).select("userId", "prediction").collect() for m in (ours.model, theirs.bestModel))
        assert dict(map(tuple, a)) == dict(map(tuple, b))


def test_concurrent_training_gives_the_sequential_scores(parts):
    grids = {"nb": S.WIDE_GRIDS["nb"], "lr": S.WIDE_GRIDS["lr"][:2]}
    at_once = S.train_all(parts[0], ("nb", "lr"), grids)
    in_turn = S.train_all(parts[0], ("nb", "lr"), grids, concurrent=False)
    for algo in grids:
        assert np.allclose(at_once[algo].means, in_turn[algo].means, atol=1e-9)
        assert at_once[algo].best == in_turn[algo].best and len(at_once[algo].means) == len(grids[algo])
        assert at_once[algo].means[at_once[algo].best] == max(at_once[algo].means)


def test_feature_selection(spark, parts, forest):
    _, path, _ = forest
    importances = T.feature_importances(T.forest_nodes(spark, path))
    systems = parts[0].select("pref_user_system_ohe").first()[0].size
    kept = S.select_features(importances, sizes={"pref_user_system_ohe": systems}, least=0.03)
    assert 0 < len(kept) < 24
    fitted = S.search(parts[0], "lr", cols=kept)
    assert fitted.model.transform(parts[1]).count() > 0
    assert S.select_features(importances, ["a", "b"], sizes={"a": 10_000}, least=0.5) == ["a"]
    assert training_pipeline("lr", kept)[0].getStages()[0].getInputCols() == kept
