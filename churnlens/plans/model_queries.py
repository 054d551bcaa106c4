"""Registered queries of the models beyond their flags, with their SQL."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from churnlens.operators import search as S
from churnlens.operators.certificate import certificate
from churnlens.operators.forest import forest_nodes, walk_forest
from churnlens.operators.joins import materialize
from churnlens.operators.ml import train
from churnlens.operators.scoring import train_scorer
from churnlens.operators.split import split_column
from churnlens.plans.compare import compare_models
from churnlens.plans.evaluate_job import evaluate
from churnlens.plans.feature_job import weighted_split
from churnlens.plans.oracle import FEATS, PAGE_COLS, SCALARS, SPLIT, _long_features, _naive_bayes, _nb_cross_validation, w
from churnlens.plans.registry import features, q_churn_model, raw, rounded
from churnlens.session import scratch_path
from churnlens.sources import load_model, save_model, write_metrics

#: A fitted point's residual (relative to that of zero weights) is below this.
OPTIMAL = 1e-3


def _parts(spark, sf):
    return [materialize(x, "model-part") for x in weighted_split(features(spark, sf))]


def q_model_scores(spark, sf):
    """All four scores of all four algorithms, as evaluated on the validation split."""
    train_df, validation = _parts(spark, sf)
    paths = {}
    for algo in ("svm", "lr", "nb", "rf"):
        path = save_model(train(train_df, algo, cross_validate=False), scratch_path(spark, f"scored-{algo}"))
        write_metrics(evaluate(load_model(path), validation, path), path)
        paths[algo] = path
    return rounded(compare_models(spark, paths))


def q_optimality(spark, sf):
    """For the two linear models: whether the fitted point is optimal, and whether a point
    with weights one percent larger is seen not to be."""
    train_df, _ = _parts(spark, sf)
    rows = []
    for algo in ("lr", "svm"):
        model = train(train_df, algo, cross_validate=False)
        clf = model.stages[-1]
        x = materialize(PipelineModel(model.stages[:2]).transform(train_df).select("features_scaled", "churn", "weightCol"), "vectors")
        here = certificate(x, algo, clf.coefficients, clf.intercept)
        off = certificate(x, algo, [c * 1.01 for c in clf.coefficients], clf.intercept)
        history = (clf.summary if algo == "lr" else clf.summary()).objectiveHistory
        rows.append((algo, here["rows"], here["residual"] < OPTIMAL, abs(here["objective"] - history[-1]) <= 1e-6 * max(1.0, history[-1]),
                     off["residual"] > here["residual"] and off["objective"] > here["objective"]))
    return spark.createDataFrame(rows, "algo string, rows long, optimal boolean, objective_agrees boolean, perturbed_fails boolean")


def q_forest_walk(spark, sf):
    """The saved forest walked as a table of nodes: per scored user, whether class and
    probabilities equal the model's own."""
    train_df, validation = _parts(spark, sf)
    model = train(train_df, "rf", cross_validate=False)
    path = save_model(model, scratch_path(spark, "forest"))
    scored = materialize(model.transform(validation).select("userId", "churn", "features_scaled", "probability", "prediction"), "scored")
    walked = walk_forest(scored, forest_nodes(spark, path)).withColumnsRenamed({"probability": "__p", "prediction": "__c"})
    near = F.forall(F.zip_with(vector_to_array("probability"), "__p", lambda a, b: F.abs(a - b) < 1e-9), lambda x: x)
    return scored.join(walked, "userId").select("userId", "churn", (F.col("prediction") == F.col("__c")).alias("same_class"),
                                                near.alias("same_probability"))


def q_score_raw_log(spark, sf):
    """A saved and reloaded naive Bayes scores the validation users' raw log by itself; a quarter of
    them with a system that training never saw."""
    train_df, _ = _parts(spark, sf)
    scorer = load_model(save_model(train_scorer(train_df, "nb", cross_validate=False), scratch_path(spark, "scorer")))
    log = raw(spark, sf).filter(split_column() == "validation").filter("userId <> ''")
    odd = log.withColumn("userAgent", F.when(F.col("userId").cast("int") % 4 == 0, "x (BeOS 5)").otherwise(F.col("userAgent")))
    return scorer.transform(odd).select("userId", "churn", "prediction")


def q_grid_search_nb(spark, sf):
    """Naive Bayes over a wider grid: mean and spread of the folds' F1 for three smoothings."""
    train_df, _ = _parts(spark, sf)
    grid = [{"modelType": "multinomial", "smoothing": s} for s in (0.5, 1.0, 2.0)]
    found = S.search(train_df, "nb", grid)
    rows = [(i, float(m), float(d)) for i, (m, d) in enumerate(zip(found.means, found.spreads))]
    return rounded(spark.createDataFrame(rows, "param_map int, f1_mean double, f1_std double"))


def q_concurrent_training(spark, sf):
    """All four algorithms cross-validated at the same time: their folds' scores."""
    train_df, _ = _parts(spark, sf)
    found = S.train_all(train_df, ("svm", "nb", "lr", "rf"))
    rows = [(a, i, float(m), float(d)) for a, x in found.items() for i, (m, d) in enumerate(zip(x.means, x.spreads))]
    return rounded(spark.createDataFrame(rows, "algo string, param_map int, f1_mean double, f1_std double"))


QUERIES = {
    "predictions_svm": q_churn_model("svm"),
    "predictions_lr": q_churn_model("lr"),
    "predictions_rf": q_churn_model("rf"),
    "model_scores": q_model_scores,
    "optimality": q_optimality,
    "forest_walk": q_forest_walk,
    "score_raw_log": q_score_raw_log,
    "grid_search_nb": q_grid_search_nb,
    "concurrent_training": q_concurrent_training,
}


def _raw_log_sql() -> str:
    """Naive Bayes with the systems of the train split as categories, all of them with an entry
    of their own; the scored users' unseen system has none."""
    n = len(SCALARS)
    parts = [f"SELECT userId, {i} AS idx, CAST({c} AS DOUBLE) AS value FROM ok" for i, c in enumerate(SCALARS)]
    parts.append(f"SELECT userId, CAST({n} + ind AS INTEGER), 1.0 FROM ok JOIN tsys ON tsys.s = ok.pref_user_system")
    parts += [f"SELECT userId, CAST({n} + ksys.k + {j} AS INTEGER), CAST({c} AS DOUBLE) FROM ok, ksys" for j, c in enumerate(PAGE_COLS)]
    mine = f"""fx AS (SELECT * REPLACE (CASE WHEN {SPLIT} = 'validation' AND CAST(userId AS INTEGER) % 4 = 0 THEN 'BeOS 5'
                                        ELSE pref_user_system END AS pref_user_system) FROM feats),
tsys AS (SELECT pref_user_system AS s, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, pref_user_system) - 1 AS ind
         FROM fx WHERE {SPLIT} = 'train' GROUP BY pref_user_system),
ksys AS (SELECT COUNT(*) AS k FROM tsys),
ok AS (SELECT * FROM fx WHERE {' AND '.join(f'{c} IS NOT NULL' for c in SCALARS + PAGE_COLS)}),
long_f AS ({' UNION ALL '.join(parts)})"""
    sql = _naive_bayes()
    dims = f"dims AS (SELECT {n} + k - 1 + {len(PAGE_COLS)} AS d FROM nsys)"
    if _long_features() not in sql or dims not in sql:
        raise AssertionError("the SQL of naive Bayes has changed")
    return sql.replace(_long_features(), mine).replace(dims, f"dims AS (SELECT {n} + k + {len(PAGE_COLS)} AS d FROM ksys)")


def _grid_sql(smoothings: tuple[float, ...]) -> str:
    out = []
    for i, s in enumerate(smoothings):
        sql = _nb_cross_validation()
        for old, new in (("CAST('0x' || substr(md5('fold:' || ok.userId), 1, 8) AS BIGINT)",
                          "CAST('0x' || substr(md5('fold 42:' || ok.userId), 1, 12) AS BIGINT)"),
                         ("+ 1.0)", f"+ {s}::DOUBLE)"), ("nlab * 1.0", f"nlab * {s}::DOUBLE"), ("tot.t + dims.d", f"tot.t + {s}::DOUBLE * dims.d")):
            if old not in sql:
                raise AssertionError("the SQL of the cross-validation has changed")
            sql = sql.replace(old, new)
        out.append(f"SELECT CAST({i} AS INTEGER) AS param_map, * FROM ({sql})")
    return " UNION ALL ".join(out)


SQL = {
    "optimality": w(FEATS, _long_features()) + f"""SELECT algo, n AS rows, TRUE AS optimal, TRUE AS objective_agrees, TRUE AS perturbed_fails
      FROM (SELECT unnest(['lr', 'svm']) AS algo), (SELECT COUNT(*) AS n FROM ok WHERE {SPLIT} = 'train')""",
    "forest_walk": w(FEATS, _long_features()) + f"""SELECT userId, churn, TRUE AS same_class, TRUE AS same_probability
      FROM ok WHERE {SPLIT} = 'validation'""",
    "score_raw_log": _raw_log_sql(),
    "grid_search_nb": _grid_sql((0.5, 1.0, 2.0)),
    "training_job_scores": _grid_sql((1.0,)),
}
