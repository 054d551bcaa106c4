"""The two end-to-end workflows: preprocessing, then train + evaluate per model.

With a ledger (a path for its table) a workflow is resumable: see ``plans.ledger``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnlens.operators.ml import ALGORITHMS
from churnlens.plans.clean_job import run_clean
from churnlens.plans.compare import compare_models
from churnlens.plans.evaluate_job import run_evaluation
from churnlens.plans.feature_job import run_features
from churnlens.plans.ledger import Step, run_steps
from churnlens.plans.train_job import run_training
from churnlens.sources.sinks import metrics_path


def preprocess_steps(raw_path: str, cleaned_path: str, train_path: str, validation_path: str, *,
                     fmt: str = "json", mode: str = "errorifexists") -> list[Step]:
    return [
        Step("clean", lambda spark: run_clean(spark, raw_path, cleaned_path, fmt=fmt, mode=mode),
             [raw_path], [cleaned_path], {"fmt": fmt}),
        Step("features", lambda spark: run_features(spark, cleaned_path, train_path, validation_path, mode=mode),
             [cleaned_path], [train_path, validation_path]),
    ]


def preprocess(spark: SparkSession, raw_path: str, cleaned_path: str, train_path: str,
               validation_path: str, *, fmt: str = "json", mode: str = "errorifexists",
               ledger: str | None = None, until: str | None = None) -> list[tuple[str, str, float]]:
    """Clean, then build features (two jobs, parquet hand-off between them).

    Without a ledger every step runs; with one, those that are not done yet, to the step ``until``."""
    steps = preprocess_steps(raw_path, cleaned_path, train_path, validation_path, fmt=fmt, mode=mode)
    return _run(spark, steps, ledger, until)


def training_steps(train_path: str, validation_path: str, model_root: str,
                   algos: tuple[str, ...] = ALGORITHMS, *, cross_validate: bool = True) -> list[Step]:
    """For each algorithm a step that trains and one that evaluates."""
    steps = []
    for algo in algos:
        path = f"{model_root.rstrip('/')}/{algo}"
        model = [f"{path}/metadata", f"{path}/stages"]
        scores = [f"{path}/fold_scores.json"] if cross_validate else []
        steps += [
            Step(f"train {algo}", lambda spark, a=algo, p=path: run_training(spark, a, train_path, p, cross_validate=cross_validate),
                 [train_path], model + scores, {"cross_validate": cross_validate}),
            Step(f"evaluate {algo}", lambda spark, p=path: run_evaluation(spark, validation_path, p),
                 [validation_path, *model], [metrics_path(path)]),
        ]
    return steps


def train_and_evaluate(spark: SparkSession, train_path: str, validation_path: str,
                       model_root: str, algos: tuple[str, ...] = ALGORITHMS, *, cross_validate: bool = True,
                       ledger: str | None = None, until: str | None = None) -> DataFrame | None:
    """Train and evaluate each algorithm in turn; return the comparison table (None when
    stopped at the step ``until``)."""
    steps = training_steps(train_path, validation_path, model_root, algos, cross_validate=cross_validate)
    _run(spark, steps, ledger, until)
    if until is not None and until != steps[-1].name:
        return None
    return compare_models(spark, {a: f"{model_root.rstrip('/')}/{a}" for a in algos})


def _run(spark: SparkSession, steps: list[Step], ledger: str | None, until: str | None) -> list[tuple[str, str, float]]:
    if ledger:
        return run_steps(spark, steps, ledger, until=until)
    if until is not None:
        raise ValueError("only a workflow with a ledger can stop at a step and go on later")
    for step in steps:
        step.run(spark)
    return [(s.name, "ran", 0.0) for s in steps]
