"""Training job: weighted train table -> saved pipeline model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from churnlens.operators.ml import ALGORITHMS, train, train_with_scores
from churnlens.operators.search import FOLD, Searched, train_all, with_folds
from churnlens.session import scratch
from churnlens.sources import read_parquet, save_model, write_fold_scores


def run_training(spark: SparkSession, algo: str, train_path: str, model_path: str, *,
                 cross_validate: bool = True) -> PipelineModel | dict[str, PipelineModel]:
    """Train one algorithm ('svm', 'nb', 'lr', 'rf') and save the best model.

    The folds' mean score and spread are written next to the model.
    ``algo='all'`` trains the four in turn, saved below ``model_path/<algo>``;
    ``run_search`` trains several at a time, over any grids.
    """
    if algo == "all":
        return {a: run_training(spark, a, train_path, f"{model_path.rstrip('/')}/{a}",
                                cross_validate=cross_validate) for a in ALGORITHMS}
    if algo not in ALGORITHMS:
        raise ValueError(f"Unknown ML algorithm {algo!r}; expected one of {ALGORITHMS} or 'all'")
    with scratch(spark):
        return _fit_and_save(spark, algo, train_path, model_path, cross_validate)


def _fit_and_save(spark: SparkSession, algo: str, train_path: str, model_path: str,
                  cross_validate: bool) -> PipelineModel:
    if cross_validate:
        # folds from a hash of the user: the same ones whatever the partitioning
        fitted = train_with_scores(with_folds(read_parquet(spark, train_path)), algo, fold_col=FOLD)
        model, scores = fitted.bestModel, (fitted.avgMetrics, fitted.stdMetrics)
    else:
        model, scores = train(read_parquet(spark, train_path), algo, cross_validate=False), None
    save_model(model, model_path)
    if scores:
        write_fold_scores(spark, model_path, *scores)
    return model


def run_search(spark: SparkSession, train_path: str, model_root: str, algos: tuple[str, ...] = ALGORITHMS, *,
               grids: dict[str, list[dict[str, object]]] | None = None, cols: list[str] | None = None,
               concurrent: bool = True) -> dict[str, Searched]:
    """Search each algorithm's grid (by default its single map), all at the same time, and save the
    best models below ``model_root/<algo>`` with the folds' scores of every parameter map."""
    with scratch(spark):
        found = train_all(read_parquet(spark, train_path), algos, grids, concurrent=concurrent, **({"cols": cols} if cols else {}))
        for algo, best in found.items():
            path = f"{model_root.rstrip('/')}/{algo}"
            save_model(best.model, path)
            write_fold_scores(spark, path, best.means, best.spreads)
    return found
