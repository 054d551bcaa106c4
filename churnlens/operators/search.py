"""Parameter search and feature selection.

``search`` cross-validates any grid of one algorithm. Assembling and scaling do not depend on the
classifier's parameters, so they are fitted once per fold and every classifier of the fold
trains on the written vectors. The folds come from a hash of the user, the same for every
algorithm and partitioning. ``train_all`` runs several algorithms at a time, each in a
scheduler pool of its own: with ``spark.scheduler.mode=FAIR`` (see ``session.FAIR_CONF``) the
short jobs of one do not wait behind another's.

``select_features`` drops the feature columns that a fitted forest finds unimportant.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.operators.joins import materialize
from churnlens.operators.ml import ALGORITHMS, LABEL, WEIGHT, assembler, classifier, param_grid, scaler, training_layout
from churnlens.schema import FEATURE_COLS
from churnlens.session import carried

FOLD = "fold"
#: Wider grids than the single-map ones of the training job.
WIDE_GRIDS: dict[str, list[dict[str, object]]] = {
    "svm": [{"regParam": r} for r in (0.0, 0.01, 0.1)],
    "lr": [{"regParam": r, "elasticNetParam": e} for r in (0.0, 0.01, 0.1) for e in (0.0, 1.0)],
    "nb": [{"modelType": m, "smoothing": s} for m in ("multinomial", "complement") for s in (0.5, 1.0, 2.0)],
    "rf": [{"maxDepth": d, "numTrees": n} for d in (3, 5) for n in (20, 40)],
}


@dataclass
class Searched:
    """The best model and the folds' scores of every parameter map, in the grid's order."""
    model: PipelineModel
    grid: list[dict[str, object]]
    means: list[float]
    spreads: list[float]

    @property
    def best(self) -> int:
        return int(np.argmax(self.means))


def with_folds(df: DataFrame, folds: int = 3, seed: int = 42, key: str = "userId") -> DataFrame:
    """A column ``fold`` from a hash of the seed and the user."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"fold {seed}:"), F.col(key).cast("string"))), 1, 12), 16, 10).cast("long")
    return df.withColumn(FOLD, (F.coalesce(h, F.lit(0)) % folds).cast("int"))


def single_map(algo: str) -> list[dict[str, object]]:
    """The training job's grid as plain maps."""
    clf = classifier(algo)
    return [{p.name: v for p, v in m.items()} for m in param_grid(algo, clf)] or [{}]


def search(df: DataFrame, algo: str, grid: Sequence[dict[str, object]] | None = None, *, cols: list[str] = FEATURE_COLS,
           folds: int = 3, seed: int = 42, parallelism: int = 4) -> Searched:
    """Cross-validate ``grid`` (parameter names to values) by F1 and refit the best on all rows.

    ``df`` holds encoded, weighted per-user rows; a column ``fold`` is used when present."""
    grid = list(grid if grid is not None else single_map(algo))
    rows = training_layout(df if FOLD in df.columns else with_folds(df, folds, seed))
    folds = (rows.agg(F.max(FOLD)).first()[0] or 0) + 1
    score = MulticlassClassificationEvaluator(labelCol=LABEL, metricName="f1")
    keep = ["features_scaled", LABEL, WEIGHT]

    def prepared(k: int) -> tuple[DataFrame, DataFrame]:
        fit, held = rows.filter(F.col(FOLD) != k), rows.filter(F.col(FOLD) == k)
        prepare = Pipeline(stages=[assembler(cols), scaler()]).fit(fit)
        return (materialize(prepare.transform(fit).select(*keep), "fold-fit"),
                materialize(prepare.transform(held).select(*keep), "fold-held"))

    def one(task: tuple[int, dict[str, object]]) -> float:
        fit, held = vectors[task[0]]
        return score.evaluate(_classifier(algo, seed, task[1]).fit(fit).transform(held))

    spark = df.sparkSession
    with ThreadPoolExecutor(parallelism) as pool:  # the target carries the job group and pool of this thread
        vectors = list(pool.map(carried(spark, prepared), range(folds)))
        scores = np.array(list(pool.map(carried(spark, one), [(k, g) for k in range(folds) for g in grid])))
    scores = scores.reshape(folds, len(grid))
    means, spreads = scores.mean(axis=0).tolist(), scores.std(axis=0).tolist()
    clf = _classifier(algo, seed, grid[int(np.argmax(means))])
    return Searched(Pipeline(stages=[assembler(cols), scaler(), clf]).fit(rows.drop(FOLD)), grid, means, spreads)


def _classifier(algo: str, seed: int, values: dict[str, object]):
    clf = classifier(algo, seed)
    return clf.copy({clf.getParam(name): value for name, value in values.items()})


def train_all(df: DataFrame, algos: Sequence[str] = ALGORITHMS, grids: dict[str, list[dict[str, object]]] | None = None, *,
              concurrent: bool = True, **options) -> dict[str, Searched]:
    """``search`` for several algorithms, at the same time unless ``concurrent`` is off."""
    sc = df.sparkSession.sparkContext
    rows = df if FOLD in df.columns else with_folds(df, options.get("folds", 3), options.get("seed", 42))
    rows = training_layout(rows)  # once for all

    def one(algo: str) -> Searched:
        before = sc.getLocalProperty("spark.scheduler.pool")
        sc.setLocalProperty("spark.scheduler.pool", f"train-{algo}")
        try:
            return search(rows, algo, (grids or {}).get(algo), **options)
        finally:
            sc.setLocalProperty("spark.scheduler.pool", before)
    if not concurrent:
        return {a: one(a) for a in algos}
    with ThreadPoolExecutor(max(1, len(algos))) as pool:
        return dict(zip(algos, pool.map(carried(df.sparkSession, one), algos)))


def select_features(importances: DataFrame, cols: Sequence[str] = FEATURE_COLS, *, sizes: dict[str, int] | None = None,
                    least: float = 0.01) -> list[str]:
    """The columns of ``cols`` whose importance (summed over a vector column's entries, given by
    ``sizes``) is at least ``least``. ``importances`` has feature (index) and importance, a row per
    feature at most."""
    by_index = {r["feature"]: r["importance"] for r in importances.collect()}
    kept, at = [], 0
    for c in cols:
        n = (sizes or {}).get(c, 1)
        if sum(by_index.get(i, 0.0) for i in range(at, at + n)) >= least:
            kept.append(c)
        at += n
    return kept
