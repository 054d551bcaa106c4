"""ML stages: system encoding, assembling, scaling, classifiers and training.

Everything is MLlib; fitting runs as Spark jobs over the per-user table.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    LinearSVC, LogisticRegression, NaiveBayes, RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import MaxAbsScaler, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame

from churnlens.operators.joins import materialize
from churnlens.schema import FEATURE_COLS

LABEL = "churn"
WEIGHT = "weightCol"
ALGORITHMS = ("svm", "nb", "lr", "rf")


def system_indexer(handle_invalid: str = "error") -> StringIndexer:
    """Index systems by frequency, most frequent first (ties: name ascending)."""
    return StringIndexer(inputCol="pref_user_system", outputCol="pref_user_system_ind",
                         stringOrderType="frequencyDesc", handleInvalid=handle_invalid)


def system_encoder() -> OneHotEncoder:
    """One-hot of the system index; the last category is the all-zero vector."""
    return OneHotEncoder(inputCol="pref_user_system_ind", outputCol="pref_user_system_ohe",
                         dropLast=True)


def encode_systems(features: DataFrame) -> tuple[DataFrame, PipelineModel]:
    """Fit index + one-hot on all users and apply them."""
    model = Pipeline(stages=[system_indexer(), system_encoder()]).fit(features)
    return model.transform(features), model


def assembler(cols: list[str] = FEATURE_COLS) -> VectorAssembler:
    """``features`` vector; users with any NULL feature are skipped."""
    return VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="skip")


def scaler() -> MaxAbsScaler:
    """Scale each feature by its largest absolute value into [-1, 1]."""
    return MaxAbsScaler(inputCol="features", outputCol="features_scaled")


def classifier(algo: str, seed: int = 42):
    """The classifier of one algorithm, reading ``features_scaled``, weighted."""
    common = dict(featuresCol="features_scaled", labelCol=LABEL, weightCol=WEIGHT,
                  predictionCol="prediction")
    if algo == "svm":
        return LinearSVC(**common)
    if algo == "nb":
        return NaiveBayes(**common)
    if algo == "lr":
        return LogisticRegression(**common)
    if algo == "rf":
        return RandomForestClassifier(seed=seed, **common)
    raise ValueError(f"Unknown ML algorithm {algo!r}; expected one of {ALGORITHMS}")


def param_grid(algo: str, clf) -> list:
    """The (single-map) parameter grids used for each algorithm."""
    b = ParamGridBuilder()
    if algo == "svm":
        b = b.addGrid(clf.regParam, [0.0])
    elif algo == "nb":
        b = b.addGrid(clf.modelType, ["multinomial"])
    elif algo == "rf":
        b = b.addGrid(clf.impurity, ["gini"])
    return b.build()


def training_pipeline(algo: str, cols: list[str] = FEATURE_COLS, *,
                      with_encoding: bool = False, seed: int = 42) -> tuple[Pipeline, list]:
    """assemble -> scale -> classifier (optionally led by index + one-hot).

    ``with_encoding`` puts the system indexer (unseen systems kept) and
    encoder into the pipeline, so a saved model scores raw per-user rows.
    """
    clf = classifier(algo, seed)
    stages = [assembler(cols), scaler(), clf]
    if with_encoding:
        stages = [system_indexer("keep"), system_encoder()] + stages
    return Pipeline(stages=stages), param_grid(algo, clf)


def cross_validator(pipe: Pipeline, grid: list, seed: int = 42) -> CrossValidator:
    """3-fold cross-validation on (unweighted) F1, four models fitted in parallel."""
    return CrossValidator(estimator=pipe, estimatorParamMaps=grid,
                          evaluator=MulticlassClassificationEvaluator(labelCol=LABEL, metricName="f1"),
                          numFolds=3, parallelism=4, seed=seed)


def training_layout(df: DataFrame, key: str = "userId",
                    rows_per_partition: int = 200_000) -> DataFrame:
    """Deterministic partitioning of a per-user training table.

    Hash-partitioned by ``key`` into ``ceil(rows / rows_per_partition)``
    partitions and sorted inside each, so seeded sampling (forest bootstrap,
    cross-validation folds) sees the same rows in the same order however the
    input was written — and a partition recomputed after an executor loss is
    identical. The partition count follows the data, so iterative solvers run
    few, well-filled tasks per iteration instead of one per shuffle partition.
    """
    if key not in df.columns:
        return df
    n = max(1, -(-df.count() // rows_per_partition))
    return materialize(df.repartition(n, key).sortWithinPartitions(key), "training-layout")


def train_with_scores(df: DataFrame, algo: str, *, with_encoding: bool = False, seed: int = 42,
                      fold_col: str | None = None) -> CrossValidatorModel:
    """Cross-validate one algorithm: the best model (refitted on all rows), with the mean and
    the spread of the folds' scores of every parameter map in ``avgMetrics`` and ``stdMetrics``."""
    pipe, grid = training_pipeline(algo, with_encoding=with_encoding, seed=seed)
    cv = cross_validator(pipe, grid, seed)
    return (cv.setFoldCol(fold_col) if fold_col else cv).fit(training_layout(df))


def train(df: DataFrame, algo: str, *, cross_validate: bool = True,
          with_encoding: bool = False, seed: int = 42) -> PipelineModel:
    """Fit one algorithm and return the best pipeline model.

    By default through 3-fold cross-validation; ``cross_validate=False`` fits
    the first parameter map on all rows, which gives the same model for the
    single-map grids here. The input is first given a deterministic layout
    (``training_layout``), written once, as every fit reads it many times.
    """
    if cross_validate:
        return train_with_scores(df, algo, with_encoding=with_encoding, seed=seed).bestModel
    pipe, grid = training_pipeline(algo, with_encoding=with_encoding, seed=seed)
    return pipe.fit(training_layout(df), grid[0] if grid else {})
