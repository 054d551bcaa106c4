"""A model that scores users straight from an event log.

``UserFeatures`` is a pipeline stage from a log (raw, or cleaned) to one row per user, written
with the ML library's own parameter persistence, so it can stand at the head of a saved
``PipelineModel``: the loaded model takes a raw log and needs nothing else. Systems that were not
seen in training are kept and encoded as the zero vector.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from churnlens.operators import clean as C
from churnlens.operators.features import user_features
from churnlens.operators.ml import train


class UserFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Event log -> per-user features with the label. With ``rawLog`` the log is cleaned first;
    without, it must be a cleaned one."""

    rawLog = Param(Params._dummy(), "rawLog", "whether the input is a raw log, to be cleaned", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, rawLog: bool = True):
        super().__init__()
        self._setDefault(rawLog=True)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return user_features(C.clean(dataset) if self.getOrDefault(self.rawLog) else dataset)


def train_scorer(features: DataFrame, algo: str, *, cross_validate: bool = True, seed: int = 42) -> PipelineModel:
    """Fit one algorithm on weighted per-user rows (``user_features`` and a weight) and put the
    stage from the raw log in front of it."""
    known = [c for c in features.columns if c not in ("pref_user_system_ind", "pref_user_system_ohe")]
    model = train(features.select(*known), algo, cross_validate=cross_validate, with_encoding=True, seed=seed)
    return PipelineModel([UserFeatures(), *model.stages])
