"""Pipeline stages that take raw event rows to a risk probability (SNK-5).

Each stage is a Spark ML ``Transformer`` whose parameters are saved with it, so
a saved ``PipelineModel`` scores raw rows without anything else: the feature
step carries the training medians, the linear step its weights and training
statistics.  All of them are column expressions.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventsieve.config import FEATURE_COLUMNS, NUMERIC_SIGNALS
from eventsieve.functions.numeric import linear_score
from eventsieve.operators.features import engineer_features
from eventsieve.operators.scoring import LinearModel

PROBABILITY = "probability_risky"


class _Stage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    def _given(self, param: Param):
        return self.getOrDefault(param)


class EventFeatures(_Stage):
    """Raw event rows to the feature columns; the raw ``event_type`` stays.  Signals that are absent are 0."""

    medians = Param(Params._dummy(), "medians", "value of each numeric signal where a row's cannot be read", TypeConverters.toListFloat)

    def __init__(self, medians: dict[str, float] | None = None):
        super().__init__()
        self._setDefault(medians=[0.0] * len(NUMERIC_SIGNALS))
        if medians is not None:
            self._set(medians=[float(medians.get(c, 0.0)) for c in NUMERIC_SIGNALS])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        raw = dataset.withColumn("_raw_type", F.col("event_type"))
        given = dict(zip(NUMERIC_SIGNALS, self._given(self.medians), strict=True))
        return engineer_features(raw, medians=given).withColumn("event_type", F.col("_raw_type")).drop("_raw_type")


class LinearRisk(_Stage):
    """The probability of a linear model over standardised features."""

    weights = Param(Params._dummy(), "weights", "one weight a feature", TypeConverters.toListFloat)
    mean = Param(Params._dummy(), "mean", "training mean of each feature", TypeConverters.toListFloat)
    std = Param(Params._dummy(), "std", "training deviation of each feature", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "the intercept", TypeConverters.toFloat)
    features = Param(Params._dummy(), "features", "feature columns", TypeConverters.toListString)

    def __init__(self, model: LinearModel | None = None):
        super().__init__()
        if model is not None:
            self._set(weights=list(model.weights), mean=list(model.mean), std=list(model.std), intercept=model.intercept, features=list(model.features))

    def model(self) -> LinearModel:
        return LinearModel(*(tuple(v) if isinstance(v, list) else v for v in map(self._given, (self.features, self.intercept, self.weights, self.mean, self.std))))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        m = self.model()
        return dataset.withColumn(PROBABILITY, linear_score(m.features, m.weights, m.mean, m.std, m.intercept))


class ConstantRisk(_Stage):
    """One probability for every row."""

    value = Param(Params._dummy(), "value", "the probability", TypeConverters.toFloat)

    def __init__(self, value: float | None = None):
        super().__init__()
        if value is not None:
            self._set(value=float(value))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(PROBABILITY, F.lit(self._given(self.value)))


class VectorRisk(_Stage):
    """The probability of class 1 from a classifier's columns, which go."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(PROBABILITY, vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def scoring_pipeline(medians: dict[str, float], *, linear: LinearModel | None = None, classifier=None, constant: float | None = None) -> PipelineModel:
    """Raw rows to ``probability_risky`` under stored weights, a fitted classifier on the plain features, or a constant."""
    from pyspark.ml.feature import VectorAssembler

    if linear is not None:
        last = [LinearRisk(linear)]
    elif classifier is not None:
        last = [VectorAssembler(inputCols=list(FEATURE_COLUMNS), outputCol="features"), classifier, VectorRisk()]
    else:
        last = [ConstantRisk(constant)]
    return PipelineModel([EventFeatures(medians), *last])
