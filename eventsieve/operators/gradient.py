"""Logistic regression by full-batch gradient steps (ML-4).

The reference fits by a fixed number of steps from zero weights and stops
there, so its weights are not the optimum's and only the same steps give them.
A step needs one vector, the gradient; it is one aggregate over the training
rows.  Rows with equal features and label are merged first, with their number
as weight, and stored: every step reads the stored vectors, adds up 16 sums per
task, and sends one row to the driver, which moves the weights.

A training set of at most ``local_vectors`` distinct vectors (counted) is read
once and stepped over on the driver, since a job a step would only wait.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventsieve.config import DEFAULT_RULES, FEATURE_COLUMNS, LABEL_COLUMN, RuleConfig
from eventsieve.functions.numeric import sigmoid
from eventsieve.operators.scoring import LinearModel, standardize, train_statistics
from eventsieve.session import materialize, release


@dataclass(frozen=True)
class GradientConfig:
    steps: int = 3500
    learning_rate: float = 0.08
    l2: float = 0.01
    local_vectors: int = 20_000


def weighted_vectors(train: DataFrame, columns=FEATURE_COLUMNS, label: str = LABEL_COLUMN) -> DataFrame:
    """``(columns, _y, _n)``: distinct rows and how often each occurs."""
    return train.groupBy(*[F.col(c).cast("double").alias(c) for c in columns], F.col(label).cast("double").alias("_y")).agg(
        F.count(F.lit(1)).alias("_n")
    )


def _error(weights: np.ndarray, columns: list[str]) -> Column:
    z = F.lit(float(weights[0]))
    for w, c in zip(weights[1:], columns, strict=True):
        z = z + F.lit(float(w)) * F.col(c)
    return (sigmoid(z) - F.col("_y")) * F.col("_n")


def gradient(vectors: DataFrame, weights: np.ndarray, columns: list[str]) -> np.ndarray:
    """Summed gradient of the log loss: one aggregate, one row."""
    err = vectors.withColumn("_e", _error(weights, columns))
    row = err.agg(F.sum("_e"), *[F.sum(F.col("_e") * F.col(c)) for c in columns]).first()
    return np.array([v or 0.0 for v in row], float)


def _moved(weights: np.ndarray, summed: np.ndarray, rows: int, config: GradientConfig) -> np.ndarray:
    step = summed / rows
    step[1:] += config.l2 * weights[1:] / rows  # the intercept is not penalised
    return weights - config.learning_rate * step


def fit_by_gradient(
    train: DataFrame,
    config: GradientConfig = GradientConfig(),
    columns=FEATURE_COLUMNS,
    label: str = LABEL_COLUMN,
    rules: RuleConfig = DEFAULT_RULES,
) -> LinearModel:
    """The model after ``config.steps`` steps on the standardised features; without rows all weights are 0."""
    mean, std = train_statistics(train, columns)
    z = [f"{c}_z" for c in columns]
    vectors = materialize(standardize(weighted_vectors(train, columns, label), mean, std, columns).select(*z, "_y", "_n"))
    size = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("_n"), F.lit(0))).first()
    weights = np.zeros(1 + len(columns))
    if size[1]:
        if size[0] <= config.local_vectors:
            local = vectors.toPandas()
            x = np.column_stack([np.ones(len(local)), local[z].to_numpy(float)])
            y, n = local["_y"].to_numpy(float), local["_n"].to_numpy(float)
            for _ in range(config.steps):
                p = 1 / (1 + np.exp(-np.clip(x @ weights, -500, 500)))
                weights = _moved(weights, x.T @ ((p - y) * n), size[1], config)
        else:
            for _ in range(config.steps):
                weights = _moved(weights, gradient(vectors, weights, z), size[1], config)
    release(vectors)
    return LinearModel(tuple(columns), float(weights[0]), tuple(float(w) for w in weights[1:]), mean, std)
