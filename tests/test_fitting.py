"""Fitted models against brute force on the small tables (rows-only queries)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventsieve.config import DEFAULT_RULES, FEATURE_COLUMNS, LABEL_COLUMN, MODEL_LOGISTIC
from eventsieve.operators import features, models, scoring
from eventsieve.plans.modeling import Z_COLUMNS, fit_candidates
from eventsieve.session import materialize
from eventsieve.sources.driver_tables import model_events
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def fitted(spark):
    split = materialize(scoring.stratified_split(features.engineer_features(model_events(spark, SF_SMALL))))
    train = split.filter(F.col("split") == "train")
    mean, std = scoring.train_statistics(train)
    return train, mean, std, fit_candidates(train, mean, std, DEFAULT_RULES)


def test_train_statistics_are_population(fitted):
    train, mean, std, _ = fitted
    x = np.array([[float(v) for v in r] for r in train.select(*FEATURE_COLUMNS).collect()])
    np.testing.assert_allclose(mean, x.mean(axis=0), rtol=1e-12, atol=1e-12)
    expected = x.std(axis=0)
    expected[expected == 0] = 1.0
    np.testing.assert_allclose(std, expected, rtol=1e-9)


def test_logistic_reaches_the_regularised_optimum(fitted):
    """Same objective as the reference's gradient loop: mean log-loss +
    l2/(2n)|w|^2 without penalising the intercept, solved by Newton steps."""
    train, mean, std, cands = fitted
    z = scoring.standardize(train, mean, std).select(*Z_COLUMNS, LABEL_COLUMN).collect()
    x = np.array([[float(r[c]) for c in Z_COLUMNS] for r in z])
    y = np.array([float(r[LABEL_COLUMN]) for r in z])
    n = len(y)
    xb = np.column_stack([np.ones(n), x])
    w = np.zeros(xb.shape[1])
    reg = np.full(xb.shape[1], DEFAULT_RULES.logistic_l2 / n)
    reg[0] = 0.0
    for _ in range(100):
        p = 1.0 / (1.0 + np.exp(-(xb @ w)))
        grad = xb.T @ (p - y) / n + reg * w
        hess = (xb.T * (p * (1 - p))) @ xb / n + np.diag(reg)
        w -= np.linalg.solve(hess + 1e-12 * np.eye(len(w)), grad)

    def objective(v):
        q = np.clip(1.0 / (1.0 + np.exp(-(xb @ v))), 1e-15, 1 - 1e-15)
        return -np.mean(y * np.log(q) + (1 - y) * np.log(1 - q)) + 0.5 * np.sum(reg * v * v)

    model = cands[MODEL_LOGISTIC].model
    spark_w = np.array([model.intercept, *model.coefficients.toArray()])
    # Separable classes make the optimum flat; compare objective values.
    assert objective(spark_w) == pytest.approx(objective(w), rel=1e-4, abs=1e-6)


def test_forest_and_selection_invariants(spark, fitted):
    train, mean, std, cands = fitted
    assert set(cands) == {"baseline_clase_mayoritaria", "regresion_logistica", "random_forest"}
    forest = cands["random_forest"].model
    assert forest.getNumTrees == DEFAULT_RULES.forest_trees
    imp = forest.featureImportances.toArray()
    assert imp.sum() == pytest.approx(1.0) and len(imp) == len(FEATURE_COLUMNS)
    weights = models.weights_table(spark, models.feature_weights(cands["random_forest"])).collect()
    assert [r.abs_weight for r in weights] == sorted((r.abs_weight for r in weights), reverse=True)


def test_forest_rows_are_spread_evenly(spark, monkeypatch):
    """F1-F3: the forest's tasks had as many rows as the stored files happened to hold."""
    monkeypatch.setattr(models, "FOREST_ROWS", 100)
    columns = [*FEATURE_COLUMNS, LABEL_COLUMN]
    uneven = spark.range(2000).select(*[(F.col("id") % (i + 2)).cast("double").alias(c) for i, c in enumerate(columns)]).withColumn("seq", F.lit(1)).coalesce(1)
    got = models.spread_evenly(uneven)
    sizes = got.rdd.glom().map(len).collect()
    assert len(sizes) == 20 and max(sizes) <= 110
    assert got.columns == columns and got.exceptAll(uneven.select(*columns)).isEmpty() and got.count() == 2000


def test_the_model_scores_its_test_rows_once(spark, monkeypatch):
    """F1, F3: scores were computed for the seconds, and again for the metrics."""
    scored = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            scored.add(b.num_rows)
            yield b

    df = spark.createDataFrame([(i % 2, i / 50) for i in range(50)], f"{LABEL_COLUMN} int, p double")
    monkeypatch.setattr(models, "predict", lambda cand, test: test.mapInArrow(counted, test.schema).withColumnRenamed("p", "probability_risky"))
    row = models.evaluate(models.FittedCandidate("x", None, 1.0, constant=0.5), df, 0.5).first()
    assert scored.value == 50 and row.true_positives_risky_detected == 13 and row.inference_seconds > 0
