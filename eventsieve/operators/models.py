"""Model fitting, comparison and selection (ML-3, ML-4, ML-6, ML-9..14, ML-16).

Fitting uses Spark ML's distributed optimisers (L-BFGS for the logistic
model, the tree learner for the forest) on a ``VectorAssembler`` column;
the reference's 3,500-epoch NumPy loop is not reproduced as jobs.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventsieve.config import (
    DEFAULT_RULES,
    FEATURE_COLUMNS,
    LABEL_COLUMN,
    MODEL_BASELINE,
    MODEL_FOREST,
    MODEL_LOGISTIC,
    SELECTION_MARGIN,
    RuleConfig,
)
from eventsieve.operators.scoring import LinearModel
from eventsieve.session import materialize, release


def select_model(comparison: DataFrame, margin: float = SELECTION_MARGIN) -> DataFrame:
    """ML-11: best F1 (ties: AUC, recall, name), but the logistic model when
    its F1 is within ``margin`` of the best; adds ``selected`` 0/1.

    The comparison has one row per candidate model (a handful), so the
    ordering window over it is bounded."""
    ranked = comparison.withColumn(
        "_rank",
        F.row_number().over(Window.orderBy(F.desc("f1_score"), F.desc("roc_auc"), F.desc("recall"), F.col("model"))),
    )
    best_f1 = F.max(F.when(F.col("_rank") == 1, F.col("f1_score"))).over(Window.partitionBy())
    best_model = F.max(F.when(F.col("_rank") == 1, F.col("model"))).over(Window.partitionBy())
    logistic_f1 = F.max(F.when(F.col("model") == MODEL_LOGISTIC, F.col("f1_score"))).over(Window.partitionBy())
    chosen = F.when(logistic_f1 >= best_f1 - F.lit(margin), F.lit(MODEL_LOGISTIC)).otherwise(best_model)
    return ranked.withColumn("selected", (F.col("model") == chosen).cast("int")).drop("_rank")


@dataclass
class FittedCandidate:
    name: str
    model: object | None  # a Spark ML model; None for the baseline and for stored weights
    training_seconds: float
    constant: float | None = None  # baseline probability
    linear: LinearModel | None = None  # stored weights, applied as an expression


def assemble(df: DataFrame, columns=FEATURE_COLUMNS, out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=list(columns), outputCol=out).transform(
        df.withColumns({c: F.col(c).cast("double") for c in columns})
    )


def fit_baseline(train: DataFrame) -> FittedCandidate:
    """ML-3: constant probability = train positive rate."""
    from eventsieve.operators.scoring import baseline_probability

    started = time.perf_counter()
    p = baseline_probability(train)
    return FittedCandidate(MODEL_BASELINE, None, time.perf_counter() - started, constant=p)


def fit_logistic(train: DataFrame, rules: RuleConfig = DEFAULT_RULES) -> FittedCandidate:
    """ML-4: L2 logistic regression on standardised features.

    The reference minimises mean log-loss + ``l2/(2n)·|w|²`` (intercept not
    penalised) by gradient descent; Spark's ``regParam = l2/n`` with
    ``elasticNetParam = 0`` is the same objective, solved to the optimum.
    ``train`` carries features already standardised with the population std
    (AGG-11), so ``standardization=False``; ``StandardScaler`` is not used
    because it divides by the sample std."""
    from pyspark.ml.classification import LogisticRegression

    n = train.count()
    started = time.perf_counter()
    lr = LogisticRegression(
        featuresCol="features",
        labelCol=LABEL_COLUMN,
        regParam=rules.logistic_l2 / max(1, n),
        elasticNetParam=0.0,
        standardization=False,
        fitIntercept=True,
        maxIter=rules.logistic_max_iterations,
        tol=1e-9,
    )
    model = lr.fit(train)
    return FittedCandidate(MODEL_LOGISTIC, model, time.perf_counter() - started)


# Rows of a partition of the forest's training rows: at most, and before all cores have four partitions each.
FOREST_ROWS, FOREST_ROWS_LEAST = 100_000, 25_000


def spread_evenly(train: DataFrame, columns=(*FEATURE_COLUMNS, LABEL_COLUMN)) -> DataFrame:
    """``columns`` of the training rows in partitions of equal size, in a fixed order.

    Every level of the forest is a pass over all rows, as long as its largest
    task; a row carries a count a tree while it is held, so partitions of a
    file's size would be large blocks."""
    n, cores = train.count(), train.sparkSession.sparkContext.defaultParallelism
    parts = max(-(-n // FOREST_ROWS), min(4 * cores, -(-n // FOREST_ROWS_LEAST)), 1)
    return train.select(*columns).repartition(parts).sortWithinPartitions(*columns)


def fit_forest(train: DataFrame, rules: RuleConfig = DEFAULT_RULES) -> FittedCandidate:
    """ML-6: random forest, unscaled features."""
    from pyspark.ml.classification import RandomForestClassifier

    started = time.perf_counter()
    rf = RandomForestClassifier(
        featuresCol="features",
        labelCol=LABEL_COLUMN,
        numTrees=rules.forest_trees,
        maxDepth=rules.forest_max_depth,
        minInstancesPerNode=rules.forest_min_leaf,
        maxBins=rules.forest_max_bins,
        seed=rules.seed,
    )
    # The copy is without the training summary, which holds the session: tasks could not be sent the model with it.
    model = rf.fit(train).copy()
    return FittedCandidate(MODEL_FOREST, model, time.perf_counter() - started)


def predict(candidate: FittedCandidate, df: DataFrame, out: str = "probability_risky") -> DataFrame:
    """Positive-class probability column for any candidate (ML-13/16)."""
    if candidate.linear is not None:
        return df.withColumn(out, candidate.linear.probability())
    if candidate.model is None:
        return df.withColumn(out, F.lit(float(candidate.constant)))
    from pyspark.ml.functions import vector_to_array

    scored = candidate.model.transform(df)
    return scored.withColumn(out, vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction")


def feature_weights(candidate: FittedCandidate, columns=FEATURE_COLUMNS) -> list[tuple[str, float]]:
    """ML-14: importances (forest), coefficients (logistic) or zeros."""
    if candidate.linear is not None:
        values = list(candidate.linear.weights)
    elif candidate.name == MODEL_FOREST:
        values = list(candidate.model.featureImportances.toArray())
    elif candidate.name == MODEL_LOGISTIC:
        values = list(candidate.model.coefficients.toArray())
    else:
        values = [0.0] * len(columns)
    return list(zip(columns, [float(v) for v in values]))


def weights_table(spark, weights: list[tuple[str, float]]) -> DataFrame:
    """SRT-3: ``feature, weight, abs_weight`` by descending absolute weight."""
    rows = [(f, round(w, 6), round(abs(w), 6)) for f, w in weights]
    df = spark.createDataFrame(rows, "feature string, weight double, abs_weight double")
    return df.orderBy(F.desc("abs_weight"), "feature")


def evaluate(candidate: FittedCandidate, test: DataFrame, threshold: float) -> DataFrame:
    """ML-9: metrics row with measured seconds; inference is scoring every row and storing the scores.

    The metrics are taken from the stored scores: the model runs once."""
    from eventsieve.operators.evaluation import classification_metrics

    started = time.perf_counter()
    scored = predict(candidate, test).select(F.col(LABEL_COLUMN).alias("label"), F.col("probability_risky").alias("probability"))
    stored = materialize(scored)
    inference = time.perf_counter() - started
    metrics = classification_metrics(stored, threshold=threshold)
    row = metrics.first()
    release(stored)
    return test.sparkSession.createDataFrame(
        [(candidate.name, *row, round(max(candidate.training_seconds, 1e-9), 6), round(max(inference, 1e-9), 6))],
        "model string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in metrics.schema.fields)
        + ", training_seconds double, inference_seconds double",
    )
