"""JOB-2: features -> split -> three fits -> comparison -> selection -> decisions.

The feature table is stored once, without the texts (three fits and four
summaries read it, and storing cuts the history windows out of the lineage); the
split is an expression on it.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventsieve.config import (
    DEFAULT_RULES,
    FEATURE_COLUMNS,
    LABEL_COLUMN,
    LABEL_RISKY,
    LABEL_VALID,
    MODEL_BASELINE,
    MODEL_FOREST,
    MODEL_LOGISTIC,
    REQUIRED_MODEL_COLUMNS,
    RuleConfig,
)
from eventsieve.operators import decisions as decisions_op
from eventsieve.operators import evaluation, features, models, scoring, stats
from eventsieve.operators.model_stages import scoring_pipeline
from eventsieve.operators.rules import require_columns, require_min_rows
from eventsieve.session import ensure_checkpoint_dir
from eventsieve.operators.export import decision_feed
from eventsieve.sinks.writers import write_table

TARGET_DEFINITION = "1 = rule risk (type, users, date, repeat) or history risk (velocity, report rate, young and reported)"
SELECTION_POLICY = "mayor F1; preferir regresion logistica si queda a 0.03 o menos del mejor F1"

EVENT_TEXTS = ("source_user_id", "target_user_id", "created_at")
Z_COLUMNS = tuple(f"{c}_z" for c in FEATURE_COLUMNS)


@dataclass
class TrainResult:
    selected_model: str
    comparison: DataFrame
    metrics: DataFrame
    confusion: DataFrame
    roc: DataFrame
    weights: DataFrame
    test_predictions: DataFrame
    performance: DataFrame
    decisions: DataFrame
    quality: DataFrame
    correlation: DataFrame
    new_event_predictions: DataFrame
    candidates: dict = field(default_factory=dict)
    features: DataFrame | None = None
    confusions: DataFrame | None = None
    linear_model: scoring.LinearModel | None = None
    pipeline: object | None = None  # raw rows to probability_risky, by the selected model


def _prepare(df: DataFrame, name: str, mean, std) -> DataFrame:
    if name == MODEL_LOGISTIC:
        return models.assemble(scoring.standardize(df, mean, std), Z_COLUMNS)
    return models.assemble(df)


def fit_candidates(
    train: DataFrame, mean, std, rules: RuleConfig, names: tuple[str, ...] = (MODEL_BASELINE, MODEL_LOGISTIC, MODEL_FOREST)
) -> dict[str, models.FittedCandidate]:
    """Fit the candidates asked for, no others."""

    def logistic() -> models.FittedCandidate:
        fitted = models.fit_logistic(_prepare(train, MODEL_LOGISTIC, mean, std), rules)
        return replace(fitted, linear=linear_from_logistic(fitted, mean, std))  # scored as an expression from here on

    fits = {
        MODEL_BASELINE: lambda: models.fit_baseline(train),
        MODEL_LOGISTIC: logistic,
        MODEL_FOREST: lambda: models.fit_forest(_prepare(models.spread_evenly(train), MODEL_FOREST, mean, std), rules),
    }
    return {name: fits[name]() for name in names}


def linear_from_logistic(candidate: models.FittedCandidate, mean, std) -> scoring.LinearModel:
    """The fitted logistic model as a column expression (ML-5 scorer)."""
    m = candidate.model
    return scoring.LinearModel(FEATURE_COLUMNS, float(m.intercept), tuple(float(w) for w in m.coefficients), tuple(mean), tuple(std))


def run_model_job(
    spark: SparkSession,
    events: DataFrame,
    rules: RuleConfig = DEFAULT_RULES,
    output_dir: str | None = None,
    dataset_source: str = "events",
    new_events: DataFrame | None = None,
    stored_model: scoring.LinearModel | None = None,
) -> TrainResult:
    """Fit, compare, select and decide; ``new_events`` (raw rows, signals
    optional) are scored by the fitted linear model with the training medians.
    Without ``new_events`` that table is empty.  With ``stored_model`` nothing is
    fitted: the stored weights are the one candidate."""
    require_columns(events, REQUIRED_MODEL_COLUMNS)
    ensure_checkpoint_dir(spark)

    used = [*[c for c in ("seq",) if c in events.columns], "event_id", "event_type", "_raw_type", *EVENT_TEXTS, *FEATURE_COLUMNS, LABEL_COLUMN]
    feats, medians = features.features_and_medians(events.withColumn("_raw_type", F.col("event_type")), used, rules)
    require_min_rows(feats, rules.minimum_input_rows)  # the events may be a plan with windows: their stored rows are counted
    split = scoring.stratified_split(feats, rules=rules)
    train = split.filter(F.col("split") == "train")
    test = split.filter(F.col("split") == "test")
    mean, std = scoring.train_statistics(train)

    if stored_model is None:
        candidates = fit_candidates(train, mean, std, rules)
        linear = candidates[MODEL_LOGISTIC].linear
    else:
        linear = stored_model
        candidates = {MODEL_LOGISTIC: models.FittedCandidate(MODEL_LOGISTIC, None, 0.0, linear=linear)}
    rows = [models.evaluate(cand, _prepare_for(cand, test, mean, std), rules.threshold) for cand in candidates.values()]
    comparison = rows[0]
    for r in rows[1:]:
        comparison = comparison.unionByName(r)
    comparison = models.select_model(comparison)
    selected = comparison.filter(F.col("selected") == 1).first()["model"]
    chosen = candidates[selected]

    confusions = None
    for cand in candidates.values():
        one = models.predict(cand, _prepare_for(cand, test, mean, std)).select(
            F.col(LABEL_COLUMN).alias("label"), F.col("probability_risky").alias("probability")
        )
        one = evaluation.confusion_matrix(one, threshold=rules.threshold).select(F.lit(cand.name).alias("model"), "*")
        confusions = one if confusions is None else confusions.unionByName(one)

    test_scored = models.predict(chosen, _prepare_for(chosen, test, mean, std))
    labelled = test_scored.select(F.col(LABEL_COLUMN).alias("label"), F.col("probability_risky").alias("probability"))
    metrics = comparison.filter(F.col("selected") == 1).drop("model", "selected", "training_seconds", "inference_seconds")
    confusion = evaluation.confusion_matrix(labelled, threshold=rules.threshold)
    roc = evaluation.roc_curve(labelled)
    weights = models.weights_table(spark, models.feature_weights(chosen))
    p = F.col("probability_risky")
    test_predictions = test_scored.select(
        *FEATURE_COLUMNS,
        F.col(LABEL_COLUMN).alias("real_label_risky_event"),
        F.round(p, 4).alias("risk_probability"),
        (p >= rules.threshold).cast("int").alias("predicted_label_risky_event"),
        F.when(p >= rules.threshold, LABEL_RISKY).otherwise(LABEL_VALID).alias("prediction_text"),
    )
    sel = comparison.filter(F.col("selected") == 1).first()
    n_train, n_test = train.count(), test.count()
    performance = spark.createDataFrame(
        [(float(sel["training_seconds"]), float(sel["inference_seconds"]), n_test,
          round(n_test / max(float(sel["inference_seconds"]), 1e-9), 2), n_train + n_test, dataset_source, n_train, n_test)],
        "training_seconds double, inference_seconds double, inference_rows bigint, inference_rows_per_second double, "
        "dataset_rows bigint, dataset_source string, train_rows bigint, test_rows bigint",
    )

    # ML-16 + VAL-4: all events scored by the selected model, rules first.
    all_scored = models.predict(chosen, _prepare_for(chosen, split, mean, std))
    decided = decisions_op.decide(
        all_scored.withColumn("event_type", F.col("_raw_type")),
        F.col("probability_risky"), rules, keep=("seq",) if "seq" in all_scored.columns else (),
    )
    unseen = new_events if new_events is not None else events.limit(0)
    kept = ("seq", "event_id", "event_type", "source_user_id", "target_user_id", "created_at", "content", "is_duplicate")
    scored_new = scoring.score_linear(features.engineer_features(unseen, rules, medians), linear, rules.threshold).select(
        *[c for c in kept if c in unseen.columns], "risk_probability", "prediction"
    )

    result = TrainResult(
        selected_model=selected,
        comparison=comparison,
        metrics=metrics,
        confusion=confusion,
        roc=roc,
        weights=weights,
        test_predictions=test_predictions,
        performance=performance,
        decisions=decided,
        quality=stats.quality_summary(split),
        correlation=stats.correlation_matrix(split),
        new_event_predictions=scored_new,
        features=split.select(*[c for c in ("seq", "event_id") if c in split.columns], *FEATURE_COLUMNS, LABEL_COLUMN),
        confusions=confusions,
        candidates=candidates,
        linear_model=linear,
        pipeline=scoring_pipeline(
            medians, linear=chosen.linear, classifier=chosen.model, constant=chosen.constant
        ),
    )
    if output_dir:
        write_outputs(result, output_dir)
    return result


def load_scoring_pipeline(path: str):
    """SNK-5: the saved model; its ``transform`` adds ``probability_risky`` to raw event rows."""
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)


def _prepare_for(cand: models.FittedCandidate, df: DataFrame, mean, std) -> DataFrame:
    return df if cand.model is None or cand.linear is not None else _prepare(df, cand.name, mean, std)


def write_outputs(result: TrainResult, output_dir: str) -> dict[str, str]:
    """SNK-1/2/5: one table per result plus the selected fitted model."""
    tables = {
        "model_comparison": result.comparison,
        "model_metrics": result.metrics,
        "confusion_matrix": result.confusion,
        "roc_curve_points": result.roc,
        "feature_weights": result.weights,
        "test_predictions": result.test_predictions,
        "performance_summary": result.performance,
        "final_event_decisions": result.decisions,
        "quality_summary": result.quality,
        "correlation_matrix": result.correlation,
        "new_event_predictions": result.new_event_predictions,
        "feature_matrix": result.features,
        "confusion_matrix_by_model": result.confusions,
    }
    paths = {}
    for name, df in tables.items():
        paths[name] = os.path.join(output_dir, name)
        write_table(df, paths[name])
    # SNK-8: the decision feed (no user ids) as JSON lines.
    paths["decision_feed"] = os.path.join(output_dir, "decision_feed")
    decided = result.decisions.sparkSession.read.parquet(paths["final_event_decisions"])  # rules and scores are not applied again
    write_table(decision_feed(decided), paths["decision_feed"], "json")
    # SNK-5: the selected model as a pipeline over raw rows (``load_scoring_pipeline``), plus a one-row metadata table.
    result.pipeline.write().overwrite().save(os.path.join(output_dir, "model"))
    lm = result.linear_model
    spark = result.comparison.sparkSession
    meta = spark.createDataFrame(
        [(result.selected_model, SELECTION_POLICY, LABEL_COLUMN, list(FEATURE_COLUMNS),
          [round(lm.intercept, 8), *[round(w, 8) for w in lm.weights]] if lm else [],
          [round(m, 8) for m in lm.mean] if lm else [], [round(x, 8) for x in lm.std] if lm else [],
          TARGET_DEFINITION, result.metrics.toJSON().first(), result.performance.toJSON().first())],
        "model string, selection_policy string, target string, feature_columns array<string>, "
        "weights array<double>, mean array<double>, std array<double>, target_definition string, metrics string, performance string",
    ).withColumn("generated_at_utc", F.current_timestamp())
    paths["model_metadata"] = os.path.join(output_dir, "model_metadata")
    write_table(meta, paths["model_metadata"], "json")
    return paths
