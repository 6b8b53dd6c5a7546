"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame
whose columns match the SQL of the same name in ``oracle_sql.py``.

Every query reads the driver tables (``events``) and runs over all rows.
Sub-plans that several jobs of one query read are stored eagerly while the
query is built.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventsieve.config import (
    DECISION_REVIEW,
    DEFAULT_RULES,
    FEATURE_COLUMNS,
    LABEL_COLUMN,
    LABEL_RISKY,
    LABEL_VALID,
    MODEL_BASELINE,
    MODEL_FOREST,
    MODEL_LOGISTIC,
    STATISTIC_COLUMNS,
)
from eventsieve.functions.timestamps import format_millis
from eventsieve.operators import cleaning, decisions, evaluation, export, features, notifications, rules, scoring, stats
from eventsieve.operators.indexing import with_global_index
from eventsieve.plans.oracle_sql import (
    EXPORT_SALT,
    FILTER_DECISION,
    FILTER_TYPE,
    GRADIENT_STEPS,
    LOOKUP_IDS_BELOW,
    LOOKUP_POINTS,
    LOOKUP_USERS_BELOW,
    REVIEW_TOP_N,
)
from eventsieve.session import materialize, shared_path
from eventsieve.sinks.writers import render_timestamps
from eventsieve.sources.driver_tables import dirty_signals, event_signals, model_events, raw_events

R = DEFAULT_RULES
STREAM_SLICES, INCREMENTS = 4, 10
PROCESSED_COLUMNS = (
    "seq", "event_id", "event_type", "source_user_id", "target_user_id", "created_at", "content", "notification_text",
)


def _checked(spark, sf) -> DataFrame:
    return rules.with_error_reason(cleaning.clean_transform(raw_events(spark, sf)))


def _valid(spark, sf) -> DataFrame:
    return rules.split_valid_rejected(_checked(spark, sf))[0]


def _out(df: DataFrame, extra=()) -> DataFrame:
    cols = [format_millis("created_at").alias("created_at") if c == "created_at" else F.col(c) for c in PROCESSED_COLUMNS]
    return df.select(*cols, *extra)


EVENT_COLUMNS = ("source_user_id", "target_user_id", "created_at")


def _features(spark, sf, *extra) -> DataFrame:
    """Ids, cleaned type, features and label, and the ``extra`` columns asked for.

    Medians, split sampling and scoring each run a job over them: they are
    stored once, without the texts."""
    return features.stored_features(model_events(spark, sf), ["seq", "event_id", "event_type", *FEATURE_COLUMNS, LABEL_COLUMN, *extra])


def _types(spark, sf) -> DataFrame:
    """Cleaned event types, flags and labels without medians or a stored table."""
    return features.engineer_features(model_events(spark, sf), medians={})


def _split(spark, sf) -> DataFrame:
    return scoring.stratified_split(_features(spark, sf))


def _scored(spark, sf) -> DataFrame:
    return _split(spark, sf).withColumn("_p", scoring.REFERENCE_MODEL.probability())


def _narrow_scored(spark, sf) -> DataFrame:
    """Split of ids, labels and probabilities: only these columns are sorted and stored."""
    scored = _features(spark, sf).withColumn("_p", scoring.REFERENCE_MODEL.probability())
    return scoring.stratified_split(scored.select("seq", LABEL_COLUMN, "_p"))


def _test(spark, sf) -> DataFrame:
    return _narrow_scored(spark, sf).filter(F.col("split") == "test").select(
        F.col(LABEL_COLUMN).alias("label"), F.col("_p").alias("probability")
    )


def _decisions(spark, sf) -> DataFrame:
    """Decisions over all model events, scored with the stored linear model
    on batch-imputed features (VAL-6), in one plan (no self-join)."""
    model = model_events(spark, sf).withColumn("_raw_type", F.col("event_type"))
    columns = ["seq", "event_id", "_raw_type", *FEATURE_COLUMNS, *EVENT_COLUMNS]
    feats = features.stored_features(model, columns).withColumn("event_type", F.col("_raw_type"))
    return decisions.decide(feats, scoring.REFERENCE_MODEL.probability(), R, keep=("seq",))


def q_clean_events(spark, sf):
    return _out(cleaning.clean_transform(raw_events(spark, sf)))


def q_duplicate_flags(spark, sf):
    return cleaning.flag_duplicates(raw_events(spark, sf)).select("seq", "event_id", "is_duplicate")


def q_valid_events(spark, sf):
    return _out(_valid(spark, sf))


def q_rejected_events(spark, sf):
    return _out(rules.split_valid_rejected(_checked(spark, sf))[1], ("error_reason",))


def q_rejection_reasons(spark, sf):
    _, rejected = rules.split_valid_rejected(_checked(spark, sf))
    return stats.value_counts(rejected, "error_reason")


def q_notifications(spark, sf):
    return notifications.generate_notifications(_valid(spark, sf), R)


def q_kpi_report(spark, sf):
    # Both branches read the checked table: store it once (as the ETL job
    # does) instead of running the dedup shuffles twice.
    valid, rejected = rules.split_valid_rejected(materialize(_checked(spark, sf)))
    return notifications.calculate_kpis(rejected, notifications.generate_notifications(valid, R))


def q_recent_events(spark, sf):
    indexed = with_global_index(_valid(spark, sf), notifications.newest_first(), "position")
    return _out(indexed, ("position",)).orderBy("position")


def q_recent_by_type(spark, sf):
    from eventsieve.operators.indexing import with_rank_within

    valid = _valid(spark, sf).filter(F.col("event_type").isin(*R.allowed_event_types))
    ranked = with_rank_within(valid, "event_type", notifications.newest_first(), "position")
    return _out(ranked.withColumn("view_name", F.col("event_type")), ("position", "view_name")).select(
        "view_name", *PROCESSED_COLUMNS, "position"
    )


def q_velocity(spark, sf):
    return event_signals(spark, sf).select("seq", "interaction_velocity_5m")


def q_account_age(spark, sf):
    return event_signals(spark, sf).select("seq", "account_age_days")


def q_report_rate(spark, sf):
    return event_signals(spark, sf).select("seq", F.round("historical_report_rate", 6).alias("historical_report_rate"))


def q_risk_label(spark, sf):
    return model_events(spark, sf).select(
        "seq", "event_id", "is_duplicate", "historical_feedback_risk", "label_risky_event"
    )


def q_feature_matrix(spark, sf):
    return _features(spark, sf).select("seq", *FEATURE_COLUMNS, LABEL_COLUMN)


def q_event_type_counts(spark, sf):
    typed = features.engineer_features(raw_events(spark, sf), medians={})  # types need no history
    return stats.value_counts(typed, "event_type", blank_label="vacio")


def q_label_counts(spark, sf):
    feats = _types(spark, sf).withColumn("label", features.label_text())
    return stats.value_counts(feats, "label")


def q_risk_by_event_type(spark, sf):
    return stats.mean_by_group(_types(spark, sf), "event_type", LABEL_COLUMN, "risk_rate")


def q_distinct_event_types(spark, sf):
    return stats.distinct_sorted(features.engineer_features(raw_events(spark, sf), medians={}), "event_type")


def q_quality_summary(spark, sf):
    return stats.quality_summary(_features(spark, sf))


def q_quality_statistics(spark, sf):
    return stats.statistics_part(stats.quality_statistics(_features(spark, sf)))


def q_quality_operational(spark, sf):
    return stats.operational_part(stats.quality_counts(_features(spark, sf)).unionByName(stats.imputation_note(spark)))


def q_correlation_matrix(spark, sf):
    return stats.correlation_matrix(_features(spark, sf)).withColumn("correlation", F.round("correlation", 6))


def q_stratified_split(spark, sf):
    # The label needs no features.
    return scoring.stratified_split(materialize(model_events(spark, sf).select("seq", LABEL_COLUMN))).select("seq", LABEL_COLUMN, "split")


def q_standardized_features(spark, sf):
    split = _split(spark, sf)
    mean, std = scoring.train_statistics(split.filter(F.col("split") == "train"))
    z = scoring.standardize(split, mean, std)
    return z.select("seq", "split", *[F.round(f"{c}_z", 6).alias(f"{c}_z") for c in FEATURE_COLUMNS])


def q_linear_scores(spark, sf):
    return scoring.score_linear(_features(spark, sf), threshold=R.threshold).select("seq", "risk_probability", "prediction")


def q_new_event_scores(spark, sf):
    """ML-15: raw events without numeric signals (absent -> 0.0) scored by the stored model."""
    feats = features.engineer_features(raw_events(spark, sf))
    return scoring.score_linear(feats, threshold=R.threshold).select("seq", "event_id", "risk_probability", "prediction")


def q_test_predictions(spark, sf):
    p = F.col("_p")
    return _scored(spark, sf).filter(F.col("split") == "test").select(
        "seq",
        *FEATURE_COLUMNS,
        F.col(LABEL_COLUMN).alias("real_label_risky_event"),
        F.round(p, 4).alias("risk_probability"),
        (p >= R.threshold).cast("int").alias("predicted_label_risky_event"),
        F.when(p >= R.threshold, LABEL_RISKY).otherwise(LABEL_VALID).alias("prediction_text"),
    )


def q_confusion_matrix(spark, sf):
    return evaluation.confusion_matrix(_test(spark, sf), threshold=R.threshold)


def q_roc_curve(spark, sf):
    return evaluation.roc_curve(_test(spark, sf))


def q_model_metrics(spark, sf):
    return evaluation.classification_metrics(_test(spark, sf), threshold=R.threshold)


def q_model_selection(spark, sf):
    """ML-3 / ML-10 / ML-11 on the SQL-checkable candidates."""
    from eventsieve.operators.models import select_model

    scored = materialize(_narrow_scored(spark, sf))
    train = scored.filter(F.col("split") == "train")
    test = scored.filter(F.col("split") == "test").select(F.col(LABEL_COLUMN).alias("label"), "_p")
    base_p = scoring.baseline_probability(train)
    rows = [
        evaluation.classification_metrics(test.withColumn("probability", F.lit(base_p)), threshold=R.threshold)
        .select(F.lit(MODEL_BASELINE).alias("model"), "*"),
        evaluation.classification_metrics(test.withColumnRenamed("_p", "probability"), threshold=R.threshold)
        .select(F.lit(MODEL_LOGISTIC).alias("model"), "*"),
    ]
    comparison = rows[0].unionByName(rows[1])
    return select_model(comparison)


def q_rule_reasons(spark, sf):
    return model_events(spark, sf).select("seq", "event_id", rules.decision_rule_reason(R).alias("rule_error_reason"))


def q_final_decisions(spark, sf):
    return _decisions(spark, sf).select("seq", *decisions.DECISION_COLUMNS)


def q_decision_summary(spark, sf):
    return stats.value_counts(_decisions(spark, sf), "final_decision")


def q_decision_group_counts(spark, sf):
    return stats.group_count(_decisions(spark, sf), "rule_error_reason")


def q_decision_filter(spark, sf):
    return decisions.filter_decisions(_decisions(spark, sf), FILTER_TYPE, FILTER_DECISION).select(
        "seq", *decisions.DECISION_COLUMNS
    )


def q_review_top(spark, sf):
    review = decisions.filter_decisions(_decisions(spark, sf), decision=DECISION_REVIEW)
    return decisions.top_rows(review, [F.col("ai_risk_probability").desc(), F.col("seq")], REVIEW_TOP_N).select(
        "seq", *decisions.DECISION_COLUMNS
    )


def q_decision_feed(spark, sf):
    return export.decision_feed(_decisions(spark, sf), keep=("seq",))


def q_pseudonymized_export(spark, sf):
    return export.sanitize_decisions(_decisions(spark, sf), EXPORT_SALT)


def q_imputed_signals(spark, sf):
    """AGG-10, NUM-1 and every reason of VAL-1, on signals and ids dirtied by fixed arithmetic."""
    dirty = features.engineer_features(rules.with_error_reason(cleaning.normalize_events(dirty_signals(raw_events(spark, sf)))))
    return dirty.select("seq", "event_id", "interaction_velocity_5m", "account_age_days", "historical_report_rate", "error_reason")


def q_serialized_events(spark, sf):
    """SNK-4: timestamps as millisecond text, blank where a date is bad."""
    return render_timestamps(cleaning.normalize_events(raw_events(spark, sf)).select("seq", "event_id", "created_at", "content"))


def _scored_job(spark, sf):
    """JOB-2 with the stored weights, its tables written; and JOB-3 over these tables."""
    from eventsieve.plans.bi import build_bi_dataset
    from eventsieve.plans.modeling import run_model_job

    job, bi = shared_path(spark, "job"), shared_path(spark, "bi")
    run_model_job(spark, model_events(spark, sf), output_dir=job, stored_model=scoring.REFERENCE_MODEL)
    return build_bi_dataset(spark, job, bi, EXPORT_SALT)


def q_bi_decision_summary(spark, sf):
    """JOB-3, STR-4: decision counts with readable labels, from the BI job's table."""
    return spark.read.parquet(_scored_job(spark, sf)["resumen_decisiones"])


def q_bi_subjects(spark, sf):
    """JOB-3: rows of every table of the BI job, and of those that were left without a user."""
    paths = _scored_job(spark, sf)
    out = None
    for subject, path in paths.items():
        df = spark.read.parquet(path)
        users = F.count_if(F.col("source_user_key") != "") if "source_user_key" in df.columns else F.lit(0).cast("long")
        one = df.agg(F.count(F.lit(1)).alias("n_rows"), users.alias("n_user_keys")).select(F.lit(subject).alias("subject"), "n_rows", "n_user_keys")
        out = one if out is None else out.unionByName(one)
    return out


def _etl(spark, sf):
    from eventsieve.plans.etl import run_etl

    # Names of its own, so that runs side by side do not replace each other's tables.
    return run_etl(spark, raw_events(spark, sf), shared_path(spark, "etl"), table_prefix=f"etl_{uuid.uuid4().hex}_")


def q_etl_job_kpis(spark, sf):
    """JOB-1: the whole ETL job with its defaults, its KPI row without the timings."""
    result = _etl(spark, sf)
    for table in result.tables.values():
        table.drop(spark)
    return result.kpis.drop("input_file", "pipeline_execution_seconds", "processing_rows_per_second", "latency_measurement_type")


def q_measured_run(spark, sf):
    """AGG-2: the rows that the ETL's own writes counted."""
    result = _etl(spark, sf)
    for table in result.tables.values():
        table.drop(spark)
    names = ("input_rows", "events_processed", "valid_events", "rejected_events", "notifications_generated")
    return spark.createDataFrame([tuple(result.counts[n] for n in names)], ", ".join(f"{n} bigint" for n in names))


def q_table_lookups(spark, sf):
    """SNK-3: the three loaded tables asked for sets of users and ids, and for a few of each by value."""
    tables = _etl(spark, sf).tables
    raw = cleaning.normalize_events(raw_events(spark, sf))
    sets = {
        "user": ("target_user_id", raw.filter(F.col("target_user_id") != "").filter(F.md5("target_user_id") < LOOKUP_USERS_BELOW)),
        "id": ("event_id", raw.filter(F.md5("event_id") < LOOKUP_IDS_BELOW)),
    }
    out = None
    for kind, (column, rows) in sets.items():
        keys = materialize(rows.select(column).distinct())
        few = [r[0] for r in keys.orderBy(F.md5(column)).limit(LOOKUP_POINTS).collect()]
        for name, table in tables.items():
            by_value = table.of_users(spark, few) if kind == "user" else table.of_ids(spark, few)
            for lookup, found in ((f"{kind}_set", table.matching(keys, column)), (f"{kind}_value", by_value)):
                found = found.select(F.lit(lookup).alias("lookup"), F.lit(name).alias("table_name"), "event_id", "event_type", "target_user_id", "created_at")
                out = found if out is None else out.unionByName(found)
    found = materialize(out)
    for table in tables.values():
        table.drop(spark)
    return found


def q_reloaded_scores(spark, sf):
    """SNK-5: raw events scored by a pipeline that was saved and read back."""
    from eventsieve.operators.model_stages import PROBABILITY, scoring_pipeline
    from eventsieve.plans.modeling import load_scoring_pipeline

    events = materialize(model_events(spark, sf))
    path = shared_path(spark, "model")
    scoring_pipeline(features.signal_medians(events), linear=scoring.REFERENCE_MODEL).write().save(path)
    p = F.col(PROBABILITY)
    return load_scoring_pipeline(path).transform(events).select(
        "seq", "event_id", "event_type", F.round(p, 4).alias("risk_probability"), F.when(p >= R.threshold, LABEL_RISKY).otherwise(LABEL_VALID).alias("prediction")
    )


def q_feature_contributions(spark, sf):
    """ML-14, SRT-3, SRT-4: the stored weights by size, with what each adds to an event's score on average."""
    from eventsieve.operators.models import FittedCandidate, feature_weights, weights_table

    model = scoring.REFERENCE_MODEL
    z = scoring.standardize(_features(spark, sf), model.mean, model.std)
    means = z.agg(*[F.avg(f"{c}_z").alias(c) for c in FEATURE_COLUMNS])
    mean_of = means.unpivot([], list(FEATURE_COLUMNS), "feature", "mean_z")
    weights = weights_table(spark, feature_weights(FittedCandidate(MODEL_LOGISTIC, None, 0.0, linear=model)))
    ranked = decisions.top_rows(weights, [F.desc("abs_weight"), F.col("feature")], len(FEATURE_COLUMNS))
    return ranked.join(mean_of, "feature").select("feature", "weight", "abs_weight", F.round(F.col("weight") * F.col("mean_z"), 6).alias("mean_contribution"))


def q_gradient_weights(spark, sf):
    """ML-4: the weights after a fixed number of full-batch steps, each one aggregate over the training vectors."""
    from eventsieve.operators.gradient import GradientConfig, fit_by_gradient

    train = scoring.stratified_split(_features(spark, sf).select("seq", *FEATURE_COLUMNS, LABEL_COLUMN)).filter(F.col("split") == "train")
    model = fit_by_gradient(train, GradientConfig(steps=GRADIENT_STEPS, local_vectors=0))
    rows = [("intercept", model.intercept), *zip(model.features, model.weights, strict=True)]
    return spark.createDataFrame([(name, float(w)) for name, w in rows], "feature string, weight double").withColumn("weight", F.round("weight", 6))


def q_forest_expression_scores(spark, sf):
    """ML-6, ML-16: all events scored by a stored forest, compiled into one expression."""
    from eventsieve.operators.trees import STORED_FOREST, score_forest

    p = F.col("probability_risky")
    return score_forest(_features(spark, sf), STORED_FOREST).select(
        "seq", "event_id", F.round(p, 6).alias("risk_probability"), F.when(p >= R.threshold, LABEL_RISKY).otherwise(LABEL_VALID).alias("prediction")
    )


def q_feed_round_trip(spark, sf):
    """SNK-8, JSN-1: the whole payload written, and its metrics, quality table and decisions read back from it."""
    from eventsieve.operators.feed import feed_payload, read_section, write_payload

    feats = _features(spark, sf, *EVENT_COLUMNS)
    decided = materialize(decisions.decide(feats, scoring.REFERENCE_MODEL.probability(), R))
    scored = scoring.stratified_split(feats.withColumn("_p", scoring.REFERENCE_MODEL.probability()).select("seq", LABEL_COLUMN, "_p"))
    test = scored.filter(F.col("split") == "test").select(F.col(LABEL_COLUMN).alias("label"), F.col("_p").alias("probability"))
    metrics = materialize(evaluation.classification_metrics(test, threshold=R.threshold))
    timings = spark.createDataFrame([(0.0,)], "training_seconds double")
    path = shared_path(spark, "feed")
    write_payload(feed_payload(metrics, metrics.withColumn("model", F.lit(MODEL_LOGISTIC)), stats.quality_summary(feats), timings, decided, MODEL_LOGISTIC), path)

    def tall(section, name, text, number):
        return lambda df: df.select(F.lit(section).alias("section"), name.alias("name"), text.alias("text_value"), F.round(number, 6).alias("number_value"))

    nothing, measured = F.lit(None).cast("string"), ["accuracy", "precision", "recall", "f1_score", "roc_auc", "gini", "threshold"]
    kinds = {m: "double" for m in measured} | {"true_positives_risky_detected": "bigint", "false_positives_valid_marked_risky": "bigint"}
    wide = read_section(spark, path, "metrics", kinds)
    found = [
        wide.select(*[F.col(c).cast("double").alias(c) for c in kinds]).unpivot([], list(kinds), "name", "number").transform(
            tall("metrics", F.col("name"), nothing, F.col("number"))),
        read_section(spark, path, "quality", "indicator string, value double, text_value string").transform(
            tall("quality", F.col("indicator"), F.col("text_value"), F.col("value"))),
        read_section(spark, path, "decisions", "event_id string, event_type string, created_at string, ai_risk_probability double, ai_prediction string, final_decision string").transform(
            tall("decisions", F.concat_ws("|", "event_id", "event_type", "created_at"), F.concat_ws("|", "ai_prediction", "final_decision"), F.col("ai_risk_probability"))),
        read_section(spark, path, "selected_model", "selected_model string").transform(
            tall("selected_model", F.lit("selected_model"), F.col("selected_model"), F.lit(None).cast("double"))),
    ]
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    return out


def q_sql_function_decisions(spark, sf):
    """VAL-3..5, HSH-1, DAT-1/2 and the scorer from SQL alone, over the raw model events."""
    from eventsieve.plans.sql_functions import register

    register(spark)
    view = f"es_model_{uuid.uuid4().hex}"
    _features(spark, sf, *EVENT_COLUMNS).createOrReplaceTempView(f"{view}_features")
    arguments = ", ".join(f"f.{c}" for c in FEATURE_COLUMNS)
    return spark.sql(f"""
        SELECT seq, event_id, reason AS rule_error_reason, round(risk, 4) AS ai_risk_probability, es_decision(reason, risk) AS final_decision,
               es_explanation(reason, risk) AS decision_explanation, es_pseudonym(source_user_id, '{EXPORT_SALT}') AS source_user_key,
               es_millis(es_event_time(created_at)) AS created_at
        FROM (SELECT f.*, es_risk({arguments}) AS risk,
                     es_rule_reason(event_id, event_type, source_user_id, target_user_id, created_at, is_duplicate) AS reason
              FROM {view}_features f)""")


def q_streamed_signals(spark, sf):
    """SURVEY 2.13: REA-3 and REA-5 by a keyed-state stream over time slices of the events, flushed by one last event."""
    from eventsieve.sources.driver_tables import read_driver_table
    from eventsieve.streaming.history_stream import start_history_stream

    events = read_driver_table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    span = events.agg(F.min("ts").alias("first"), F.max("ts").alias("last"), F.max("event_id").alias("id")).first()
    source, out, state = (shared_path(spark, name) for name in ("stream-in", "stream-out", "stream-state"))
    if span["first"] is not None:
        step = (span["last"] - span["first"]) / STREAM_SLICES
        for i in range(STREAM_SLICES):
            begin, end = span["first"] + i * step, span["first"] + (i + 1) * step
            own = (F.col("ts") >= F.lit(begin)) & (F.col("ts") < F.lit(end) if i + 1 < STREAM_SLICES else F.lit(True))
            events.filter(own).write.mode("append").parquet(source)
        last = spark.createDataFrame([(span["id"] + 1, span["last"] + timedelta(days=1), -1, "flush")], events.schema)
        last.write.mode("append").parquet(source)
    else:
        events.write.parquet(source)
    start_history_stream(spark, source, out, state, F.col("event_type") == R.report_event_type).awaitTermination()
    found = spark.read.schema("user_id long, event_id long, interaction_velocity_5m long, historical_report_rate double").parquet(out)
    return materialize(found.filter("user_id <> -1 or user_id is null").select(
        F.col("event_id").alias("seq"), "interaction_velocity_5m", F.round("historical_report_rate", 6).alias("historical_report_rate")))


def q_merged_increments(spark, sf):
    """AGG-3, AGG-4, AGG-12: quality statistics from the merged states of ten slices, held against all rows."""
    from eventsieve.operators.increments import DISTINCT_ERROR, RANK_ERROR, batch_state, merge_states, rank_errors, state_summary

    feats = _features(spark, sf)
    states = [batch_state(feats.filter(F.pmod("seq", F.lit(INCREMENTS)) == i), STATISTIC_COLUMNS) for i in range(INCREMENTS)]
    merged = states[0]
    for state in states[1:]:
        merged = merged.unionByName(state)
    summary = materialize(state_summary(merge_states(materialize(merged))))
    ranks = rank_errors(feats, summary).groupBy("column").agg(F.max("rank_error").alias("worst"))
    exact = feats.agg(*[F.count_distinct(c).alias(c) for c in STATISTIC_COLUMNS]).unpivot([], list(STATISTIC_COLUMNS), "column", "exact")
    return summary.join(ranks, "column", "left").join(exact, "column").select(
        "column", "n", "nulls", F.round("mean", 6).alias("mean"), "low", "high",
        (F.coalesce("worst", F.lit(0.0)) <= RANK_ERROR).cast("int").alias("quantiles_within_bound"),
        (F.abs(F.col("distinct") - F.col("exact")) <= DISTINCT_ERROR * F.col("exact")).cast("int").alias("distinct_within_bound"),
    )


SQL_CHECKED: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clean_events": q_clean_events,
    "duplicate_flags": q_duplicate_flags,
    "valid_events": q_valid_events,
    "rejected_events": q_rejected_events,
    "rejection_reasons": q_rejection_reasons,
    "notifications": q_notifications,
    "kpi_report": q_kpi_report,
    "recent_events": q_recent_events,
    "recent_by_type": q_recent_by_type,
    "velocity": q_velocity,
    "account_age": q_account_age,
    "report_rate": q_report_rate,
    "risk_label": q_risk_label,
    "feature_matrix": q_feature_matrix,
    "event_type_counts": q_event_type_counts,
    "label_counts": q_label_counts,
    "risk_by_event_type": q_risk_by_event_type,
    "distinct_event_types": q_distinct_event_types,
    "quality_summary": q_quality_summary,
    "quality_statistics": q_quality_statistics,
    "quality_operational": q_quality_operational,
    "correlation_matrix": q_correlation_matrix,
    "stratified_split": q_stratified_split,
    "standardized_features": q_standardized_features,
    "linear_scores": q_linear_scores,
    "new_event_scores": q_new_event_scores,
    "test_predictions": q_test_predictions,
    "confusion_matrix": q_confusion_matrix,
    "roc_curve": q_roc_curve,
    "model_metrics": q_model_metrics,
    "model_selection": q_model_selection,
    "rule_reasons": q_rule_reasons,
    "final_decisions": q_final_decisions,
    "decision_summary": q_decision_summary,
    "decision_group_counts": q_decision_group_counts,
    "decision_filter": q_decision_filter,
    "review_top": q_review_top,
    "decision_feed": q_decision_feed,
    "pseudonymized_export": q_pseudonymized_export,
    "imputed_signals": q_imputed_signals,
    "serialized_events": q_serialized_events,
    "bi_decision_summary": q_bi_decision_summary,
    "bi_subjects": q_bi_subjects,
    "etl_job_kpis": q_etl_job_kpis,
    "measured_run": q_measured_run,
    "table_lookups": q_table_lookups,
    "reloaded_scores": q_reloaded_scores,
    "feature_contributions": q_feature_contributions,
    "gradient_weights": q_gradient_weights,
    "forest_expression_scores": q_forest_expression_scores,
    "feed_round_trip": q_feed_round_trip,
    "sql_function_decisions": q_sql_function_decisions,
    "merged_increments": q_merged_increments,
    "streamed_signals": q_streamed_signals,
}

def _fitted(spark, sf, names):
    """Split features and the fitted candidates asked for (ML-1..4, ML-6)."""
    from eventsieve.operators import models
    from eventsieve.plans.modeling import fit_candidates

    from eventsieve.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    # The fits iterate over the training rows: the features are stored, and the
    # split is an expression on them, so no pass reads the history windows again.
    split = _split(spark, sf)
    train = split.filter(F.col("split") == "train")
    test = split.filter(F.col("split") == "test")
    mean, std = scoring.train_statistics(train)
    return split, test, mean, std, fit_candidates(train, mean, std, R, names), models


def _evaluated(spark, sf, name):
    from eventsieve.plans.modeling import _prepare_for

    _, test, mean, std, cands, models = _fitted(spark, sf, (name,))
    cand = cands[name]
    return models.evaluate(cand, _prepare_for(cand, test, mean, std), R.threshold)


def q_logistic_model(spark, sf):
    """ML-4 + ML-9: evaluation row of the fitted logistic regression."""
    return _evaluated(spark, sf, MODEL_LOGISTIC)


def q_random_forest_model(spark, sf):
    """ML-6 + ML-9: evaluation row of the fitted random forest."""
    from eventsieve.config import MODEL_FOREST

    return _evaluated(spark, sf, MODEL_FOREST)


def q_model_comparison(spark, sf):
    """ML-10/11/12: three candidates on the same split, with ``selected``."""
    from eventsieve.operators.models import select_model
    from eventsieve.plans.modeling import _prepare_for

    _, test, mean, std, cands, models = _fitted(spark, sf, (MODEL_BASELINE, MODEL_LOGISTIC, MODEL_FOREST))
    rows = [models.evaluate(c, _prepare_for(c, test, mean, std), R.threshold) for c in cands.values()]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return select_model(out)


def q_feature_weights(spark, sf):
    """ML-14 / SRT-3: weights of the fitted logistic model by |weight|."""
    _, _, _, _, cands, models = _fitted(spark, sf, (MODEL_LOGISTIC,))
    return models.weights_table(spark, models.feature_weights(cands[MODEL_LOGISTIC]))


def q_top_features(spark, sf):
    """SRT-4: the ten largest fitted logistic weights by |weight|."""
    _, _, _, _, cands, models = _fitted(spark, sf, (MODEL_LOGISTIC,))
    weights = models.weights_table(spark, models.feature_weights(cands[MODEL_LOGISTIC]))
    return decisions.top_rows(weights, [F.desc("abs_weight"), F.col("feature")], 10)


def q_all_event_decisions(spark, sf):
    """ML-16 + VAL-4: every event scored by the fitted forest, rules first."""
    from eventsieve.config import MODEL_FOREST
    from eventsieve.plans.modeling import _prepare_for

    from eventsieve.operators import models
    from eventsieve.plans.modeling import _prepare
    from eventsieve.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    model = model_events(spark, sf).withColumn("_raw_type", F.col("event_type"))
    columns = ["seq", "event_id", "_raw_type", *FEATURE_COLUMNS, LABEL_COLUMN, *EVENT_COLUMNS]
    split = scoring.stratified_split(features.stored_features(model, columns))
    train = split.filter(F.col("split") == "train")
    mean, std = scoring.train_statistics(train)
    forest = models.fit_forest(_prepare(models.spread_evenly(train), MODEL_FOREST, mean, std), R)
    scored = models.predict(forest, _prepare_for(forest, split, mean, std))
    return decisions.decide(scored.withColumn("event_type", F.col("_raw_type")), F.col("probability_risky"), R, keep=("seq",))


# Fitted models: no SQL equivalent (iterative optimisers), rows-only check.
ROWS_ONLY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "logistic_model": q_logistic_model,
    "random_forest_model": q_random_forest_model,
    "model_comparison": q_model_comparison,
    "feature_weights": q_feature_weights,
    "top_features": q_top_features,
    "all_event_decisions": q_all_event_decisions,
}
