"""Features, scoring, evaluation, decisions and export on literal rows."""

import hashlib

from pyspark.sql import functions as F

from eventsieve.operators.decisions import decide, filter_decisions
from eventsieve.operators.evaluation import classification_metrics, confusion_matrix, roc_curve
from eventsieve.operators.export import decision_feed, sanitize_decisions
from eventsieve.operators.features import engineer_features
from eventsieve.operators.models import select_model
from eventsieve.operators.scoring import score_linear

EVENTS = "event_id string, event_type string, source_user_id string, target_user_id string, created_at string, content string, is_duplicate int"


def test_features_flags(spark):
    df = spark.createDataFrame(
        [("e1", "LIKE", "u1", "u2", "2026-05-20 10:15:00", "", 0),
         ("e2", "share", "u3", "", "fecha-invalida", "texto", 0)], EVENTS)
    rows = {r.event_id: r for r in engineer_features(df).collect()}
    assert rows["e1"].is_allowed_event_type == 1 and rows["e1"].event_type_like == 1
    assert rows["e1"].hour == 10 and rows["e1"].day_of_week == 2
    assert rows["e2"].event_type_invalid == 1 and rows["e2"].has_target_user == 0
    assert rows["e2"].has_valid_date == 0 and rows["e2"].hour == -1 and rows["e2"].content_length == 5
    assert rows["e1"].interaction_velocity_5m == 0.0  # absent signal -> 0.0


def test_median_imputation_ignores_bad_values(spark):
    df = spark.createDataFrame(
        [("e1", "like", "u", "t", "2026-05-20 10:15:00", "", 0, "4"), ("e2", "like", "u", "t", "x", "", 0, "nan"),
         ("e3", "like", "u", "t", "x", "", 0, "10"), ("e4", "like", "u", "t", "x", "", 0, "abc")],
        EVENTS + ", interaction_velocity_5m string")
    vals = {r.event_id: r.interaction_velocity_5m for r in engineer_features(df).collect()}
    assert vals == {"e1": 4.0, "e2": 7.0, "e3": 10.0, "e4": 7.0}


def test_new_event_scores_match_published(spark):
    df = spark.createDataFrame([
        ("new-001", "like", "u150", "u250", "2026-05-20 10:15:00", "", 0),
        ("new-002", "share", "u151", "u251", "2026-05-20 10:16:00", "evento externo", 0),
        ("new-003", "comment", "u152", "", "2026-05-20 10:17:00", "Hola", 0),
        ("new-004", "follow", "u153", "u253", "fecha-invalida", "", 0),
    ], EVENTS)
    scored = {r.event_id: (r.risk_probability, r.prediction) for r in score_linear(engineer_features(df)).collect()}
    assert scored == {"new-001": (0.0, "valido"), "new-002": (0.0022, "valido"),
                      "new-003": (0.0002, "valido"), "new-004": (0.8231, "riesgoso")}


def test_auc_four_points(spark):
    scored = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)], "label int, probability double")
    m = classification_metrics(scored).first()
    assert m.roc_auc == 0.75 and m.gini == 0.5
    points = sorted(roc_curve(scored).collect())
    assert [r.point for r in points] == list(range(6))
    pts = [(r.false_positive_rate, r.true_positive_rate) for r in points]
    assert pts[0] == (0.0, 0.0) and pts[-1] == (1.0, 1.0) and len(pts) == 6


def test_confusion_and_empty_class_guards(spark):
    scored = spark.createDataFrame([(1, 0.9), (1, 0.2)], "label int, probability double")
    m = classification_metrics(scored).first()
    assert (m.true_positives_risky_detected, m.false_negatives_risky_marked_valid) == (1, 1)
    assert m.precision == 1.0 and m.recall == 0.5
    cm = {r.real_class: (r.pred_valido, r.pred_riesgoso) for r in confusion_matrix(scored).collect()}
    assert cm == {"real_riesgoso": (1, 1)}


def test_rules_beat_model_and_rounding(spark):
    df = spark.createDataFrame([
        ("e1", "share", "u1", "", "fecha-invalida", "", 0),
        ("e2", "like", "u1", "u2", "2026-05-20 10:00:00", "", 0),
        ("e3", "like", "u1", "u2", "2026-05-20 10:00:00", "", 0),
        ("e4", "like", "u1", "u2", "2026-05-20 10:00:00", "", 1),
    ], EVENTS)
    probs = F.when(F.col("event_id") == "e2", 0.49996).when(F.col("event_id") == "e3", 0.1).otherwise(0.99)
    rows = {r.event_id: r for r in decide(df, probs).collect()}
    assert rows["e1"].final_decision == "rechazado_por_reglas"
    assert rows["e1"].rule_error_reason == "tipo de evento fuera del alcance; target_user_id vacio; fecha invalida"
    assert rows["e1"].decision_explanation.startswith("No pasa reglas duras del pipeline: tipo de evento")
    assert (rows["e2"].ai_prediction, rows["e2"].final_decision) == ("valido", "revision_por_ia")
    assert rows["e3"].final_decision == "aprobado_para_notificar"
    assert rows["e4"].rule_error_reason == "evento duplicado"
    assert filter_decisions(decide(df, probs), "like", "revision_por_ia").count() == 1


def test_pseudonymized_export_has_no_ids_or_content(spark):
    df = spark.createDataFrame([("e1", "like", "u1", "nan", "2026-05-20 10:00:00", "secret text", 0)], EVENTS)
    out = sanitize_decisions(decide(df.drop("content").withColumn("content", F.lit("x")), F.lit(0.1), keep=("content",)), "salt")
    assert "source_user_id" not in out.columns and "content" not in out.columns
    row = out.first()
    assert row.source_user_key == "usr_" + hashlib.sha256(b"salt:u1").hexdigest()[:10]
    assert row.target_user_key == ""
    assert decision_feed(decide(df, F.lit(0.1))).columns == [
        "event_id", "event_type", "created_at", "ai_risk_probability", "ai_prediction", "final_decision"]


def test_model_selection_prefers_logistic_within_margin(spark):
    cmp = spark.createDataFrame([
        ("baseline_clase_mayoritaria", 0.6813, 0.5, 1.0),
        ("regresion_logistica", 0.8814, 0.9711, 0.8387),
        ("random_forest", 0.9538, 0.9967, 1.0),
    ], "model string, f1_score double, roc_auc double, recall double")
    sel = {r.model: r.selected for r in select_model(cmp).collect()}
    assert sel == {"baseline_clase_mayoritaria": 0, "regresion_logistica": 0, "random_forest": 1}
    close = cmp.withColumn("f1_score", F.when(F.col("model") == "regresion_logistica", 0.93).otherwise(F.col("f1_score")))
    assert {r.model: r.selected for r in select_model(close).collect()}["regresion_logistica"] == 1
