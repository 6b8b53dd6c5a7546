"""Golden checks against the reference run's committed output files.

The files are read as data (nothing of the reference is executed); the
tests skip when the reference copy is absent.
"""

import csv
import glob
import os

import pytest
from pyspark.sql import functions as F

from eventsieve.config import FEATURE_COLUMNS, LABEL_COLUMN
from eventsieve.operators.cleaning import clean_transform
from eventsieve.operators.decisions import decide
from eventsieve.operators.evaluation import classification_metrics, roc_curve
from eventsieve.operators.features import engineer_features
from eventsieve.operators.notifications import generate_notifications
from eventsieve.operators.rules import validate_events
from eventsieve.operators.stats import correlation_matrix, quality_summary
from eventsieve.sources.readers import read_raw_csv
from tests.conftest import REFERENCE_DATA

pytestmark = pytest.mark.skipif(not os.path.isdir(REFERENCE_DATA), reason="reference data not present")


def ref(path):
    return os.path.join(REFERENCE_DATA, path)


def read_csv_rows(path):
    with open(ref(path), newline="", encoding="utf-8") as fh:
        return list(csv.DictReader(fh))


@pytest.fixture(scope="module")
def raw(spark):
    (path,) = glob.glob(ref("ai/*_events.csv"))
    return read_raw_csv(spark, path)


def test_etl_counts_and_notifications(spark, raw):
    valid, rejected = validate_events(clean_transform(raw))
    assert (valid.count(), rejected.count()) == (180, 20)
    expected_reasons = {r["event_id"]: r["error_reason"] for r in read_csv_rows("reports/validation_errors.csv")}
    got = {r.event_id: r.error_reason for r in rejected.collect()}
    assert got == expected_reasons
    expected = [tuple(r.values()) for r in read_csv_rows("reports/notifications.csv")]
    notes = generate_notifications(valid).select(
        *[F.col(c).cast("string") for c in ("notification_id", "event_id", "event_type", "target_user_id", "message",
                                             "delivery_status", "created_at", "delivered_at", "latency_seconds")]
    )
    assert sorted(tuple(r) for r in notes.collect()) == sorted(expected)


def test_feature_matrix(spark, raw):
    feats = engineer_features(raw).select(*FEATURE_COLUMNS, LABEL_COLUMN)
    got = sorted(tuple(float(v) for v in r) for r in feats.collect())
    expected = sorted(tuple(float(r[c]) for c in [*FEATURE_COLUMNS, LABEL_COLUMN]) for r in read_csv_rows("ai/feature_matrix.csv"))
    assert got == expected


def test_quality_summary(spark, raw):
    rows = {r.indicator: (r.value, r.text_value) for r in quality_summary(engineer_features(raw)).collect()}
    for r in read_csv_rows("reports/ai/quality_summary.csv"):
        value, text = rows[r["indicator"]]
        if r["indicator"] == "imputation_strategy":
            assert text == r["value"]
        else:
            assert value == pytest.approx(float(r["value"]), abs=1e-9), r["indicator"]
    assert len(rows) == 29


def test_correlation_matrix(spark, raw):
    cells = {(r.row_feature, r.column_feature): r.correlation for r in correlation_matrix(engineer_features(raw)).collect()}
    for r in read_csv_rows("reports/ai/correlation_matrix.csv"):
        row_name = r[""]
        for col_name, text in r.items():
            if col_name == "":
                continue
            if text == "":
                assert cells[(row_name, col_name)] is None
            else:
                assert cells[(row_name, col_name)] == pytest.approx(float(text), abs=1e-12)


def test_decisions_from_published_probabilities(spark, raw):
    probs = spark.createDataFrame(
        [(r["event_id"], float(r["ai_risk_probability"]), r["final_decision"], r["rule_error_reason"])
         for r in read_csv_rows("reports/ai/final_event_decisions.csv")],
        "event_id string, p double, expected string, expected_reason string",
    )
    decided = decide(raw.join(probs, "event_id"), F.col("p"), keep=("expected", "expected_reason"))
    assert decided.filter(F.col("final_decision") != F.col("expected")).count() == 0
    assert decided.filter(F.col("rule_error_reason") != F.col("expected_reason")).count() == 0
    counts = dict((r[0], r[1]) for r in decided.groupBy("final_decision").count().collect())
    assert counts == {"rechazado_por_reglas": 20, "revision_por_ia": 87, "aprobado_para_notificar": 93}


def test_metrics_on_published_test_predictions(spark):
    rows = [(int(r["real_label_risky_event"]), float(r["risk_probability"])) for r in read_csv_rows("reports/ai/test_predictions.csv")]
    scored = spark.createDataFrame(rows, "label int, probability double")
    m = classification_metrics(scored).first()
    assert (m.true_negatives_valid_detected, m.false_positives_valid_marked_risky,
            m.false_negatives_risky_marked_valid, m.true_positives_risky_detected) == (26, 3, 0, 31)
    assert (m.accuracy, m.precision, m.recall, m.f1_score) == (0.95, 0.9118, 1.0, 0.9538)
    assert m.roc_auc == pytest.approx(0.9967, abs=1e-4)
    assert roc_curve(scored).count() >= 60
