"""Rule configuration and the fixed values the outputs must reproduce.

Everything here is data, not logic: allowed event types, message texts,
feature order and the stored reference linear model.  Operators take a
``RuleConfig`` so a deployment can change thresholds without code edits.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --------------------------------------------------------------------------
# Fixed values (must equal the reference's output texts and order exactly).
# --------------------------------------------------------------------------
ALLOWED_EVENT_TYPES = ("like", "comment", "follow")
REQUIRED_ETL_COLUMNS = (
    "event_id",
    "event_type",
    "source_user_id",
    "target_user_id",
    "created_at",
    "content",
)
REQUIRED_MODEL_COLUMNS = REQUIRED_ETL_COLUMNS + (
    "interaction_velocity_5m",
    "account_age_days",
    "historical_report_rate",
    "is_duplicate",
    "historical_feedback_risk",
    "label_risky_event",
)
MINIMUM_INPUT_ROWS = 200

NOTIFICATION_TEMPLATES = {
    "like": " reacciono a tu publicacion",
    "comment": " comento tu publicacion",
    "follow": " comenzo a seguirte",
}
UNSUPPORTED_EVENT_TEXT = "evento no soportado"
NOTIFICATION_PREFIX = "ntf-"
DELIVERY_STATUS_SENT = "sent"
LATENCY_MEASUREMENT_TYPE = "simulada_para_demo"

# ETL rule messages, in evaluation order.
MSG_EVENT_ID_BLANK = "event_id vacio"
MSG_TYPE_INVALID = "tipo de evento invalido"
MSG_SOURCE_BLANK = "source_user_id vacio"
MSG_TARGET_BLANK = "target_user_id vacio"
MSG_DATE_INVALID = "fecha invalida"
# Decision-time rule set: same order, other type text, plus duplicates.
MSG_TYPE_OUT_OF_SCOPE = "tipo de evento fuera del alcance"
MSG_DUPLICATE = "evento duplicado"
REASON_SEPARATOR = "; "

DECISION_REJECTED = "rechazado_por_reglas"
DECISION_REVIEW = "revision_por_ia"
DECISION_APPROVED = "aprobado_para_notificar"
EXPLANATION_REJECTED_PREFIX = "No pasa reglas duras del pipeline: "
EXPLANATION_REVIEW = "Pasa reglas duras, pero el modelo IA estima riesgo alto."
EXPLANATION_APPROVED = "Pasa reglas duras y el modelo IA estima riesgo bajo."
LABEL_RISKY = "riesgoso"
LABEL_VALID = "valido"
BLANK_TYPE_LABEL = "vacio"
FILTER_BLANK_TYPE = "sin_tipo"
GROUP_BLANK_VALUE = "sin_valor"
IMPUTATION_NOTE = "mediana para senales numericas; indicadores explicitos para nulos estructurales"

FEATURE_COLUMNS = (
    "content_length",
    "hour",
    "day_of_week",
    "interaction_velocity_5m",
    "account_age_days",
    "historical_report_rate",
    "is_duplicate",
    "has_source_user",
    "has_target_user",
    "has_valid_date",
    "is_allowed_event_type",
    "event_type_like",
    "event_type_comment",
    "event_type_follow",
    "event_type_invalid",
)
LABEL_COLUMN = "label_risky_event"
NUMERIC_SIGNALS = ("interaction_velocity_5m", "account_age_days", "historical_report_rate")
FLAG_COLUMNS = ("is_duplicate", "historical_feedback_risk", "label_risky_event")
STATISTIC_COLUMNS = ("content_length", "interaction_velocity_5m", "account_age_days", "historical_report_rate")
STATISTIC_SUFFIX_PATTERN = r"_(?:mean|median|mode|p25|p75)$"

MODEL_BASELINE = "baseline_clase_mayoritaria"
MODEL_LOGISTIC = "regresion_logistica"
MODEL_FOREST = "random_forest"
SELECTION_MARGIN = 0.03

# Stored linear model of the reference run (intercept first, then one weight
# per FEATURE_COLUMNS entry; mean/std are the training statistics).  Used to
# score with fixed weights so results are comparable with the published
# new-event scores.
REFERENCE_WEIGHTS = (
    0.40981972, 0.96618168, -0.63369206, -0.37422497, 1.37684895, 0.43907787,
    2.21697001, 0.0, -0.66500202, -0.61223989, -0.37422497, -0.66678607,
    -0.12808314, -0.41010562, 0.21146752, 0.66678607,
)
REFERENCE_MEAN = (
    5.27857143, 12.64285714, -0.01428571, 23.5, 750.8, 0.152, 0.0, 0.99285714,
    0.98571429, 0.98571429, 0.94285714, 0.36428571, 0.3, 0.27857143, 0.05714286,
)
REFERENCE_STD = (
    8.18453931, 3.55783126, 0.11866606, 13.05017789, 433.58919333, 0.08632331,
    1.0, 0.08421304, 0.11866606, 0.11866606, 0.23211538, 0.48122929,
    0.45825757, 0.44829609, 0.23211538,
)
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class RuleConfig:
    """Parameters of the rule, history and model steps."""

    allowed_event_types: tuple[str, ...] = ALLOWED_EVENT_TYPES
    required_columns: tuple[str, ...] = REQUIRED_ETL_COLUMNS
    minimum_input_rows: int = MINIMUM_INPUT_ROWS
    threshold: float = 0.5
    # Simulated delivery latency: 2 + (position % 4) seconds.
    latency_base_seconds: int = 2
    latency_cycle: int = 4
    # History signals (re-aimed from the reference's generator).
    velocity_window_seconds: int = 300
    report_event_type: str = "error"
    velocity_risk_min: float = 34.0
    report_rate_risk_min: float = 0.22
    young_account_max_days: float = 21.0
    young_account_report_rate_min: float = 0.10
    # Model step.
    test_fraction: float = 0.30
    seed: int = 42
    logistic_max_iterations: int = 200
    logistic_l2: float = 0.01
    forest_trees: int = 200
    forest_max_depth: int = 8
    forest_min_leaf: int = 3
    forest_max_bins: int = 32  # split candidates per feature, from a sample of the rows
    feature_columns: tuple[str, ...] = field(default=FEATURE_COLUMNS)


DEFAULT_RULES = RuleConfig()
