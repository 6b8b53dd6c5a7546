"""Rule validation and routing (QG-1, QG-2, VAL-1..3, SET-1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventsieve.config import (
    DEFAULT_RULES,
    MSG_DATE_INVALID,
    MSG_DUPLICATE,
    MSG_EVENT_ID_BLANK,
    MSG_SOURCE_BLANK,
    MSG_TARGET_BLANK,
    MSG_TYPE_INVALID,
    MSG_TYPE_OUT_OF_SCOPE,
    REASON_SEPARATOR,
    RuleConfig,
)
from eventsieve.functions.numeric import parse_flag
from eventsieve.functions.text import is_blank, join_reasons, strip_ws
from eventsieve.functions.timestamps import parse_timestamp


class QualityGateError(ValueError):
    """Raised when an input fails a volume or schema gate."""


def require_columns(df: DataFrame, required) -> None:
    """QG-2: abort listing the sorted missing names (driver-side, no job)."""
    missing = sorted(set(required).difference(df.columns))
    if missing:
        raise QualityGateError(f"Columnas obligatorias ausentes: {', '.join(missing)}")


def require_min_rows(df: DataFrame, minimum: int) -> int:
    """QG-1: stop after ``minimum`` rows are seen (``limit`` ends the scan early)."""
    seen = df.limit(minimum).count()
    if seen < minimum:
        raise QualityGateError(
            f"Se exigen al menos {minimum} registros de entrada; se encontraron {seen}."
        )
    return seen


def etl_error_reason(rules: RuleConfig = DEFAULT_RULES) -> Column:
    """VAL-1: ordered failures joined with ``"; "`` ('' when the row passes).

    Expects cleaned input (trimmed strings, parsed ``created_at``)."""
    return join_reasons(
        REASON_SEPARATOR,
        (is_blank("event_id"), MSG_EVENT_ID_BLANK),
        (~F.coalesce(F.col("event_type").isin(*rules.allowed_event_types), F.lit(False)), MSG_TYPE_INVALID),
        (is_blank("source_user_id"), MSG_SOURCE_BLANK),
        (is_blank("target_user_id"), MSG_TARGET_BLANK),
        (F.col("created_at").isNull(), MSG_DATE_INVALID),
    )


def decision_rule_reason(rules: RuleConfig = DEFAULT_RULES) -> Column:
    """VAL-3: the decision-time rule set on raw text columns (trims and
    parses itself), with the out-of-scope type text and the duplicate rule."""
    event_type = F.lower(F.coalesce(strip_ws(F.col("event_type").cast("string")), F.lit("")))
    return join_reasons(
        REASON_SEPARATOR,
        (is_blank("event_id"), MSG_EVENT_ID_BLANK),
        (~event_type.isin(*rules.allowed_event_types), MSG_TYPE_OUT_OF_SCOPE),
        (is_blank("source_user_id"), MSG_SOURCE_BLANK),
        (is_blank("target_user_id"), MSG_TARGET_BLANK),
        (parse_timestamp(F.col("created_at").cast("string")).isNull(), MSG_DATE_INVALID),
        (parse_flag("is_duplicate") == 1, MSG_DUPLICATE),
    )


def with_error_reason(processed: DataFrame, rules: RuleConfig = DEFAULT_RULES) -> DataFrame:
    require_columns(processed, rules.required_columns)
    return processed.withColumn("error_reason", etl_error_reason(rules))


def split_valid_rejected(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """VAL-2 / SET-1: complementary subsets; rejected keeps ``error_reason``."""
    valid = checked.filter(F.col("error_reason") == "").drop("error_reason")
    rejected = checked.filter(F.col("error_reason") != "")
    return valid, rejected


def validate_events(processed: DataFrame, rules: RuleConfig = DEFAULT_RULES) -> tuple[DataFrame, DataFrame]:
    return split_valid_rejected(with_error_reason(processed, rules))
