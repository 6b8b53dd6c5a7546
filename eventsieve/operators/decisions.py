"""Rules-plus-model decisions (VAL-3..6, FLT-6, FLT-7, SRT-5, PRJ-5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventsieve.config import (
    DECISION_APPROVED,
    DECISION_REJECTED,
    DECISION_REVIEW,
    DEFAULT_RULES,
    EXPLANATION_APPROVED,
    EXPLANATION_REJECTED_PREFIX,
    EXPLANATION_REVIEW,
    FILTER_BLANK_TYPE,
    LABEL_RISKY,
    LABEL_VALID,
    RuleConfig,
)
from eventsieve.operators.rules import decision_rule_reason

DECISION_COLUMNS = (
    "event_id",
    "event_type",
    "source_user_id",
    "target_user_id",
    "created_at",
    "is_duplicate",
    "rule_error_reason",
    "ai_risk_probability",
    "ai_prediction",
    "final_decision",
    "decision_explanation",
)


def decide(events: DataFrame, probability: Column, rules: RuleConfig = DEFAULT_RULES, keep: tuple[str, ...] = ()) -> DataFrame:
    """VAL-4/5: rules first, then the rounded risk, else approve.

    ``ai_prediction`` uses the raw probability, the decision the one rounded
    to 4 places (so 0.49996 is ``valido`` yet sent to review)."""
    t = float(rules.threshold)
    with_p = events.withColumn("_p", probability).withColumn("rule_error_reason", decision_rule_reason(rules))
    rounded = F.round("_p", 4)
    decision = (
        F.when(F.col("rule_error_reason") != "", DECISION_REJECTED)
        .when(rounded >= t, DECISION_REVIEW)
        .otherwise(DECISION_APPROVED)
    )
    explanation = (
        F.when(decision == DECISION_REJECTED, F.concat(F.lit(EXPLANATION_REJECTED_PREFIX), F.col("rule_error_reason")))
        .when(decision == DECISION_REVIEW, EXPLANATION_REVIEW)
        .otherwise(EXPLANATION_APPROVED)
    )
    return with_p.select(
        *[c for c in DECISION_COLUMNS[:6]],
        "rule_error_reason",
        rounded.alias("ai_risk_probability"),
        F.when(F.col("_p") >= t, LABEL_RISKY).otherwise(LABEL_VALID).alias("ai_prediction"),
        decision.alias("final_decision"),
        explanation.alias("decision_explanation"),
        *keep,
    )


def filter_decisions(decisions: DataFrame, event_type: str | None = None, decision: str | None = None) -> DataFrame:
    """FLT-6: optional AND-ed filters; blank type compared as ``sin_tipo``."""
    out = decisions
    if event_type:
        shown = F.when(F.coalesce(F.col("event_type"), F.lit("")) == "", FILTER_BLANK_TYPE).otherwise(F.col("event_type"))
        out = out.filter(shown == event_type)
    if decision:
        out = out.filter(F.col("final_decision") == decision)
    return out


def top_rows(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """SRT-4/5: first ``n`` rows in a stable order (``TakeOrderedAndProject``)."""
    return df.orderBy(*order).limit(n)
