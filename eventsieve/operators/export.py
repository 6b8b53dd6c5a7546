"""Pseudonymised BI export (HSH-2, HSH-3, PRJ-6, SNK-8 payload, JSN-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventsieve.functions.hashing import pseudonymize

KEEP, PSEUDONYMIZE, EXCLUDE = "keep", "pseudonymize", "exclude"

# Default column policy of the decision export: users are keyed, free text
# never leaves the job.
DECISION_EXPORT_POLICY = {
    "source_user_id": PSEUDONYMIZE,
    "target_user_id": PSEUDONYMIZE,
    "content": EXCLUDE,
}
KEY_NAMES = {"source_user_id": "source_user_key", "target_user_id": "target_user_key"}


def apply_export_policy(df: DataFrame, policy: dict[str, str], salt: str, key_names: dict[str, str] | None = None) -> DataFrame:
    """HSH-3: one ``select``: kept columns as is, pseudonymised columns replaced
    by ``<name>`` keys appended at the end, excluded columns dropped."""
    key_names = key_names or KEY_NAMES
    kept = [c for c in df.columns if policy.get(c, KEEP) == KEEP]
    keys = [
        pseudonymize(c, salt).alias(key_names.get(c, f"{c}_key"))
        for c in df.columns
        if policy.get(c) == PSEUDONYMIZE
    ]
    return df.select(*kept, *keys)


def sanitize_decisions(decisions: DataFrame, salt: str) -> DataFrame:
    """HSH-2: add ``source_user_key``/``target_user_key``, drop both ids."""
    return apply_export_policy(decisions, DECISION_EXPORT_POLICY, salt)


FEED_COLUMNS = ("event_id", "event_type", "created_at", "ai_risk_probability", "ai_prediction", "final_decision")


def decision_feed(decisions: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """SNK-8: the six dashboard columns, without user ids."""
    return decisions.select(*keep, *FEED_COLUMNS)


def as_json_lines(df: DataFrame, out: str = "json") -> DataFrame:
    """JSN-1: one JSON document per row (``to_json(struct(*))``)."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(out))
