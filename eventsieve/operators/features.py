"""Feature engineering (PRJ-8..11, PRJ-10, NUM-1/2, DAT-4/5, AGG-10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventsieve.config import (
    BLANK_TYPE_LABEL,
    DEFAULT_RULES,
    FLAG_COLUMNS,
    LABEL_RISKY,
    LABEL_VALID,
    NUMERIC_SIGNALS,
    RuleConfig,
)
from eventsieve.functions.numeric import parse_flag, parse_number
from eventsieve.functions.text import is_blank, strip_ws
from eventsieve.functions.timestamps import hour_or_missing, parse_timestamp, weekday_or_missing
from eventsieve.operators.rules import require_columns
from eventsieve.session import materialize

FEATURE_INPUT_COLUMNS = ("event_type", "source_user_id", "target_user_id", "created_at", "content")


def signal_medians(df: DataFrame, columns=NUMERIC_SIGNALS, default: float = 0.0, read=parse_number) -> dict[str, float]:
    """AGG-10: exact batch median per signal, ignoring unparsable values;
    ``default`` when a column is absent or has no parsable value.  ``read``
    takes a column's name to its number, null where there is none.

    Computed by the sort-based exact quantile (no per-value map in one task)."""
    from eventsieve.operators.stats import exact_quantiles

    present = [c for c in columns if c in df.columns]
    medians = {c: default for c in columns}
    if present:
        # One partial-aggregated pass: medians are only needed for columns
        # with an unparsable value (the quantile sort is skipped otherwise).
        missing = df.agg(*[F.count_if(read(c).isNull()).alias(c) for c in present]).first()
        present = [c for c in present if missing[c] > 0]
    if present:
        long = df.select(
            F.explode(F.array(*[F.struct(F.lit(c).alias("name"), read(c).alias("value")) for c in present])).alias("kv")
        ).select("kv.name", "kv.value")
        for row in exact_quantiles(long, (0.5,)).collect():  # one row per column
            if row["value"] is not None:
                medians[row["name"]] = float(row["value"])
    return medians


def engineer_features(
    events: DataFrame,
    rules: RuleConfig = DEFAULT_RULES,
    medians: dict[str, float] | None = None,
) -> DataFrame:
    """PRJ-10: the 15 model features plus cleaned flags, in one ``select``.

    ``medians`` imputes unparsable signals; by default they are taken from
    this batch (as the reference does); pass fitted medians to score new
    batches consistently.  Absent signals default to 0.0, absent flags to 0.
    """
    if medians is None:
        medians = signal_medians(events)
    df, derived = _derived(events, rules)
    for c in NUMERIC_SIGNALS:
        derived[c] = F.coalesce(derived[c], F.lit(float(medians.get(c, 0.0))))
    return df.withColumns(derived)


def stored_features(events: DataFrame, columns: Sequence[str], rules: RuleConfig = DEFAULT_RULES) -> DataFrame:
    """PRJ-10 with this batch's medians, stored: only ``columns`` are written and read again.

    The medians are taken from the stored rows, so the events are read once."""
    return features_and_medians(events, columns, rules)[0]


def features_and_medians(events: DataFrame, columns: Sequence[str], rules: RuleConfig = DEFAULT_RULES) -> tuple[DataFrame, dict[str, float]]:
    """``stored_features`` and the medians of the signals among ``columns``."""
    df, derived = _derived(events, rules)
    stored = materialize(df.withColumns(derived).select(*columns))
    signals = [c for c in NUMERIC_SIGNALS if c in columns]
    medians = signal_medians(stored, signals, read=F.col)
    return stored.withColumns({c: F.coalesce(F.col(c), F.lit(float(medians[c]))) for c in signals}), medians


def _derived(events: DataFrame, rules: RuleConfig) -> tuple[DataFrame, dict[str, Column]]:
    """The events with absent signals and flags as 0, and the feature expressions; unreadable signals are null."""
    require_columns(events, FEATURE_INPUT_COLUMNS + ("event_id",))
    df = events
    for c in NUMERIC_SIGNALS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(0.0))
    for c in FLAG_COLUMNS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(0))

    event_type = F.lower(F.coalesce(strip_ws(F.col("event_type").cast("string")), F.lit("")))
    parsed = parse_timestamp(F.col("created_at").cast("string"))
    allowed = event_type.isin(*rules.allowed_event_types)
    derived = {
        "event_type": event_type,
        "content_length": F.coalesce(F.length(F.col("content").cast("string")), F.lit(0)).cast("bigint"),
        "hour": hour_or_missing(parsed).cast("bigint"),
        "day_of_week": weekday_or_missing(parsed).cast("bigint"),
        "has_source_user": (~is_blank("source_user_id")).cast("int"),
        "has_target_user": (~is_blank("target_user_id")).cast("int"),
        "has_valid_date": parsed.isNotNull().cast("int"),
        "is_allowed_event_type": allowed.cast("int"),
        "event_type_like": (event_type == "like").cast("int"),
        "event_type_comment": (event_type == "comment").cast("int"),
        "event_type_follow": (event_type == "follow").cast("int"),
        "event_type_invalid": (~allowed).cast("int"),
    }
    kinds = dict(df.dtypes)
    derived |= {c: parse_number(c, kinds[c]) for c in NUMERIC_SIGNALS} | {c: parse_flag(c, kinds[c]) for c in FLAG_COLUMNS}
    return df, derived


def label_text(label_col: str = "label_risky_event"):
    """PRJ-11: 0/1 -> valido/riesgoso."""
    return F.when(F.col(label_col) == 1, LABEL_RISKY).when(F.col(label_col) == 0, LABEL_VALID)


def type_or_blank_label(type_col: str = "event_type"):
    """PRJ-11: blank event type shown as ``vacio``."""
    return F.when(F.col(type_col) == "", BLANK_TYPE_LABEL).otherwise(F.col(type_col))
