"""Cleaning and deduplication (PRJ-1..4, DED-1, REA-2).

Deduplication keeps the first row per trimmed ``event_id`` in input order
(``seq``: given by the caller, or numbered once from a file scan).  It is done as an aggregate plus a join on ``(event_id, seq)``:

* ``min(seq)`` per id is a hash aggregate with map-side partial
  aggregation, so even an id shared by a third of all rows (blank ids)
  ships one partial row per map task;
* the join key ``(event_id, seq)`` is unique on both sides, so a hot id is
  spread over all shuffle partitions by ``seq`` (no single hot task).

``dropDuplicates`` is not used: its survivor is arbitrary.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventsieve.config import DEFAULT_RULES, RuleConfig
from eventsieve.functions.text import notification_text, strip_ws
from eventsieve.functions.timestamps import parse_timestamp
from eventsieve.operators.indexing import with_global_index

SEQ = "seq"


def with_sequence(df: DataFrame) -> DataFrame:
    """Attach the input order ``seq`` when the source has none.

    Rows of a file scan are numbered by file path (as text), then place in
    the file, whatever order the splits are packed in; the numbered rows are
    stored once, so every later use sees the same numbers.  A frame that has
    neither ``seq`` nor a file behind each row has no input order, and raises.
    """
    if SEQ in df.columns:
        return df
    try:
        placed = df.withColumns({"_file": F.col("_metadata.file_path"), "_split": F.col("_metadata.file_block_start")})
    except AnalysisException as exc:
        raise ValueError(f"the input has no order: add a {SEQ!r} column or pass a file scan") from exc
    placed = placed.withColumn("_row", F.monotonically_increasing_id())
    order = [F.col("_file"), F.col("_split"), F.col("_row")]
    return with_global_index(placed, order, SEQ).drop("_file", "_split", "_row")


def add_missing_columns(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """PRJ-1: absent columns appear with a literal default."""
    missing = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def normalize_events(raw: DataFrame, rules: RuleConfig = DEFAULT_RULES) -> DataFrame:
    """PRJ-1..3 + DAT-1: required columns present, trimmed, type lower-cased,
    ``created_at`` parsed to ``TIMESTAMP_NTZ`` (bad text -> null).  Extra
    columns pass through untouched."""
    df = add_missing_columns(with_sequence(raw), {c: "" for c in rules.required_columns})
    cleaned = {c: F.coalesce(strip_ws(F.col(c).cast("string")), F.lit("")) for c in rules.required_columns}
    cleaned["event_type"] = F.lower(cleaned["event_type"])
    cleaned["created_at"] = parse_timestamp(cleaned["created_at"])
    return df.withColumns(cleaned)


def first_occurrences(df: DataFrame, key: str = "event_id", copies: str | None = None) -> DataFrame:
    """``(key, seq)`` of the first row per key (partial-aggregated); ``copies`` names a column for the rows of the key."""
    return df.groupBy(key).agg(F.min(SEQ).alias(SEQ), *([F.count(F.lit(1)).alias(copies)] if copies else []))


def deduplicate_first(df: DataFrame, key: str = "event_id", copies: str | None = None) -> DataFrame:
    """DED-1: keep the first row per ``key`` in ``seq`` order; ``copies`` names a column for how many rows it stands for."""
    return df.join(first_occurrences(df, key, copies), [key, SEQ], "inner" if copies else "left_semi")


def flag_duplicates(df: DataFrame, key: str = "event_id", out: str = "is_duplicate") -> DataFrame:
    """REA-2: ``1`` on every repeat of a (trimmed) key, ``0`` on the first."""
    keyed = with_sequence(df).withColumn("_key", F.coalesce(strip_ws(F.col(key).cast("string")), F.lit("")))
    firsts = keyed.groupBy("_key").agg(F.min(SEQ).alias(SEQ)).withColumn("_first", F.lit(1))
    return (
        keyed.join(firsts, ["_key", SEQ], "left")
        .withColumn(out, F.when(F.col("_first").isNull(), 1).otherwise(0))
        .drop("_key", "_first")
    )


def first_sequences(df: DataFrame, key: str = "event_id") -> DataFrame:
    """``(seq, _first)``: the sequence numbers of the rows that are the first of their (trimmed) key, as in ``flag_duplicates``.

    For frames in which a sequence number has one key."""
    keyed = df.select(SEQ, F.coalesce(strip_ws(F.col(key).cast("string")), F.lit("")).alias("_key"))
    return keyed.groupBy("_key").agg(F.min(SEQ).alias(SEQ)).select(SEQ, F.lit(1).alias("_first"))


def clean_transform(raw: DataFrame, rules: RuleConfig = DEFAULT_RULES, copies: str | None = None) -> DataFrame:
    """PRJ-4: normalise, deduplicate (``copies``: see ``deduplicate_first``), add ``notification_text``."""
    normalized = normalize_events(raw, rules)
    deduped = deduplicate_first(normalized, copies=copies)
    return deduped.withColumn(
        "notification_text", notification_text("event_type", "source_user_id")
    )
