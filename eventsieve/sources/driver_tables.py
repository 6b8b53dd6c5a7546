"""Adapter from the driver's clean ``events`` table to raw social events.

``events`` carries no data-quality problems, so the adapter dirties it by
fixed arithmetic on ``event_id`` (the same rules are in the SQL oracle):
duplicate ids after trimming, upper-case and padded types, blank users,
unparsable dates.  All produced columns are strings except ``seq``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventsieve.config import DEFAULT_RULES, RuleConfig
from eventsieve.functions.timestamps import format_seconds

# Fixed adapter values.
TYPE_MAP = {"click": "LIKE", "view": " comment ", "purchase": "follow"}
DUPLICATE_EVERY, DUPLICATE_REMAINDER = 25, 24
BLANK_SOURCE_EVERY = 40
BLANK_TARGET_EVERY = 9
BAD_DATE_EVERY, BAD_DATE_REMAINDER = 10, 3
BAD_DATE_TEXT = "fecha-invalida"


def read_driver_table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_events_from_driver(events: DataFrame, passthrough: tuple[str, ...] = ()) -> DataFrame:
    """``events`` (event_id, ts, user_id, event_type, props) -> raw strings + ``seq``.

    ``passthrough`` columns are carried unchanged (extra columns of a raw table).
    """
    eid = F.col("event_id")
    et = F.col("event_type")
    type_expr = F.when(et == "click", TYPE_MAP["click"])
    for source in ("view", "purchase"):
        type_expr = type_expr.when(et == source, TYPE_MAP[source])
    return events.select(
        eid.alias("seq"),
        F.when(
            eid % DUPLICATE_EVERY == DUPLICATE_REMAINDER,
            F.concat(F.lit(" evt-"), (eid - 1).cast("string")),
        ).otherwise(F.concat(F.lit("evt-"), eid.cast("string"))).alias("event_id"),
        type_expr.otherwise(et).alias("event_type"),
        F.when(eid % BLANK_SOURCE_EVERY == 0, F.lit(""))
        .otherwise(F.concat(F.lit("u"), F.col("user_id").cast("string")))
        .alias("source_user_id"),
        F.when(eid % BLANK_TARGET_EVERY == 0, F.lit("  "))
        .otherwise(F.concat(F.lit("t"), F.get_json_object("props", "$.k")))
        .alias("target_user_id"),
        F.when(eid % BAD_DATE_EVERY == BAD_DATE_REMAINDER, F.lit(BAD_DATE_TEXT))
        .otherwise(format_seconds("ts"))
        .alias("created_at"),
        F.col("props").alias("content"),
        *passthrough,
    )


def raw_events(spark, sf_dir: str) -> DataFrame:
    events = read_driver_table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "props"
    )
    return raw_events_from_driver(events)


def event_signals(spark, sf_dir: str, rules: RuleConfig = DEFAULT_RULES) -> DataFrame:
    """``(seq, REA-3..5)``: the history signals alone, without the rows they belong to."""
    from eventsieve.operators.history import signals_by_event

    events = read_driver_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    found = signals_by_event(events, "user_id", "ts", "event_id", F.col("event_type") == rules.report_event_type, rules)
    return found.withColumnRenamed("event_id", "seq")


def model_events(spark, sf_dir: str, rules: RuleConfig = DEFAULT_RULES) -> DataFrame:
    """Raw events plus history signals and labels: the model's input table.

    The three numeric signals come from each user's history in ``events``
    (REA-3..5), the duplicate flag from the raw ids (REA-2) and the label
    from the rules and signals (REA-1).
    """
    from eventsieve.operators.cleaning import first_sequences
    from eventsieve.operators.history import history_signals, risk_labels

    events = read_driver_table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "props"
    )
    signals = history_signals(
        events,
        user_col="user_id",
        ts_col="ts",
        order_col="event_id",
        report_flag=F.col("event_type") == rules.report_event_type,
        rules=rules,
    )
    raw = raw_events_from_driver(
        signals, ("interaction_velocity_5m", "account_age_days", "historical_report_rate")
    )
    # Ids are compared alone, before the join; its key is the signals', so the wide rows are shuffled once.
    firsts = first_sequences(raw_events(spark, sf_dir).select("seq", "event_id"))
    flagged = raw.join(firsts, "seq", "left").withColumn("is_duplicate", F.when(F.col("_first").isNull(), 1).otherwise(0)).drop("_first")
    return risk_labels(flagged, rules)


# Fixed values of the dirtied signals: text that is no number, by remainder of seq.
BAD_NUMBERS = ("abc", "nan", "5d", "")
BLANK_ID_EVERY = 50


def dirty_signals(raw: DataFrame) -> DataFrame:
    """Raw events with text signals, some of which are no numbers, and some blank ids."""
    seq = F.col("seq")
    bad = F.element_at(F.array(*[F.lit(x) for x in BAD_NUMBERS]), (seq % len(BAD_NUMBERS) + 1).cast("int"))
    is_bad = seq % 11 < 4
    return raw.withColumns({
        "event_id": F.when(seq % BLANK_ID_EVERY == 0, F.lit(" ")).otherwise(F.col("event_id")),
        "interaction_velocity_5m": F.when(is_bad, bad).otherwise((seq % 61).cast("string")),
        "account_age_days": F.when(seq % 13 == 0, F.lit(" x")).otherwise(F.concat((seq % 700).cast("string"), F.lit(".5"))),
        "historical_report_rate": F.lit("none"),
    })
