"""Streaming form of the cleaning and rule steps (optional extension, SURVEY 2.13).

The reference is batch only.  The stateless steps (PRJ-1..3, DAT-1, STR-1,
VAL-1, HSH-1, the linear scorer) are column expressions, so the same
functions run on ``readStream``.  Deduplication becomes
``withWatermark`` + ``dropDuplicatesWithinWatermark`` on the event id (state
is bounded by the watermark delay).  The global newest-first position
(WIN-1) needs the whole table and is not available on a stream.

Each micro-batch is routed to ``valid/`` and ``rejected/`` by
``foreachBatch``, below a folder of its batch id that is overwritten: a batch
that is tried again after a failure replaces what it had written.  Rows later
than the watermark are dropped by the deduplication and reach neither;
``late_rows`` counts them.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventsieve.config import DEFAULT_RULES, RuleConfig
from eventsieve.functions.text import notification_text
from eventsieve.operators.cleaning import normalize_events
from eventsieve.operators.rules import etl_error_reason
from eventsieve.sources.driver_tables import raw_events_from_driver


def validated_stream(events: DataFrame, watermark: str = "10 minutes", rules: RuleConfig = DEFAULT_RULES) -> DataFrame:
    """Streaming ``events`` -> cleaned, deduplicated rows with ``error_reason``.

    The watermark is on the source's event time ``ts`` (always present),
    not on the parsed ``created_at`` (null for bad dates)."""
    # Watermarks need TIMESTAMP (not NTZ); the zone shift does not matter
    # for a lateness bound.
    raw = raw_events_from_driver(events.withColumn("event_time", F.col("ts").cast("timestamp")), passthrough=("event_time",))
    cleaned = normalize_events(raw, rules)
    deduped = cleaned.withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(["event_id"])
    return deduped.withColumn("notification_text", notification_text("event_type", "source_user_id")).withColumn(
        "error_reason", etl_error_reason(rules)
    )


def start_validation_stream(
    spark: SparkSession,
    source_dir: str,
    output_dir: str,
    checkpoint_location: str,
    watermark: str = "10 minutes",
    available_now: bool = True,
):
    """Start the stream over parquet files in ``source_dir``; returns the query."""
    schema = spark.read.parquet(source_dir).schema
    events = spark.readStream.schema(schema).parquet(source_dir)
    checked = validated_stream(events, watermark)

    def route(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        for name, rows in (
            ("valid", batch.filter(F.col("error_reason") == "").drop("error_reason")),
            ("rejected", batch.filter(F.col("error_reason") != "")),
        ):
            rows.write.mode("overwrite").parquet(os.path.join(output_dir, name, f"batch_id={batch_id}"))
        batch.unpersist()

    writer = checked.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def late_rows(query) -> int:
    """Rows the watermark dropped in the batches that the query still reports on."""
    return sum(int(op.get("numRowsDroppedByWatermark", 0)) for p in query.recentProgress for op in p.get("stateOperators", []))
