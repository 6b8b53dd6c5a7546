"""JOB-1: ETL end to end (ingest -> gate -> clean -> validate -> notify -> load -> KPIs -> write).

The processed table is checkpointed to the shared checkpoint folder once:
valid, rejected, notifications, views and lookup tables all read it, and the
cut lineage means a lost executor recomputes from the checkpoint, not from the
raw scan.  Rows are counted by the jobs that write them (AGG-2): the input's
rows are the sum of the copies that deduplication found, so nothing is read a
second time for a count, and the KPIs (AGG-1) come from these counts.
"""

from __future__ import annotations

import os
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventsieve.config import DEFAULT_RULES, DELIVERY_STATUS_SENT, LATENCY_MEASUREMENT_TYPE, RuleConfig
from eventsieve.operators.cleaning import clean_transform
from eventsieve.operators.notifications import KPI_COUNTS, generate_notifications, kpi_rates, recent_views
from eventsieve.operators.rules import require_min_rows, split_valid_rejected, with_error_reason
from eventsieve.session import ensure_checkpoint_dir, shared_path, stored_table
from eventsieve.sinks.lookup import LookupTable, save_lookup_table
from eventsieve.sinks.writers import render_timestamps, require_outputs, write_measured, write_table


@dataclass
class EtlResult:
    processed: DataFrame
    valid: DataFrame
    rejected: DataFrame
    notifications: DataFrame
    kpis: DataFrame
    outputs: dict[str, str]
    counts: dict[str, int] = field(default_factory=dict)
    tables: dict[str, LookupTable] = field(default_factory=dict)


def run_etl(
    spark: SparkSession,
    raw: DataFrame,
    output_dir: str,
    input_name: str = "events",
    rules: RuleConfig = DEFAULT_RULES,
    fmt: str = "parquet",
    bucketed_tables: bool = True,
    table_prefix: str = "",
) -> EtlResult:
    """``counts`` holds the measured run; ``tables`` the three lookup tables, registered under ``table_prefix``."""
    started = time.perf_counter()
    ensure_checkpoint_dir(spark)
    require_min_rows(raw, rules.minimum_input_rows)

    transformed = with_error_reason(clean_transform(raw, rules, copies="_copies"), rules)
    stored = shared_path(spark, "checked")
    rows = F.count(F.lit(1))
    counts = write_measured(
        transformed, stored, {"events_processed": rows, "input_rows": F.coalesce(F.sum("_copies"), F.lit(0))}, keep=[c for c in transformed.columns if c != "_copies"]
    )
    checked = stored_table(spark, stored, transformed.drop("_copies").schema)
    valid, rejected = split_valid_rejected(checked)

    names = ("events_processed", "events_validated", "validation_errors", "notifications", "events_recent", "kpi_report")
    outputs = {name: os.path.join(output_dir, name) for name in names}
    write_table(render_timestamps(checked.drop("error_reason")), outputs["events_processed"], fmt)
    counts |= write_measured(render_timestamps(valid), outputs["events_validated"], {"valid_events": rows}, fmt)
    counts |= write_measured(render_timestamps(rejected), outputs["validation_errors"], {"rejected_events": rows}, fmt)
    stored = shared_path(spark, "notifications")
    notes = generate_notifications(valid, rules)
    counts |= write_measured(notes, stored, {
        "notifications_generated": rows, "sent": F.count_if(F.col("delivery_status") == DELIVERY_STATUS_SENT),
        "latency_sum": F.coalesce(F.sum("latency_seconds"), F.lit(0)),
    })
    notes = stored_table(spark, stored, notes.schema)
    write_table(notes, outputs["notifications"], fmt)
    # SRT-1 / partition pruning: one directory per type instead of one file per view.
    write_table(recent_views(valid, rules)["all"], outputs["events_recent"], fmt, partition_by=("event_type",))
    tables = {}
    if bucketed_tables:
        loads = {
            "notifications": (notes, "notifications_generated"),
            "validated_events": (render_timestamps(valid), "valid_events"),
            "rejected_events": (render_timestamps(rejected), "rejected_events"),
        }
        for name, (df, measured) in loads.items():
            tables[name] = save_lookup_table(df, table_prefix + name, os.path.join(output_dir, "tables", name), counts[measured])

    kpis = kpi_rates(spark.createDataFrame([tuple(counts[c] for c in KPI_COUNTS)], ", ".join(f"{c} bigint" for c in KPI_COUNTS)))
    kpi_row = kpis.first()
    seconds = max(time.perf_counter() - started, 1e-9)
    measured = spark.createDataFrame(
        [(*kpi_row, counts["input_rows"], input_name, round(seconds, 6),
          round(float(kpi_row["events_processed"]) / seconds, 2), LATENCY_MEASUREMENT_TYPE)],
        kpis.schema.simpleString()[len("struct<"):-1]
        + ",input_rows bigint,input_file string,pipeline_execution_seconds double,"
        "processing_rows_per_second double,latency_measurement_type string",
    )
    write_table(measured.coalesce(1), outputs["kpi_report"], "json" if fmt == "parquet" else fmt)
    # SNK-7: the tables that must exist do; empty ones are fine where no row qualifies.
    require_outputs(spark, {n: p for n, p in outputs.items() if n != "kpi_report"}, fmt, may_be_empty=set(outputs) - {"events_processed"})
    return EtlResult(checked, valid, rejected, notes, measured, outputs, counts, tables)
