"""Notifications, KPIs and recent views (WIN-1, STR-1/3, DAT-2/3, AGG-1/2, SRT-1, SET-2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventsieve.config import DEFAULT_RULES, DELIVERY_STATUS_SENT, RuleConfig
from eventsieve.functions.text import notification_id
from eventsieve.functions.timestamps import add_seconds, format_millis, seconds_between
from eventsieve.operators.indexing import with_global_index

NOTIFICATION_COLUMNS = (
    "notification_id",
    "event_id",
    "event_type",
    "target_user_id",
    "message",
    "delivery_status",
    "created_at",
    "delivered_at",
    "latency_seconds",
)


def newest_first():
    return [F.col("created_at").desc_nulls_last(), F.col("event_id").asc()]


def generate_notifications(
    valid: DataFrame,
    rules: RuleConfig = DEFAULT_RULES,
    keep_position: bool = False,
    num_partitions: int | None = None,
) -> DataFrame:
    """WIN-1: newest first; the zero-based position ``p`` sets the simulated
    latency ``2 + p % 4`` seconds and ``delivered_at = created_at + latency``.

    The position comes from the range-partitioned global index, not from a
    single-partition window."""
    indexed = with_global_index(
        valid.select("event_id", "event_type", "target_user_id", "notification_text", "created_at"),
        newest_first(),
        "position",
        num_partitions,
    )
    latency = F.lit(rules.latency_base_seconds) + F.col("position") % rules.latency_cycle
    delivered = add_seconds("created_at", latency)
    out = indexed.select(
        notification_id("event_id").alias("notification_id"),
        "event_id",
        "event_type",
        "target_user_id",
        F.col("notification_text").alias("message"),
        F.lit(DELIVERY_STATUS_SENT).alias("delivery_status"),
        format_millis("created_at").alias("created_at"),
        format_millis(delivered).alias("delivered_at"),
        seconds_between("created_at", delivered).alias("latency_seconds"),
        "position",
    )
    return out if keep_position else out.drop("position")


KPI_COUNTS = ("events_processed", "valid_events", "rejected_events", "notifications_generated", "sent", "latency_sum")


def kpi_rates(counts: DataFrame) -> DataFrame:
    """AGG-1 from its counts (``KPI_COUNTS``): the counts and zero-safe rates, rounded to 2 places."""

    def share(num: str, den: str):
        return F.round(F.coalesce(F.try_divide(F.col(num) * F.lit(100.0), F.nullif(F.col(den), F.lit(0))), F.lit(0.0)), 2)

    mean = F.coalesce(F.try_divide(F.col("latency_sum").cast("double"), F.nullif(F.col("notifications_generated"), F.lit(0))), F.lit(0.0))
    return counts.select(
        "events_processed", "valid_events", "rejected_events", "notifications_generated",
        share("sent", "notifications_generated").alias("delivery_success_rate_pct"),
        share("rejected_events", "events_processed").alias("error_rate_pct"),
        F.round(mean, 2).alias("avg_latency_seconds"),
        share("valid_events", "events_processed").alias("completeness_rate_pct"),
    )


def calculate_kpis(rejected: DataFrame, notifications: DataFrame) -> DataFrame:
    """AGG-1: one row of counts and rates.

    Built as a single aggregate over ``notifications`` (one row per valid
    event) stacked on the rejected rows, so no join is needed."""
    stacked = notifications.select(
        F.lit(1).alias("_valid"), "delivery_status", F.col("latency_seconds").alias("_lat")
    ).unionByName(
        rejected.select(
            F.lit(0).alias("_valid"),
            F.lit(None).cast("string").alias("delivery_status"),
            F.lit(None).cast("long").alias("_lat"),
        )
    )
    return kpi_rates(stacked.agg(
        F.count(F.lit(1)).alias("events_processed"),
        F.count_if(F.col("_valid") == 1).alias("valid_events"),
        F.count_if(F.col("_valid") == 0).alias("rejected_events"),
        F.count("_lat").alias("notifications_generated"),
        F.count_if(F.col("delivery_status") == DELIVERY_STATUS_SENT).alias("sent"),
        F.sum("_lat").alias("latency_sum"),
    ))


def recent_events(valid: DataFrame) -> DataFrame:
    """SRT-1: valid events newest first, dates rendered with milliseconds."""
    return valid.orderBy(*newest_first()).withColumn("created_at", format_millis("created_at"))


def recent_views(valid: DataFrame, rules: RuleConfig = DEFAULT_RULES) -> dict[str, DataFrame]:
    """SET-2: ``all`` plus one view per allowed type (filters over one frame)."""
    ordered = recent_events(valid)
    views = {"all": ordered}
    for event_type in rules.allowed_event_types:
        views[event_type] = ordered.filter(F.col("event_type") == event_type)
    return views
