"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is fully executed with the ``noop`` sink (no driver collect).
Prints one JSON line: total seconds, per-query seconds, scale and the
events throughput of the ETL flagship.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from eventsieve.plans import catalog  # noqa: E402
from eventsieve.session import get_spark, scratch_tables  # noqa: E402

HEADLINE = [
    "kpi_report",
    "clean_events",
    "notifications",
    "recent_by_type",
    "velocity",
    "report_rate",
    "feature_matrix",
    "quality_summary",
    "correlation_matrix",
    "model_metrics",
    "roc_curve",
    "final_decisions",
    "pseudonymized_export",
]


# Model fits take many small jobs each; they are timed too, but summed apart so that totals compare across rounds.
FITTING = ["logistic_model", "random_forest_model"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    scratch = tempfile.mkdtemp(prefix="eventsieve-bench-")
    spark = get_spark(
        f"local[{cpus}]",
        app_name="eventsieve-bench",
        **{
            "spark.sql.shuffle.partitions": str(max(8, 2 * int(cpus))),
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))
    queries = {**catalog.SQL_CHECKED, **catalog.ROWS_ONLY}
    # Untimed warm-up on the smallest tables: JVM JIT and codegen caches.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in only or HEADLINE + FITTING:
            queries[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
        spark.catalog.clearCache()

    timings = {}
    for name in only or HEADLINE + FITTING:
        started = time.perf_counter()
        with scratch_tables(spark):
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings[name] = round(time.perf_counter() - started, 3)
        spark.catalog.clearCache()

    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    total = round(sum(s for name, s in timings.items() if name not in FITTING), 3)
    fits = round(sum(s for name, s in timings.items() if name in FITTING), 3)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": total,
        "unit": "sec",
        "fitting_total": fits,
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "events_rows": rows,
        "etl_rows_per_sec": round(rows / timings["kpi_report"], 1) if "kpi_report" in timings else None,
        "cpus": int(cpus),
        "warmup": warm_dir if os.path.isdir(warm_dir) else None,
    }))


if __name__ == "__main__":
    main()
