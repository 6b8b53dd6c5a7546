"""Sinks (SNK-1..8).

Parquet is the default format; CSV/JSON reproduce the reference's files.
Every write is ``mode("overwrite")`` of a whole table, so a re-run after a
failure replaces partial output (tasks that die are retried by Spark).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventsieve.functions.timestamps import format_millis


MISSING = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def render_timestamps(df: DataFrame) -> DataFrame:
    """SNK-4: every timestamp column as ``yyyy-MM-dd HH:mm:ss.SSS`` text ('' for null)."""
    ts_cols = {f.name for f in df.schema.fields if f.dataType.typeName() in ("timestamp", "timestamp_ntz")}
    return df.select(*[format_millis(c).alias(c) if c in ts_cols else F.col(c) for c in df.columns])


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> None:
    """SNK-1 / SNK-2: whole-table overwrite; CSV keeps '' as an empty field."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).option("emptyValue", "").csv(path)
    elif fmt == "json":
        writer.json(path)
    else:
        writer.parquet(path)


def write_measured(df: DataFrame, path: str, counts: dict[str, Column], fmt: str = "parquet", partition_by: tuple[str, ...] = (), keep: list[str] | None = None) -> dict:
    """AGG-2: write a table and return aggregates over its rows, measured by the same job (``DataFrame.observe``).

    ``keep`` names the columns to write where ``counts`` need others too.  The
    metrics are taken in the stage that writes, whose tasks count once however
    often they are tried.
    """
    seen = Observation()
    observed = df.observe(seen, *[c.alias(name) for name, c in counts.items()])
    write_table(observed.select(*keep) if keep else observed, path, fmt, partition_by)
    return seen.get


def verify_outputs(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet") -> dict[str, bool]:
    """SNK-7: each expected table exists and has at least one row."""
    status = {}
    for name, path in paths.items():
        try:
            status[name] = not spark.read.format(fmt).load(path).isEmpty()
        except AnalysisException as exc:
            if exc.getCondition() not in MISSING:
                raise
            status[name] = False
    return status


def require_outputs(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet", may_be_empty=()) -> None:
    """Raise unless every table exists and, but for ``may_be_empty``, has a row."""
    missing = []
    for name, path in paths.items():
        try:
            if spark.read.format(fmt).load(path).isEmpty() and name not in may_be_empty:
                missing.append(name)
        except AnalysisException as exc:
            if exc.getCondition() not in MISSING or name not in may_be_empty:
                raise
    if missing:
        raise RuntimeError(f"empty outputs: {', '.join(sorted(missing))}")
