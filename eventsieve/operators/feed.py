"""The dashboard feed as one payload, and back (SNK-8, JSN-1).

The payload holds the chosen model's name, its metrics, the comparison, the
quality table, the timings and the decisions.  It is kept as JSON lines, one
record a line with its section's name, so that the decisions, which grow with
the input, are written and read by many tasks.  Reading takes every line as a
``VARIANT`` and extracts typed fields; lines that are no JSON, or of another
section, give no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventsieve.operators.export import decision_feed

SECTION, RECORD = "section", "record"


def payload_lines(sections: dict[str, DataFrame]) -> DataFrame:
    """``(line)``: the rows of all sections as JSON texts; null fields are left out."""
    out = None
    for name, df in sections.items():
        line = F.to_json(F.struct(F.lit(name).alias(SECTION), F.struct(*[F.col(c) for c in df.columns]).alias(RECORD)))
        one = df.select(line.alias("line"))
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("a payload needs a section")
    return out


def feed_payload(metrics: DataFrame, comparison: DataFrame, quality: DataFrame, performance: DataFrame, decisions: DataFrame, selected_model: str) -> DataFrame:
    chosen = metrics.sparkSession.createDataFrame([(selected_model,)], "selected_model string")
    return payload_lines({
        "selected_model": chosen, "metrics": metrics, "model_comparison": comparison, "quality": quality, "performance": performance,
        "decisions": decision_feed(decisions),
    })


def write_payload(lines: DataFrame, path: str) -> None:
    lines.select("line").write.mode("overwrite").text(path)


def variant_fields(document: Column, schema: str | dict[str, str], prefix: str = "$") -> list[Column]:
    """Typed columns out of a ``VARIANT``; a field that is absent or of no such type is null."""
    fields = schema if isinstance(schema, dict) else dict(f.strip().split(" ", 1) for f in schema.split(","))
    return [F.try_variant_get(document, f"{prefix}.{name}", kind).alias(name) for name, kind in fields.items()]


def rows_from_json(texts: DataFrame, column: str, schema: str | dict[str, str]) -> DataFrame:
    """JSN-1 backwards: one row per JSON text with the fields of ``schema``; texts that are no JSON give none."""
    parsed = texts.select(F.try_parse_json(column).alias("_v")).filter(F.col("_v").isNotNull())
    return parsed.select(*variant_fields(F.col("_v"), schema))


def read_section(spark: SparkSession, path: str, section: str, schema: str | dict[str, str]) -> DataFrame:
    """The records of one section of a written payload."""
    parsed = spark.read.text(path).select(F.try_parse_json("value").alias("_v"))
    own = parsed.filter(F.try_variant_get("_v", f"$.{SECTION}", "string") == section)
    return own.select(*variant_fields(F.col("_v"), schema, f"$.{RECORD}"))
