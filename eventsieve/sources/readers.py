"""Event sources (SRC-1..4).

Raw events are read with every column as text (null -> ``''``) so that the
cleaning rules, not the reader, decide what a bad value is.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Tokens pandas' CSV reader turns into missing values; they become ''.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


class SourceFormatError(ValueError):
    """Unsupported input suffix."""


def _string_schema(spark: SparkSession, path: str, fmt: str, multi_line: bool) -> StructType:
    header = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"').format(fmt).load(path).schema
    return StructType([StructField(f.name, StringType(), True) for f in header.fields])


def read_raw_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """SRC-1: CSV with header, every column a string; NA tokens -> ''.

    ``multi_line`` is for quoted values that hold line breaks; such a file
    cannot be split and is one task, so it is off by default."""
    schema = _string_schema(spark, path, "csv", multi_line)
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )
    blanks = {c: F.when(F.col(c).isNull() | F.col(c).isin(*NA_TOKENS), F.lit("")).otherwise(F.col(c)) for c in df.columns}
    return df.withColumns(blanks)


def read_raw_events(spark: SparkSession, path: str) -> DataFrame:
    """SRC-3: dispatch on the suffix; missing path -> ``FileNotFoundError``.

    Columnar inputs keep their types; text casts happen in the cleaning
    expressions, so parquet/JSON sources need no string schema."""
    suffix = os.path.splitext(path.rstrip("/"))[1].lower()
    readers = {".csv": read_raw_csv, ".parquet": lambda s, p: s.read.parquet(p), ".json": lambda s, p: s.read.json(p)}
    readers[".jsonl"] = readers[".json"]
    if suffix not in readers:
        raise SourceFormatError(f"Formato de entrada no soportado: {suffix}")
    try:
        return readers[suffix](spark, path)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"No existe el dataset: {path}") from exc
        raise


def read_stage_table(spark: SparkSession, path: str, schema: str | None = None, required: bool = True) -> DataFrame:
    """SRC-4: a prior stage's table (types kept); optional and absent ->
    empty frame with ``schema``."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        if required:
            raise FileNotFoundError(f"Falta artefacto requerido: {path}") from exc
    return spark.createDataFrame([], schema or "sin_datos string")
