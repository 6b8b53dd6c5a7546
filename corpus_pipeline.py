"""The corpus pipeline: language, near-duplicates, benchmark passages, personal data, mixture.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its
predecessor kept; between stages the rows are stored as Parquet.  All but
the last return the columns of ``documents``, whatever other columns the table
has; the last returns one row per copy in the mix.  Each stage states what it
does with nulls, repeated rows, ties and empty tables; very long texts are
handled whole by all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventsieve.llm import decontaminate, language, mixing, pii, simhash
from eventsieve.session import materialize, release

# A document goes where its words are labelled less surely than this: the mean of each word's best posterior.
LEAST_SURENESS = 0.7
SHINGLE_WORDS = 3
MAX_BITS = 3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep rows in known languages, however many a row mixes; null, empty and letterless texts go.

    Rows are judged each for itself, so repeats stay and ids do not matter; an empty table stays empty.
    """
    rows = language.training_rows(docs)
    model = language.fit([r["text"] for r in rows], [r["lang"] for r in rows])
    return language.keep_identified(docs, model, LEAST_SURENESS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each near-duplicate group: the smallest doc_id, null last, then the first by place.

    Rows are told apart by place, so rows that share an id but not a group stay both; rows without an id are
    grouped like others; null and empty texts are one group; an empty table stays empty.
    """
    return simhash.keep_representatives(docs, SHINGLE_WORDS, MAX_BITS)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop rows that hold a benchmark item; null and empty texts hold none, repeats are judged alike, ids do not matter.

    An empty table stays empty, and an empty benchmark drops nothing.
    """
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by marks, row by row; every row stays, null texts stay null, ``n_chars`` follows the text.

    Ids and repeats do not matter; an empty table stays empty.
    """
    return pii.mask_pii(docs, pii.fit_on(docs))


def _free(name: str, taken: list[str]) -> str:
    """The name, with marks behind it until no column has it."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_mix"
    return name


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per copy in the mix: the columns of ``docs``, then ``size``, ``target`` and ``copy`` (from 1).

    These three get ``_mix`` behind them where the table has such a column.  A null source is one of its own;
    null and empty texts have size 0; ties in size go by doc_id, repeated rows are mixed each; an empty table
    stays empty.
    """
    size, target, copy = (_free(c, docs.columns) for c in ("size", "target", "copy"))
    mixed = mixing.mix_sources(docs, carry=True)
    names = [F.col("row").getField(c).alias(c) for c in docs.columns]
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias(copy)
    return mixed.filter("copies > 0").select(*names, F.col("size").alias(size), F.col("target").alias(target), copies)


STAGES = [
    ("language", identify_language),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate_benchmark),
    ("personal_data", mask_personal_data),
    ("source_mix", mix),
]

# Fitted models, fingerprints and edit checks have no SQL form; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        done = materialize(stage(spark, docs, sf_dir))
        release(docs)
        docs = done
    return docs
