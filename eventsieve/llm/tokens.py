"""Token counts of documents in flat token files, found by their separators alone.

A token file is a run of little-endian 16-bit token ids; every document ends
with the separator id; nothing says where documents begin.  ``write_files``
makes such files from texts: one per task, so that their size is bounded by
the input split.  Each document starts with its id, spelled in ``HEADER``
ids below the separator, which is how counts find their documents again.

``scan_files`` reads files in blocks.  A block finds all separators at once
(numpy), measures the documents that begin and end in it, and reports two
loose ends: the end of a document begun earlier and the begin of one still
open.  A prefix scan over the blocks of a file (the last begin before each
block) joins the loose ends.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventsieve.session import delete_path, materialize, only_result, shared_path

SEPARATOR = 50256
DIGIT = 50_000
HEADER = 5
BLOCK_TOKENS = 1 << 19
NO_ID = 1 << 64  # stands for a null id; ids are written plus 2**63


def public_vocabulary(name: str = "byte_bpe_multi_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def encoder(ranks: dict[bytes, int]):
    """A tokenizer of the vocabulary; texts hold no special tokens, whatever they say."""
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def id_header(doc_id: int | None) -> list[int]:
    value = NO_ID if doc_id is None else doc_id + (1 << 63)
    return [value // DIGIT**k % DIGIT for k in reversed(range(HEADER))]


def header_id(digits: np.ndarray) -> list[int | None]:
    values = [sum(int(d) * DIGIT**k for d, k in zip(row, reversed(range(HEADER)), strict=True)) for row in digits]
    return [None if v == NO_ID else v - (1 << 63) for v in values]


def write_files(docs: DataFrame, path: str, vocabulary: str | None = None) -> None:
    """Flat token files of ``docs(doc_id, text)`` below ``path``; a null text has no tokens."""
    ranks = read_ranks(vocabulary or public_vocabulary())
    if max(ranks.values()) >= SEPARATOR:
        raise ValueError(f"the vocabulary uses ids from {SEPARATOR} on")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks).encode_ordinary
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                own = batch.slice(lo, 256)
                ids = zip(own.column(0).to_pylist(), own.column(1).to_pylist(), strict=True)
                rows = [np.array(id_header(i) + encode(t or ""), "<u2").tobytes() for i, t in ids]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["tokens"])

    # The text writer puts a separator behind every row and leaves the bytes of a row alone.
    separator = np.array([SEPARATOR], "<u2").tobytes().decode("latin-1")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "tokens binary")
    rows.select(F.col("tokens").cast("string")).write.option("lineSep", separator).option("encoding", "ISO-8859-1").text(path)


def find_documents(tokens: np.ndarray, length: int, behind_separator: bool, is_last: bool):
    """Of one block: ``(begins, ends)`` of whole documents, the loose end, the loose begin.

    ``tokens`` may run on behind ``length`` by a header.  Positions count from
    the block's begin; an end is the place of its separator.  Loose ones are
    -1 where there is none.
    """
    ends = np.flatnonzero(tokens[:length] == SEPARATOR)
    begins = ends + 1
    if behind_separator:
        begins = np.concatenate(([0], begins))
    if is_last:  # a last document may lack its separator; nothing begins behind the last one
        if length and tokens[length - 1] != SEPARATOR:
            ends = np.append(ends, length)
        begins = begins[begins < length]
    loose_end = int(ends[0]) if len(ends) > len(begins[begins <= ends[-1]] if len(ends) else begins) else -1
    if loose_end >= 0:
        ends = ends[1:]
    loose_begin = int(begins[-1]) if len(begins) > len(ends) else -1
    return begins[: len(ends)], ends, loose_end, loose_begin


FOUND = "file string, block long, begin long, end long, id long, loose_end long, loose_begin long, loose_id long"


def scan_files(spark: SparkSession, path: str, header: bool = True, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``(file, begin, n_tokens, doc_id)``, one row per document of the token files below ``path``.

    ``begin`` is its first token's place in the file.  With ``header`` the
    leading ids are read and not counted; without, ``doc_id`` is null.  Empty
    documents count 0; a last one without separator counts too; an empty file
    has none.  A file must hold whole 16-bit ids and be under 2 GB; the
    writer bounds files by the input split.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).filter("length > 0")
    size = 2 * block_tokens
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / size))).alias("block")
    at = F.col("block") * size
    # One id before the block and a header behind it come along.
    piece = F.substring("content", (F.greatest(at - 2, F.lit(0)) + 1).cast("int"), F.lit(size + 2 + 2 * HEADER))
    blocks = files.select("path", "length", "content", block).select("path", "block", "length", piece.alias("bytes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, number, total, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if total % 2:
                    raise ValueError(f"{file} holds half a token")
                tokens = np.frombuffer(raw, "<u2")
                first = number * block_tokens
                length = min(block_tokens, total // 2 - first)
                fresh = number == 0 or int(tokens[0]) == SEPARATOR
                own = tokens[0 if number == 0 else 1 :]
                begins, ends, loose_end, loose_begin = find_documents(own, length, fresh, first + length == total // 2)
                at_ = np.append(begins, max(loose_begin, 0))
                ids = header_id(own[np.minimum(at_[:, None] + np.arange(HEADER), len(own) - 1)]) if header else [None] * len(at_)
                n = len(begins)
                nothing = [None] * n
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file] * (n + 1)), pa.array([number] * (n + 1), pa.int64()), pa.array([*(begins + first).tolist(), None], pa.int64()),
                     pa.array([*(ends + first).tolist(), None], pa.int64()), pa.array([*ids[:n], None], pa.int64()),
                     pa.array([*nothing, loose_end + first if loose_end >= 0 else None], pa.int64()),
                     pa.array([*nothing, loose_begin + first if loose_begin >= 0 else None], pa.int64()),
                     pa.array([*nothing, ids[n] if loose_begin >= 0 else None], pa.int64())],
                    names=[c.split()[0] for c in FOUND.split(", ")],
                )

    found = materialize(blocks.mapInArrow(run, FOUND))
    whole = found.filter("begin is not null").select("file", "begin", "end", F.col("id").alias("doc_id"))
    # One row per block; files are bounded, and so are a window's rows.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.last(F.when(F.col("loose_begin").isNotNull(), F.struct("loose_begin", "loose_id")), ignorenulls=True).over(before)
    stitched = found.filter("begin is null").withColumn("open", opened).filter("loose_end is not null")
    joined = whole.unionByName(stitched.select("file", F.col("open.loose_begin").alias("begin"), F.col("loose_end").alias("end"), F.col("open.loose_id").alias("doc_id")))
    return joined.select("file", "begin", (F.col("end") - F.col("begin") - (HEADER if header else 0)).alias("n_tokens"), "doc_id")


def count_tokens(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``(doc_id, n_tokens)`` of every document, counted in token files written for it.

    A null or empty text counts 0; null and repeated ids and repeated rows
    come back as they are; a very long text counts whole; an empty table gives
    an empty one; other columns are ignored.  The files are deleted when the counts are stored.
    """
    spark = docs.sparkSession
    path = shared_path(spark, "tokens")
    write_files(docs, path, vocabulary)
    with only_result(spark) as keep:
        counts = keep(scan_files(spark, path).select("doc_id", "n_tokens"))
    delete_path(spark, path)
    return counts


def q_tokens(spark, sf_dir: str) -> DataFrame:
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
