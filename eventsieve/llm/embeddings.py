"""Embedding near-duplicates by Euclidean p-stable hashing.

A normalised vector's key in a table is ``PROJECTIONS`` quantised random
projections, ``floor((a.x + b) / WIDTH)`` with Gaussian ``a``; ``TABLES``
tables are drawn.  At cosine 0.98 (distance 0.2) one projection agrees with
probability 0.80, so 20 tables of 8 meet in at least one with 0.97; closer
pairs more often.  Pairs that share a bucket are checked by exact cosine in
double precision.

Equal vectors of a label collapse into one class first.  Only rows of
buckets with company fetch their vector.  Buckets of more than ``BLOCK``
rows are cut into blocks and each pair of blocks goes to its own task, so a
hot bucket spreads out.  Tasks return link counts and one star per linked
set, never pairs; a pair that meets in several tables counts in the first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventsieve.llm.components import connected_components
from eventsieve.llm.simhash import _Sets, _sorted_runs
from eventsieve.session import materialize, only_result

COSINE = 0.98
TABLES = 20
PROJECTIONS = 8
WIDTH = 0.8
BLOCK = 2048
SEED = 5


_DRAWN: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def _projections(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if size in _DRAWN:
        return _DRAWN[size]
    rng = np.random.default_rng([SEED, size])
    n = TABLES * PROJECTIONS
    _DRAWN[size] = rng.normal(size=(size, n)), rng.uniform(0, WIDTH, n), rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return _DRAWN[size]


def table_keys(unit: np.ndarray, label: np.ndarray) -> np.ndarray:
    """``rows x TABLES`` bucket keys of unit vectors; the label and the size are part of a key."""
    a, b, odd = _projections(unit.shape[1])
    cells = np.floor((unit @ a + b) / WIDTH).astype(np.int64).view(np.uint64) * odd
    keys = cells.reshape(len(unit), TABLES, PROJECTIONS).sum(2, dtype=np.uint64)
    keys += (label.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(unit.shape[1]))[:, None]
    keys ^= keys >> np.uint64(31)
    keys *= np.uint64(0xBF58476D1CE4E5B9)
    return (keys ^ (keys >> np.uint64(29))).view(np.int64)


def _matrix(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """``(values, offsets)`` of a list column without nulls inside."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False).astype(np.float64), offsets


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored ``(vec_id, h1, h2)`` of all rows (null hashes: links with nothing), and the classes of equal vectors."""
    valid = (
        F.col("label").isNotNull() & F.col("embedding").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0)
    )
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    rows = rows.withColumn("embedding", F.when(F.coalesce(valid, F.lit(False)), F.col("embedding")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = []
            for label, v in zip(batch.column(1), batch.column(2), strict=True):
                if not v.is_valid:
                    both.append((None, None))
                    continue
                data = v.values.to_numpy(zero_copy_only=False).tobytes()
                digest = hashlib.blake2b(data, digest_size=16, key=str(label.as_py()).encode()).digest()
                both.append(tuple(np.frombuffer(digest, "<i8").tolist()))
            hashes = [pa.array([h[i] for h in both], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *hashes], names=["vec_id", "label", "embedding", "h1", "h2"])

    hashed = materialize(rows.mapInArrow(run, "vec_id long, label long, embedding array<double>, h1 long, h2 long"))
    classes = hashed.filter("h1 is not null").groupBy("h1", "h2").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("label").alias("label"), F.first("embedding").alias("embedding")
    )
    return hashed.select("vec_id", "h1", "h2"), materialize(classes)


def _keyed(classes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, at = _matrix(batch.column(2))
            sizes, label = np.diff(at), batch.column(1).to_numpy(zero_copy_only=False)
            keys = np.zeros((batch.num_rows, TABLES), np.int64)
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                keys[own] = table_keys(_unit(values[at[own][:, None] + np.arange(size)]), label[own])
            rep = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), TABLES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rep), pa.array(np.tile(np.arange(TABLES), batch.num_rows), pa.int64()), pa.array(keys.ravel())], names=["rep", "k", "key"]
            )

    return classes.select("rep", "label", "embedding").mapInArrow(run, "rep long, k long, key long")


def cell_links(x: np.ndarray, keys: np.ndarray, rep: np.ndarray, weight: np.ndarray, side: np.ndarray, k: int, least: float):
    """``(rep, links, root)`` of the rows of one cell that have links.

    ``side`` is None in a cell of one block; else pairs are taken across its two values.
    """
    norms = np.sqrt((x * x).sum(1))
    links, sets = np.zeros(len(rep), np.int64), _Sets(len(rep))
    left = np.arange(len(rep)) if side is None else np.flatnonzero(side == 0)
    right = left if side is None else np.flatnonzero(side == 1)
    for lo in range(0, len(left), 512):
        rows = left[lo : lo + 512]
        near = (x[rows] @ x[right].T) / (norms[rows][:, None] * norms[right][None, :]) >= least
        if side is None:
            near &= right[None, :] > rows[:, None]
        i, j = np.nonzero(near)
        i, j = rows[i], right[j]
        for b in range(0, len(i), 1 << 18):
            a, c = i[b : b + (1 << 18)], j[b : b + (1 << 18)]
            fresh = ~(keys[a, :k] == keys[c, :k]).any(1)
            np.add.at(links, a[fresh], weight[c[fresh]])
            np.add.at(links, c[fresh], weight[a[fresh]])
        sets.join(zip(i.tolist(), j.tolist(), strict=True))
    roots = np.array([sets.root(i) for i in range(len(rep))], np.int64)
    smallest = np.full(len(rep), np.iinfo(np.int64).max)
    np.minimum.at(smallest, roots, rep)
    root = smallest[roots]
    told = (links > 0) | (root != rep)
    return rep[told], links[told], root[told]


def near_vectors(vectors: DataFrame, least: float = COSINE) -> DataFrame:
    """``vectors(vec_id, embedding, label)`` -> ``(vec_id, n_links, component_id, kept)``, one row per input row.

    Vectors link at cosine ``least`` or more where their labels are equal and
    not null.  A null, empty or zero vector, or one that holds a null, NaN or
    infinite component, links with nothing and is its own component; vectors
    of different length do not link; equal vectors and repeated rows all
    link; a null vec_id has the component of its equals, null without any;
    an empty table gives an empty one; other columns are ignored.
    """
    spark = vectors.sparkSession
    with only_result(spark) as keep:
        hashed, classes = _classes(vectors)
        named = classes.filter("rep is not null")
        keyed = materialize(_keyed(named))
        company = keyed.groupBy("k", "key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        met = keyed.join(company, ["k", "key"]).withColumn("blocks", F.ceil(F.col("size") / F.lit(BLOCK)).cast("long"))
        own = F.pmod(F.xxhash64("rep"), F.col("blocks"))
        dealt = met.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        cells = dealt.select(
            "rep", "k", "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own"
        ).join(named.select("rep", "n", "label", "embedding"), "rep")
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        order = ["k", "key", "lo", "hi"]
        sorted_cells = cells.repartition(parts, *order).sortWithinPartitions(*order, "rep").select(*order, "own", "rep", "n", "label", "embedding")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for k, key, lo, hi, side, rep, n, label, vectors_ in _sorted_runs(batches, 4):
                turn = (k[1:] != k[:-1]) | (key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
                edges = np.flatnonzero(np.concatenate(([True], turn, [True])))
                out = []
                for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                    sizes = np.array([len(v) for v in vectors_[a:b]])
                    for size in np.unique(sizes):
                        at = a + np.flatnonzero(sizes == size)
                        x = np.stack(vectors_[at]).astype(np.float64)
                        across = None if lo[a] == hi[a] else (side[at] == hi[a]).astype(int)
                        out.append(cell_links(x, table_keys(_unit(x), label[at]), rep[at], n[at], across, int(k[a]), least))
                if out:
                    arrays = [pa.array(np.concatenate([o[i] for o in out]), pa.int64()) for i in range(3)]
                    yield pa.RecordBatch.from_arrays(arrays, names=["rep", "links", "root"])

        found = materialize(sorted_cells.mapInArrow(run, "rep long, links long, root long"))
        counted = found.groupBy("rep").agg(F.sum("links").alias("links"))
        grouped = connected_components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
        known = (
            classes.select("h1", "h2", "rep", "n")
            .join(counted, "rep", "left").join(grouped, F.col("rep") == grouped["id"], "left")
            .select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("root"))
        )
        return keep(hashed.join(known, ["h1", "h2"], "left").select(
            "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("root")).alias("component_id"),
        ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))


def q_embeddings(spark, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
