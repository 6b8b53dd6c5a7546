"""SimHash near-duplicates by a segment-popcount embedding.

A 64-bit fingerprint is mapped to the bit counts of 32 two-bit segments (a
vector of 0, 1, 2 held in one long).  Two fingerprints at Hamming distance d
are at Manhattan distance at most d in that space, so it is a lower bound.
The range join works on a grid: the 32 counts form ``max_bits + 3`` groups
of segments; a pair within ``max_bits`` differs in at most that many groups,
so some choice of three groups is equal in both.  One key per choice of
three groups buckets the fingerprints; inside a bucket the Manhattan bound
and then the exact distance are checked.

Equal fingerprints collapse before the join.  A bucket returns a star per
linked set (at most rows - 1 links), never its pairs; a bucket of more than
``BLOCK`` rows is split by exact bits instead of compared all against all.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from eventsieve.llm.components import connected_components
from eventsieve.llm.texts import is_plain_scan
from eventsieve.session import materialize, only_result

SEED = 42
BLOCK = 1024
EQUAL_GROUPS = 3


def text_fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of one text: bit set when over half of the shingle hashes have it."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(shingle, len(words))
    n = len(words) - size + 1
    spans = zip(starts[:n].tolist(), ends[size - 1 :].tolist(), strict=True)
    hashes = np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in spans), "<u8", n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 4096):
        bits = np.unpackbits(hashes[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, fp)`` of every document, and its columns ``keep`` of longs; ``fp`` is the 64 bits as a signed long."""
    names = ["doc_id", "fp", *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((text_fingerprint(t.as_py(), shingle) for t in batch.column(1)), "<u8", batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view("<i8")), *batch.columns[2:]], names=names)

    taken = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *[F.col(c).cast("long").alias(c) for c in keep])
    return taken.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def segment_counts(x: np.ndarray) -> np.ndarray:
    """Bit counts of the 32 two-bit segments, two bits each in one word."""
    low = np.uint64(0x5555555555555555)
    return (x & low) + ((x >> np.uint64(1)) & low)


def manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Manhattan distance of packed segment counts (fields 0..2)."""
    low = np.uint64(0x5555555555555555)
    differ = a ^ b
    # 0-1 and 1-2 differ by one, 0-2 by two: fields 01^00, 01^10 (=11) and 10^00 (=10).
    return np.bitwise_count(differ & low).astype(np.int64) + 2 * np.bitwise_count((differ >> np.uint64(1)) & ~differ & low)


def _segment_groups(max_bits: int) -> list[int]:
    """Masks over the packed counts, one per group of neighbouring segments."""
    groups = np.array_split(np.arange(32), max_bits + EQUAL_GROUPS)
    return [sum(3 << (2 * int(s)) for s in g) for g in groups]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def grid_masks(max_bits: int) -> list[int]:
    return [sum(c) for c in combinations(_segment_groups(max_bits), EQUAL_GROUPS)]


def _embedding(fp: Column) -> Column:
    low = F.lit(0x5555555555555555)
    even, odd = fp.bitwiseAND(low), F.shiftrightunsigned(fp, 1).bitwiseAND(low)
    # The sum of two bits without a carry into the sign, which ANSI mode would call an overflow.
    return F.shiftleft(even.bitwiseAND(odd), 1).bitwiseOR(even.bitwiseXOR(odd))


class _Sets:
    """Disjoint sets over positions 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, pairs) -> None:
        for i, j in pairs:
            a, b = self.root(i), self.root(j)
            self.up[max(a, b)] = min(a, b)


def _near(x: np.ndarray, e: np.ndarray, max_bits: int) -> np.ndarray:
    i, j = np.nonzero(np.triu(manhattan(e[:, None], e[None, :]) <= max_bits, 1))
    keep = np.bitwise_count(x[i] ^ x[j]) <= max_bits
    return np.stack([i[keep], j[keep]], 1)


def _link(x: np.ndarray, at: np.ndarray, sets: _Sets, max_bits: int, chunks: int) -> None:
    """Join positions ``at`` of ``x`` that lie within ``max_bits``; larger sets are split by exact bits."""
    if len(at) <= BLOCK or chunks > 64:
        for lo in range(0, len(at), BLOCK):
            for hi in range(lo, len(at), BLOCK):
                own = np.unique(np.concatenate([at[lo : lo + BLOCK], at[hi : hi + BLOCK]]))
                pairs = _near(x[own], segment_counts(x[own]), max_bits)
                sets.join(zip(own[pairs[:, 0]].tolist(), own[pairs[:, 1]].tolist(), strict=True))
        return
    # Of `chunks` runs of bits at most max_bits differ, so chunks - max_bits agree exactly.
    bits = np.array_split(np.arange(64), chunks)
    for kept in combinations(range(chunks), chunks - max_bits):
        mask = np.uint64(sum(1 << int(b) for k in kept for b in bits[k]))
        key = x[at] & mask
        order = np.argsort(key, kind="stable")
        cuts = np.flatnonzero(np.diff(key[order])) + 1
        edges = np.concatenate(([0], cuts, [len(at)]))
        for k in np.flatnonzero(np.diff(edges) > 1):
            _link(x, np.sort(at[order[edges[k] : edges[k + 1]]]), sets, max_bits, chunks * 2 if chunks < 32 else 65)


def bucket_links(fp: np.ndarray, rep: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Star links ``(member, smallest)`` of the linked sets among one bucket's rows."""
    if len(fp) == 2:
        near = np.bitwise_count(fp[:1] ^ fp[1:])[0] <= max_bits
        return (rep[:1], rep[1:]) if near else (rep[:0], rep[:0])
    sets = _Sets(len(fp))
    _link(fp, np.arange(len(fp)), sets, max_bits, max_bits + 5)
    roots = np.array([sets.root(i) for i in range(len(fp))])
    smallest = np.full(len(fp), np.iinfo(np.int64).max)
    np.minimum.at(smallest, roots, rep)
    linked = smallest[roots] != rep
    return rep[linked], smallest[roots][linked]


def _sorted_runs(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[list[np.ndarray]]:
    """Whole runs of equal keys from sorted batches, several runs at a time."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if held is not None:
            cols = [np.concatenate([h, c]) for h, c in zip(held, cols, strict=True)]
        if not len(cols[0]):
            continue
        same = np.ones(len(cols[0]), bool)
        for c in cols[:n_keys]:
            same &= c == c[-1]
        cut = int(np.argmin(same[::-1])) if not same.all() else len(same)
        cut = len(same) - cut
        if cut:
            yield [c[:cut] for c in cols]
        held = [c[cut:] for c in cols]
    if held is not None and len(held[0]):
        yield held


def fingerprint_links(classes: DataFrame, max_bits: int = 3) -> DataFrame:
    """``(fp, rep)`` with distinct fingerprints -> links ``(a, b)`` between reps.

    Two reps are connected by the links exactly when a chain of fingerprints
    at most ``max_bits`` apart joins them.
    """
    masks = grid_masks(max_bits)
    cells = F.array(*[
        F.struct(F.lit(k).alias("k"), F.col("e").bitwiseAND(F.lit(_signed(m))).alias("cell")) for k, m in enumerate(masks)
    ])
    grid = (
        classes.withColumn("e", _embedding(F.col("fp")))
        .select(F.explode(cells).alias("c"), "fp", "rep")
        .select("c.k", "c.cell", "fp", "rep")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, cell, fp, rep in _sorted_runs(batches, 2):
            fresh = np.concatenate(([True], (k[1:] != k[:-1]) | (cell[1:] != cell[:-1]), [True]))
            edges = np.flatnonzero(fresh)
            out = [
                bucket_links(fp[a:b].view("<u8"), rep[a:b], max_bits)
                for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)
                if b - a > 1
            ]
            if out:
                arrays = [pa.array(np.concatenate([o[i] for o in out]), pa.int64()) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(arrays, names=["a", "b"])

    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = grid.repartition(parts, "k", "cell").sortWithinPartitions("k", "cell", "fp")
    return dealt.mapInArrow(run, "a long, b long")


def simhash_components(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """Near-duplicate groups of ``docs(doc_id, text)``.

    Returns ``(doc_id, fingerprint, component_id)``, one row per input row.
    A null or empty text has fingerprint zero and is linked like any other;
    a text of fewer words than ``shingle`` is one shingle; repeated rows stay
    repeated; a very long text is hashed whole; an empty table gives an empty
    one; other columns are ignored.
    A null doc_id stays null and carries no group: its ``component_id`` is
    that of its fingerprint's smallest doc_id, null if it has none.
    """
    with only_result(docs.sparkSession) as keep:
        fps = materialize(fingerprints(docs, shingle))
        classes = fps.groupBy("fp").agg(F.min("doc_id").alias("rep"))
        links = fingerprint_links(classes.filter("rep is not null"), max_bits)
        grouped = connected_components(links)
        roots = classes.join(grouped, classes.rep == grouped.id, "left").select(
            "fp", F.coalesce("component", "rep").alias("component_id")
        )
        return keep(fps.join(roots, "fp").select(
            "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
        ))


def keep_representatives(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """The rows of ``docs``, columns unchanged, one row per near-duplicate group.

    Rows are told apart by their place in the stored table, not by their id:
    rows that share an id but not a group stay both, and rows without an id are
    grouped like any other.  Of a group the row with the smallest doc_id stays,
    null last, of equal ids the first by place.  Null and empty texts are one
    group; a very long text is hashed whole; an empty table gives an empty one;
    columns of any name come through.
    """
    stored = docs if is_plain_scan(docs) and "_metadata" not in docs.columns else materialize(docs)
    place = [F.xxhash64("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row")]
    fps = materialize(fingerprints(stored.select("doc_id", "text", *place), shingle, ("__file", "__row")))
    # Groups are named by fingerprints, which every row has.
    classes = fps.select("fp").distinct().withColumn("rep", F.col("fp"))
    grouped = connected_components(fingerprint_links(classes, max_bits))
    named = fps.join(grouped, fps.fp == grouped.id, "left").withColumn("__group", F.coalesce("component", "fp"))
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.coalesce("doc_id", F.lit(0)).alias("d"), "__file", "__row")
    first = named.groupBy("__group").agg(F.min(order).alias("m"))
    kept = first.select(F.col("m.__file").alias("__kept_file"), F.col("m.__row").alias("__kept_row"))
    rows = stored.select(F.struct("*").alias("__whole"), *place)
    match = (F.col("__file") == F.col("__kept_file")) & (F.col("__row") == F.col("__kept_row"))
    return rows.join(kept, match, "left_semi").select("__whole.*")


def q_simhash(spark, sf_dir: str) -> DataFrame:
    return simhash_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
