"""Exact substring removal by a sparse, range-partitioned suffix sort.

A byte goes when a ``LENGTH``-byte string that covers it starts anywhere
else too.  Sorting every suffix of the corpus would shuffle several times its
size, so suffixes are first thinned without loss.

1.  Every window of ``LENGTH`` bytes has one anchor: the least hash among the
    ``GRAM``-byte strings inside it.  Equal windows have equal anchors at equal
    places.  About one suffix in 77 is an anchor; the windows it stands for
    are a run, and their bytes together are its context.
2.  Anchor suffixes are range-partitioned by their leading eight bytes, with
    splitters sampled from the corpus (a lead that fills several ranges is
    spread over them).  Each bucket sorts its anchors and compares
    neighbours: equal contexts settle all their windows at once, an anchor
    string found once is done, and the rest, where one string stands in
    different contexts (the ends of copied passages), goes on with one
    representative per distinct context.
3.  Those contexts fetch their bytes, are range-partitioned by the same
    splitters, and each bucket sorts all their window suffixes by multikey
    quicksort, eight bytes a symbol; equal neighbours are duplicates.
    Splitters compare whole leads, so equal suffixes never lie on two sides
    of a boundary but for spread leads, whose windows are dealt by their
    place behind the anchor instead.

Copies within one task collapse before the shuffle, so a passage in a third
of all documents sends one row per task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventsieve.llm.texts import WordHash, flat, is_plain_scan, pieces
from eventsieve.session import materialize, only_result

LENGTH = 200
GRAM = 48
SAMPLE_DOCS = 4000
SAMPLE_LEADS = 20_000
CONTEXTS_A_CELL = 4000
MOST_CELLS = 64


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def gram_hashes(data: np.ndarray, code: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes from every position where they fit, by doubling."""
    powers, size = {1: code[data]}, 1
    while 2 * size <= gram:
        h = powers[size]
        powers[2 * size] = _mixed(h[:-size] * np.uint64(0x9E3779B97F4A7C15 + 2 * size) + h[size:])
        size *= 2
    out, covered = powers[size], size
    while covered < gram:
        size //= 2
        if covered + size <= gram:
            n = len(data) - covered - size + 1
            out = _mixed(out[:n] * np.uint64(0xC2B2AE3D27D4EB4F + 2 * size) + powers[size][covered : covered + n])
            covered += size
    return out


def window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost least value in every stretch of ``width`` values."""
    best, at, size = values, np.arange(len(values), dtype=np.int32), 1
    while 2 * size <= width:
        right = best[size:] < best[:-size]
        best, at, size = np.where(right, best[size:], best[:-size]), np.where(right, at[size:], at[:-size]), 2 * size
    rest = width - size
    if rest:
        right = best[rest:] < best[:-rest]
        at = np.where(right, at[rest:], at[:-rest])
    return at


class Anchors:
    """Anchors of every text of a piece: row, position, first window and number of windows, hashes."""

    def __init__(self, column: pa.Array, hasher: WordHash, length: int, gram: int):
        data, offsets = flat(column)
        empty = np.zeros(0, np.int64)
        self.row = self.p = self.first = self.n = empty
        self.g = self.x = self.lead = empty.astype(np.uint64)
        if len(data) < length:
            return
        hashes = gram_hashes(data, hasher.code[0], gram)
        at = window_minimum(hashes, length - gram + 1).astype(np.int64)
        sizes = np.diff(offsets)
        row = np.repeat(np.arange(len(sizes)), np.maximum(sizes - length + 1, 0))
        heads = np.cumsum(np.maximum(sizes - length + 1, 0)) - np.maximum(sizes - length + 1, 0)
        start = np.arange(len(row)) - heads[row] + offsets[row]  # every window inside one text
        if not len(start):
            return
        anchor = at[start]
        fresh = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]))))
        self.row, first, p = row[fresh], start[fresh], anchor[fresh]
        self.n = np.diff(np.append(fresh, len(row)))
        self.g = hashes[p]
        whole = hasher(data, first, first + self.n - 1 + length, 1)
        self.x = _mixed(whole + (p - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + self.n.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        self.lead = leads(data, p)
        self.p, self.first = p - offsets[self.row], first - offsets[self.row]


def leads(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from ``at`` as one number that orders like them."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data) + 1, ">u8", padded.tobytes(), strides=(1,))[at].astype(np.uint64)


def bucket_of(lead: np.ndarray, spread: np.ndarray, splitters: np.ndarray) -> np.ndarray:
    """Range of every lead; where a lead is itself several splitters, ``spread`` picks one of its ranges."""
    low, high = np.searchsorted(splitters, lead, "left"), np.searchsorted(splitters, lead, "right")
    wide = np.maximum(high - low, 1).astype(np.uint64)
    return low + (spread % wide).astype(np.int64)


def is_spread(lead: np.ndarray, splitters: np.ndarray) -> np.ndarray:
    return np.searchsorted(splitters, lead, "right") - np.searchsorted(splitters, lead, "left") > 1


def located(docs: DataFrame) -> DataFrame:
    """``(f, r, doc_id, text)``: file and row number tell rows apart whatever their ids."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    place = [F.xxhash64("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("r")]
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    if is_plain_scan(docs) and "_metadata" not in docs.columns:
        return docs.select(*place, F.col("doc_id").cast("long").alias("doc_id"), text)
    return materialize(plain).select(*place, "doc_id", text)


def sample_splitters(texts: DataFrame, buckets: int, length: int, gram: int) -> np.ndarray:
    """``buckets - 1`` splitters: quantiles of the leads of a bounded sample.  They balance the work only."""
    rows = texts.count()
    if not rows:
        return np.zeros(0, np.uint64)
    hasher = WordHash()
    every = max(1, rows // SAMPLE_DOCS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 0):
            a = Anchors(batch.column(0), hasher, length, gram)
            yield pa.RecordBatch.from_arrays([pa.array(a.lead.view(np.int64)), pa.array(a.x.view(np.int64))], names=["lead", "x"])

    chosen = texts.filter(F.pmod(F.xxhash64("f", "r"), F.lit(every)) == 0).select("text").mapInArrow(run, "lead long, x long")
    # Copies collapse before the shuffle, so a context counts once.
    leads_ = chosen.dropDuplicates(["lead", "x"]).orderBy(F.xxhash64("x")).limit(SAMPLE_LEADS).toPandas()["lead"].to_numpy(np.int64)
    ordered = np.sort(leads_.view(np.uint64))
    if not len(ordered):
        return np.zeros(0, np.uint64)
    return ordered[(np.arange(1, buckets) * len(ordered)) // buckets]


ANCHORS = "bucket int, g long, x long, f long, r long, p int, first int, n int, copies int, spread boolean"
MARKS = "f long, r long, p int, first int, n int, settled boolean, fetch boolean, cells int"


def _whole_partition(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray] | None:
    held = [b for b in batches if b.num_rows]
    if not held:
        return None
    return [pa.chunked_array([b.column(i) for b in held]).to_numpy() for i in range(held[0].num_columns)]


def anchor_marks(texts: DataFrame, splitters: np.ndarray, buckets: int, length: int, gram: int) -> DataFrame:
    """Steps 1 and 2: the anchors that are settled, and those whose windows must be sorted."""
    hasher = WordHash()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 2):
            a = Anchors(batch.column(2), hasher, length, gram)
            if not len(a.p):
                continue
            order = np.lexsort((a.x, a.g))
            same = np.concatenate(([False], (a.g[order][1:] == a.g[order][:-1]) & (a.x[order][1:] == a.x[order][:-1])))
            group = np.cumsum(~same) - 1
            copies = np.bincount(group)[group]
            # One row per distinct context is compared; further copies are settled here and go where there is room.
            sent = np.where(same, 0, copies)
            bucket = np.where(same, np.arange(len(order)) % buckets, bucket_of(a.lead, a.x, splitters)[order])
            f, r = (batch.column(i).to_numpy()[a.row[order]] for i in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket.astype(np.int32)), pa.array(a.g[order].view(np.int64)), pa.array(a.x[order].view(np.int64)), pa.array(f), pa.array(r),
                 *(pa.array(v[order].astype(np.int32)) for v in (a.p, a.first, a.n)), pa.array(sent.astype(np.int32)), pa.array(is_spread(a.lead, splitters)[order])],
                names=[c.split()[0] for c in ANCHORS.split(", ")],
            )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = _whole_partition(batches)
        if got is None:
            return
        _, g, x, f, r, p, first, n, copies, spread = got
        extra = copies == 0
        order = np.concatenate([np.flatnonzero(extra), np.flatnonzero(~extra)[np.lexsort((x[~extra], g[~extra]))]])
        k = int(extra.sum())
        live = order[k:]
        settled, fetch, cells = np.zeros(len(g), bool), np.zeros(len(g), bool), np.ones(len(g), np.int32)
        settled[order[:k]] = True
        if len(live):
            new_g = np.concatenate(([True], g[live][1:] != g[live][:-1]))
            new_x = new_g | np.concatenate(([True], x[live][1:] != x[live][:-1]))
            context, string = np.cumsum(new_x) - 1, np.cumsum(new_g) - 1
            settled[live] = np.bincount(context, copies[live])[context] > 1
            distinct = np.bincount(string[new_x])[string]
            # A spread lead lies in several buckets: whether its string stands elsewhere is not known here.
            fetch[live] = new_x & ((distinct > 1) | spread[live])
            cells[live] = np.clip(-(-distinct // CONTEXTS_A_CELL), 1, MOST_CELLS)
            cells[live] = np.where(spread[live], MOST_CELLS // 4, cells[live])
        told = np.flatnonzero(settled | fetch)
        for lo in range(0, len(told), 1 << 16):
            own = told[lo : lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v[own]) for v in (f, r, p, first, n, settled, fetch, cells)], names=[c.split()[0] for c in MARKS.split(", ")]
            )

    anchors = texts.select("f", "r", "text").mapInArrow(scan, ANCHORS)
    return anchors.repartitionById(buckets, F.col("bucket")).mapInArrow(compare, MARKS)


def equal_suffixes(data: np.ndarray, at: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` bytes from each position equal those of another one of its group.

    Multikey quicksort over eight-byte symbols, all groups side by side: each
    round sorts by the next symbol within the groups still tied, splits them,
    and drops those of one member.
    """
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    symbols = np.ndarray(len(data) + 1, ">u8", padded.tobytes(), strides=(1,))
    alive = np.arange(len(at))
    # The last symbol starts so that it ends with the window.
    for depth in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        if not len(alive):
            break
        symbol = symbols[at[alive] + depth].astype(np.uint64)
        order = np.lexsort((symbol, group))
        alive, symbol, group = alive[order], symbol[order], group[order]
        turn = np.concatenate(([True], (group[1:] != group[:-1]) | (symbol[1:] != symbol[:-1])))
        group = np.cumsum(turn) - 1
        tied = np.bincount(group)[group] > 1
        alive, group = alive[tied], group[tied]
    out = np.zeros(len(at), bool)
    out[alive] = True
    return out


CONTEXTS = "bucket int, cell int, lead long, f long, r long, first int, back int, lo int, hi int, want boolean, bytes binary"


def repeated_windows(texts: DataFrame, marks: DataFrame, splitters: np.ndarray, buckets: int, length: int) -> DataFrame:
    """Step 3: ``(f, r, span)`` of the windows of fetched contexts that occur elsewhere."""
    asked = marks.filter("fetch").groupBy("f", "r").agg(F.collect_list(F.struct("p", "first", "n", "cells", "settled")).alias("asked"))
    joined = texts.select("f", "r", "text").join(asked, ["f", "r"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 2):
            lists = batch.column(3)
            flat_ = lists.flatten()
            row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            p, first, n, cells, settled = (flat_.field(i).to_numpy(zero_copy_only=False) for i in range(5))
            data, offsets = flat(batch.column(2))
            begin = offsets[row] + first
            lead = leads(data, offsets[row] + p)
            # Windows are cut by their place behind the anchor into cells of equal stretches.
            back = (p - first).astype(np.int64)  # place of the anchor in the first window
            step = -(-length // cells)
            owner = np.repeat(np.arange(len(p)), cells)
            cell = np.arange(len(owner)) - np.repeat(np.cumsum(cells) - cells, cells)
            # Window i of a context has its anchor at place back - i; a cell takes places [cell * step, (cell + 1) * step).
            lo = np.maximum(0, back[owner] - (cell + 1) * step[owner] + 1)
            hi = np.minimum(n[owner] - 1, back[owner] - cell * step[owner])
            keep = np.flatnonzero(lo <= hi)
            owner, cell, lo, hi = owner[keep], cell[keep], lo[keep], hi[keep]
            raw = data.tobytes()
            body = [raw[a:b] for a, b in zip((begin[owner] + lo).tolist(), (begin[owner] + hi + length).tolist(), strict=True)]
            f, r = (batch.column(i).to_numpy()[row[owner]] for i in (0, 1))
            spread = cell.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(7)
            for a in range(0, len(owner), 1 << 14):
                c = slice(a, a + (1 << 14))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket_of(lead[owner[c]], spread[c], splitters).astype(np.int32)), pa.array(cell[c].astype(np.int32)), pa.array(lead[owner[c]].view(np.int64)),
                     pa.array(f[c]), pa.array(r[c]), pa.array((first[owner[c]] + lo[c]).astype(np.int32)), pa.array((back[owner[c]] - lo[c]).astype(np.int32)),
                     pa.array(lo[c].astype(np.int32)), pa.array(hi[c].astype(np.int32)), pa.array(~settled[owner[c]]), pa.array(body[c], pa.binary())],
                    names=[x.split()[0] for x in CONTEXTS.split(", ")],
                )

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        lead, first, back, lo, hi, want = (table.column(i).to_numpy() for i in ("lead", "first", "back", "lo", "hi", "want"))
        f, r = table.column("f").to_numpy(), table.column("r").to_numpy()
        data, offsets = flat(table.column("bytes").chunk(0))
        order = np.argsort(lead, kind="stable")
        cuts = np.flatnonzero(np.concatenate(([True], lead[order][1:] != lead[order][:-1], [True])))
        count = (hi - lo + 1).astype(np.int64)
        # Leads one after the other, a bounded number of suffixes at a time.
        begin = 0
        totals = np.concatenate(([0], np.cumsum(count[order])))
        while begin < len(cuts) - 1:
            end = begin + 1
            while end < len(cuts) - 1 and totals[cuts[end + 1]] - totals[cuts[begin]] <= 2_000_000:
                end += 1
            own = order[cuts[begin] : cuts[end]]
            begin = end
            owner = np.repeat(own, count[own])
            i = np.arange(len(owner)) - np.repeat(np.cumsum(count[own]) - count[own], count[own])
            place = back[owner] - i
            # Only windows with equal leads and the anchor at the same place can be equal.
            key = _mixed(lead[owner].view(np.uint64) + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            twice = equal_suffixes(data, offsets[owner] + i, key.view(np.int64), length) & want[owner]
            hit = np.flatnonzero(twice)
            if not len(hit):
                continue
            at = first[owner[hit]].astype(np.int64) + i[hit]
            fresh = np.concatenate(([True], (owner[hit][1:] != owner[hit][:-1]) | (at[1:] != at[:-1] + 1)))
            head = np.flatnonzero(fresh)
            tail = np.append(head[1:], len(hit)) - 1
            span = (at[head] << 32) | (at[tail] + length)
            yield pa.RecordBatch.from_arrays([pa.array(f[owner[hit[head]]]), pa.array(r[owner[hit[head]]]), pa.array(span)], names=["f", "r", "span"])

    contexts = joined.mapInArrow(fetch, CONTEXTS)
    return contexts.repartitionById(buckets, F.col("bucket")).mapInArrow(sort, "f long, r long, span long")


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep_bytes: bool = True) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept)``, one row per document.

    Texts are their UTF-8 bytes, a null one is empty; a text under ``length``
    bytes keeps all; copies, also within one text and overlapping ones, lose
    every byte they cover, the first one too; a very long text is searched whole.  Rows are told apart by their
    place in the input, so repeated and null ids do no harm.  An empty table
    gives an empty one; other columns are ignored.  ``kept`` may cut a
    character in two and is left out without ``keep_bytes``.
    """
    if not 8 <= gram <= length - 8:
        raise ValueError("gram must be at least 8 bytes and 8 shorter than length")
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = located(docs)
    splitters = sample_splitters(texts, buckets, length, gram)
    marks = materialize(anchor_marks(texts, splitters, buckets, length, gram))
    found = materialize(repeated_windows(texts, marks, splitters, buckets, length))
    span = F.shiftleft(F.col("first").cast("long"), 32).bitwiseOR((F.col("first") + F.col("n") - 1 + length).cast("long"))
    spans = marks.filter("settled").select("f", "r", span.alias("span")).unionByName(found)
    by_row = spans.groupBy("f", "r").agg(F.collect_list("span").alias("spans"))
    joined = texts.join(by_row, ["f", "r"], "left").select("doc_id", "text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            data, offsets = flat(batch.column(1))
            rows = []
            for i, spans_ in enumerate(batch.column(2)):
                text = data[offsets[i] : offsets[i + 1]]
                removed = n_spans = 0
                if spans_.is_valid and len(spans_):
                    packed = spans_.values.to_numpy()
                    turns = np.zeros(len(text) + 1, np.int32)
                    np.add.at(turns, packed >> 32, 1)
                    np.add.at(turns, packed & 0xFFFFFFFF, -1)
                    gone = np.cumsum(turns[:-1]) > 0
                    removed, n_spans = int(gone.sum()), int(np.count_nonzero(np.diff(gone.view(np.int8), prepend=0) == 1))
                    size, text = len(text), text[~gone]
                else:
                    size = len(text)
                body = text.tobytes()
                rows.append((size, removed, n_spans, hashlib.sha256(body).hexdigest(), body if keep_bytes else None))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            columns = [pa.array([x[k] for x in rows], t) for k, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[c.split()[0] for c in RESULT.split(", ")])

    out = joined.mapInArrow(cut, RESULT)
    return out if keep_bytes else out.drop("kept")


def q_suffixes(spark, sf_dir: str) -> DataFrame:
    with only_result(spark) as keep:
        return keep(remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep_bytes=False))

