"""Whole texts as byte arrays: Arrow batches, words and word hashes in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE_BYTES = 2 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def led_text(text: Column) -> Column:
    """The text behind one line feed, null as empty: no word or n-gram spans two documents of a batch."""
    return F.concat(F.lit("\n"), F.coalesce(text.cast("string"), F.lit("")))


def id_bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def is_plain_scan(df: DataFrame) -> bool:
    """Whether every row stands for one place in a file: a scan under filters and projections alone."""
    node = df._jdf.queryExecution().analyzed()
    while node.children().size() == 1 and node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().head()
    return node.getClass().getSimpleName() == "LogicalRelation"


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string or binary column; offsets start at 0."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces(batches: Iterator[pa.RecordBatch], text: int, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows that hold about ``limit`` bytes of column ``text``, one row at least."""
    for batch in batches:
        _, at = flat(batch.column(text))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
            yield batch.slice(lo, hi - lo)
            lo = hi


def frequent_first(values: np.ndarray, times: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The values by falling number of times, and the places among them: small numbers, which pack well."""
    order = np.argsort(-times, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return values[order], times[order], rank[places]


def packed(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, all first bytes, then all second ones and so on, compressed."""
    planes = values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    return np.frombuffer(pa.decompress(data[8:], 4 * n, "zstd", asbytes=True), np.uint8).reshape(4, n).T.copy().view("<u4").reshape(-1)


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; every document starts with a line feed (``led_text``)."""
    inside = ~SPACE[data]
    turns = np.diff(inside.view(np.int8), prepend=0, append=0)
    return np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    filled = 1
    while filled < n:
        more = min(filled, n - filled)
        out[filled : filled + more] = out[:more] * np.uint64(pow(base, filled, 1 << 64))
        filled += more
    return out


class WordHash:
    """Two independent 64-bit hashes of many byte spans at once.

    Each byte is replaced by a random 64-bit number; a span's hash is the
    polynomial of those numbers modulo 2**64, taken as a difference of prefix
    sums, mixed with its length.  Both together identify a word (128 bits).
    """

    def __init__(self, seed: int = 20240613, step: int = 1 << 20):
        rng = np.random.default_rng(seed)
        self.code = [rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in (0, 1)]
        bases = [int(x) | 5 for x in rng.integers(1 << 60, 1 << 62, 2)]
        self.made, self.bases, self.step = (seed, step), bases, step
        self.up = [_powers(b, step + 1) for b in bases]
        self.down = [_powers(pow(b, -1, 1 << 64), step + 1) for b in bases]

    def __reduce__(self):
        return WordHash, self.made  # tasks build the tables anew

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
        out = np.empty(len(starts), np.uint64)
        lo = 0
        while lo < len(starts):
            first = int(starts[lo])
            hi = max(lo + 1, int(np.searchsorted(ends, first + self.step, "right")))
            last = int(ends[hi - 1])
            up, down = self.up[which], self.down[which]
            if last - first > self.step:  # one span longer than the tables
                up, down = _powers(self.bases[which], last - first + 1), _powers(pow(self.bases[which], -1, 1 << 64), last - first + 1)
            sums = np.zeros(last - first + 1, np.uint64)
            np.cumsum(self.code[which][data[first:last]] * up[: last - first], out=sums[1:])
            a, b = starts[lo:hi] - first, ends[lo:hi] - first
            out[lo:hi] = (sums[b] - sums[a]) * down[a]
            lo = hi
        out += (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(31)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        return out ^ (out >> np.uint64(29))
