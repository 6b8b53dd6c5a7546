"""Packing documents into sequences of bounded length by best-fit decreasing.

Documents are tokenised, and overlong ones are first cut into full windows.
The rests are placed longest first, each into the open window with the least
room that still holds it; a segment tree over room (0 to the window's length)
finds that window in a logarithm of steps.

Every task packs what it has tokenised itself, in rounds of ``ROUND_TOKENS``,
so neither tokens nor lengths are shuffled and memory is bounded by a round
and the longest document.  Windows that best-fit leaves with more than
``TOLERANCE`` tokens of room are topped up from the emptiest ones, whose
documents are cut for it; one window of a round stays open and goes into the
next.  The last one of a task is cut at powers of two, where no padding is
needed.  A task's result depends on its own rows alone, so that a lost one
comes out the same when it runs again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventsieve.llm.texts import pieces
from eventsieve.llm.vocabularies import ByteLevel, TextEncoder, public_file, read_file

WINDOW = 2048
END_ID = 1
TOLERANCE = 8
ROUND_TOKENS = 1 << 22
TASK_BITS = 40  # a sequence's id is its task's number, then its number in the task

Piece = tuple[int, int, int]  # document of the task, first token, tokens


class OpenWindows:
    """Open windows by room: a segment tree whose leaves are rooms and whose nodes count the windows below."""

    def __init__(self, window: int = WINDOW):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(window + 1)]

    def _change(self, room: int, by: int) -> None:
        node = self.leaves + room
        while node:
            self.count[node] += by
            node >>= 1

    def add(self, window: int, room: int) -> None:
        self.windows[room].append(window)
        self._change(room, 1)

    def take_tightest(self, need: int) -> tuple[int, int] | None:
        """``(window, room)`` of the open window with the least room of at least ``need``, taken out; None if none is."""
        count, node = self.count, self.leaves + need
        if not count[node]:
            while node & 1 or not count[node + 1]:  # up, until a right neighbour holds a window
                node >>= 1
                if node <= 1:
                    return None
            node += 1
            while node < self.leaves:  # down to its first leaf in use
                node *= 2
                node += not count[node]
        room = node - self.leaves
        self._change(room, -1)
        return self.windows[room].pop(), room


def best_fit(items: list[Piece], window: int = WINDOW) -> list[list[Piece]]:
    """Windows filled by best-fit decreasing; items of one length keep their order."""
    filled: list[list[Piece]] = []
    open_ = OpenWindows(window)
    for item in sorted(items, key=lambda p: -p[2]):
        found = open_.take_tightest(item[2])
        if found is None:
            found = len(filled), window
            filled.append([])
        at, room = found
        filled[at].append(item)
        if room > item[2]:
            open_.add(at, room - item[2])
    return filled


def topped_up(windows: list[list[Piece]], window: int = WINDOW, tolerance: int = TOLERANCE) -> tuple[list[list[Piece]], list[Piece]]:
    """Close windows with at most ``tolerance`` tokens of room: the closed ones, and the pieces of one left open."""
    fill = [sum(p[2] for p in w) for w in windows]
    closed = [w for w, f in zip(windows, fill, strict=True) if window - f <= tolerance]
    order = sorted((i for i, f in enumerate(fill) if window - f > tolerance), key=lambda i: -fill[i])
    left = [list(windows[i]) for i in order]
    full, empty = 0, len(left) - 1
    room = window - fill[order[0]] if left else 0
    while full < empty:
        doc, start, length = left[empty].pop()
        moved = min(length, room)
        left[full].append((doc, start + length - moved, moved))
        if moved < length:
            left[empty].append((doc, start, length - moved))
        room -= moved
        if not left[empty]:
            empty -= 1
        if room <= tolerance:
            closed.append(left[full])
            full += 1
            room = window - sum(p[2] for p in left[full]) if full <= empty else 0
    return closed, left[full] if left and full <= empty else []


def at_powers_of_two(rest: list[Piece], window: int = WINDOW, tolerance: int = TOLERANCE) -> list[list[Piece]]:
    """The pieces of one window as sequences of power-of-two lengths; whole where its padding is within ``tolerance``."""
    total = sum(p[2] for p in rest)
    if not total or window - total <= tolerance:
        return [rest] if rest else []
    out: list[list[Piece]] = []
    room = 0
    for doc, start, length in rest:
        while length:
            if not room:
                room = 1 << (total.bit_length() - 1)
                total -= room
                out.append([])
            own = min(room, length)
            out[-1].append((doc, start, own))
            start, length, room = start + own, length - own, room - own
    return out


class Packer:
    """Takes a task's documents one by one and gives sequences by rounds."""

    def __init__(self, window: int, tolerance: int):
        self.window, self.tolerance = window, tolerance
        self.ids: dict[int, tuple[object, np.ndarray]] = {}
        self.items: list[Piece] = []
        self.done: list[list[Piece]] = []
        self.seen = self.held = 0

    def add(self, doc_id: object, ids: np.ndarray) -> None:
        number, n = self.seen, len(ids)
        self.ids[number] = doc_id, ids
        whole = n - n % self.window
        self.done += [[(number, lo, self.window)] for lo in range(0, whole, self.window)]
        if n > whole:
            self.items.append((number, whole, n - whole))
        self.seen += 1
        self.held += n

    def sequences(self, last: bool) -> list[list[Piece]]:
        """The sequences closed by now; pieces left open stay for the next round unless it is the last."""
        closed, rest = topped_up(best_fit(self.items, self.window), self.window, self.tolerance)
        out = self.done + closed
        if last:
            out += at_powers_of_two(rest, self.window, self.tolerance)
            rest = []
        self.items, self.done = rest, []
        return out

    def forget(self) -> None:
        """Drop the documents that no open piece belongs to."""
        self.ids = {d: self.ids[d] for d, _, _ in self.items}
        self.held = sum(len(ids) for _, ids in self.ids.values())


PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, row_id long"


def pack_documents(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, tolerance: int = TOLERANCE) -> DataFrame:
    """``PIECES``, one row per piece of a document: where it begins in the document and in its sequence.

    ``ids`` are little-endian unsigned 32-bit token ids; a document is its text's
    ids, then ``END_ID``.  A null or empty text is its end alone.  Every id lies
    in one piece; a sequence's pieces are gapless from offset 0 and hold at most
    ``window`` ids.  ``row_id`` tells rows with equal or null ids apart; texts
    that are equal are packed each for itself; items of equal length are taken in
    the order of the input.  A very long text is encoded by its chunks, cut into
    windows and held by its task until its round is over.  An empty table
    gives an empty one; other columns are ignored.
    """
    if window < 1 or window & (window - 1) or not 0 <= tolerance < window:
        raise ValueError("a window is a power of two, the tolerance smaller")
    content = read_file(tokenizer or public_file("byte_bpe_50k.json"))
    names = [c.split()[0] for c in PIECES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = TextEncoder(ByteLevel(content))
        packer = Packer(window, tolerance)
        task = TaskContext.get().partitionId() << TASK_BITS
        given = 0

        def rows(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal given
            out = packer.sequences(last)
            for lo in range(0, len(out), 256):
                columns: list[list] = [[] for _ in names]
                for sequence in out[lo : lo + 256]:
                    offset = 0
                    for doc, start, length in sequence:
                        doc_id, ids = packer.ids[doc]
                        values = (doc_id, start, length, ids[start : start + length].astype("<u4").tobytes(), len(ids), task + given, offset, task + doc)
                        for column, value in zip(columns, values, strict=True):
                            column.append(value)
                        offset += length
                    given += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.binary() if n == "ids" else pa.int64()) for c, n in zip(columns, names, strict=True)], names=names)
            packer.forget()

        for batch in pieces(batches, 1):
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1)), strict=True):
                packer.add(doc_id, np.append(ids, np.uint32(END_ID)))
            if packer.held >= ROUND_TOKENS:
                yield from rows(False)
        yield from rows(True)

    return docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(run, PIECES)


def padded_sequences(packed: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """``(sequence_id, n_tokens, ids)`` from the pieces: ids padded to ``window``, but for lengths at a power of two.

    A sequence has at most ``window`` pieces, so its group is bounded.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts"))
    ids = F.aggregate("parts", F.lit(b""), lambda done, p: F.concat(done, p["ids"]))
    n = F.col("n_tokens")
    pad = np.array([pad_id], "<u4").tobytes()
    padded = F.when(F.bit_count(n) == 1, F.col("ids")).otherwise(F.rpad("ids", F.lit(4 * window), F.lit(pad)))
    return whole.withColumn("ids", ids).select("sequence_id", "n_tokens", padded.alias("ids"))


def q_packing(spark, sf_dir: str) -> DataFrame:
    packed = pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
