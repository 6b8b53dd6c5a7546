"""Periodic runs of words, found with a dictionary of basic factors.

A run is a stretch of words with smallest period ``p`` (words ``p`` apart are
equal), at least ``max(MIN_WORDS, MIN_EXPONENT * p)`` words long, that no
neighbouring word extends.

Method.  Every stretch of ``2**k`` words (a basic factor) gets a name, equal
names for equal factors, from the names of its two halves.  Factors that occur
once in their document get none and drop out, so later powers are short in
plain prose.  For each power, a factor's next occurrence within ``2 * 2**k``
words gives a distance; three occurrences at one distance (an arithmetic
progression) propose it as a period.  With ``p <= 2**k < 2p`` the next
occurrence inside a run of four periods is exactly ``p`` away, so every run is
proposed.  Proposals are extended both ways by descending powers of the names
(equal names, equal words), and equal runs are kept once.

Documents are independent: pieces of whole texts go through numpy in
``mapInArrow``, nothing is shuffled.  A very long text is one piece of its own,
4 bytes a word for each power of two at which something still repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventsieve.llm.texts import WordHash, flat, led_text, pieces, word_spans

MIN_WORDS = 6
MIN_EXPONENT = 4
BLANK = r"[\x20\x09-\x0D]+"


def _grouped(key: np.ndarray, place: np.ndarray, differs: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``(place, name)`` by name, then place, of the keys that occur more than once; places come ascending."""
    order = np.argsort(key, kind="stable")
    fresh = np.empty(len(key), bool)
    fresh[:1] = True
    own = key[order]
    np.not_equal(own[1:], own[:-1], out=fresh[1:])
    if differs is not None:
        other = differs[order]
        fresh[1:] |= other[1:] != other[:-1]
    alone = fresh & np.append(fresh[1:], True)
    return place[order[~alone]], np.cumsum(fresh)[~alone] - 1


class Factors:
    """Names of the basic factors of some documents' words, -1 where a factor occurs once or passes its document."""

    def __init__(self, h1: np.ndarray, h2: np.ndarray, doc: np.ndarray):
        n = len(h1)
        count = np.bincount(doc) if n else np.zeros(0, np.int64)
        ends = np.cumsum(count)
        self.stop, self.first = ends[doc], (ends - count)[doc]
        self.names: list[np.ndarray] = []
        self.proposed: list[tuple[np.ndarray, np.ndarray]] = []
        # A word is told by 128 bits and its document.
        key = (h1 ^ (doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
        place, name = _grouped(key, np.arange(n), h2)
        while len(place):
            self._take(place, name, n)
            size = 1 << (len(self.names) - 1)
            own = self.names[-1]
            at = np.sort(place)
            at = at[at + 2 * size <= self.stop[at]]
            at = at[own[at + size] >= 0]
            place, name = _grouped(own[at].astype(np.int64) * n + own[at + size], at)

    def _take(self, place: np.ndarray, name: np.ndarray, n: int) -> None:
        """Keep the names of one power and what its successors propose."""
        size = 1 << len(self.names)
        names = np.full(n, -1, np.int32 if n < 1 << 31 else np.int64)
        names[place] = name
        self.names.append(names)
        step = np.where(name[1:] == name[:-1], place[1:] - place[:-1], 0)
        some = np.flatnonzero((step[:-1] > 0) & (step[:-1] <= 2 * size) & (step[:-1] == step[1:]))
        at, period = place[some], step[some]
        period_at = np.zeros(n + 1, np.int64)
        period_at[at] = period
        begins = period_at[at - 1] != period  # neighbours with one distance propose one run; place -1 holds no period
        self.proposed.append((at[begins], period[begins]))

    def _shared(self, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
        """Words equal from ``a`` and ``b`` on (``step`` 1) or before them (``step`` -1); ``a < b``, one document."""
        length = np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.names))):
            names, size = self.names[k], 1 << k
            if step > 0:
                x, y = a + length, b + length
                fits = y + size <= self.stop[a]
            else:
                x, y = a - length - size, b - length - size
                fits = x >= self.first[a]
            x, y = np.where(fits, x, 0), np.where(fits, y, 0)
            fits &= (names[x] == names[y]) & (names[x] >= 0)
            length += size * fits
        return length

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(start, length, period)`` of every run by start, then period; starts count over all documents."""
        if not self.proposed:
            return (np.zeros(0, np.int64),) * 3
        at, period = (np.concatenate([p[i] for p in self.proposed]) for i in (0, 1))
        start = at - self._shared(at, at + period, -1)
        length = at + period + self._shared(at, at + period, 1) - start
        enough = length >= np.maximum(MIN_WORDS, MIN_EXPONENT * period)
        start, length, period = start[enough], length[enough], period[enough]
        _, once = np.unique(start * (len(self.stop) + 1) + period, return_index=True)
        return start[once], length[once], period[once]


def _kept_text(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray, kept: np.ndarray, n: int) -> pa.Array:
    """The kept words of each of ``n`` documents, joined by one space."""
    a, b, of = starts[kept], ends[kept], doc[kept]
    # Every kept word brings the one byte behind it, as its space; a document's last one is cut off.
    text = np.append(data, np.uint8(0x20))
    text[b] = 0x20
    edge = np.zeros(len(text) + 1, np.int8)
    edge[a] += 1
    edge[b + 1] -= 1
    text = text[np.cumsum(edge[:-1], dtype=np.int8).astype(bool)]
    size = np.bincount(of, b - a + 1, n).astype(np.int64)
    last = np.cumsum(size)[size > 0] - 1
    text = np.delete(text, last)
    offsets = np.concatenate(([0], np.cumsum(np.maximum(size - 1, 0))))
    return pa.LargeStringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(text))


RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)``, one row per document.

    ``runs`` lists ``(start, length, period)`` in words by start, then period;
    ``collapsed`` holds the words, joined by one space, that no run contains
    behind its first period.  A null, empty or blank text has no words, no runs
    and an empty ``collapsed``.  Repeated rows and ids, null ids too, come back
    as they are; overlapping runs are all listed; a very long text is handled
    whole; an empty table gives an empty one; other columns are ignored.
    """
    hasher = WordHash()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            data, offsets = flat(batch.column(1))
            n = batch.num_rows
            starts, ends = word_spans(data)
            doc = np.searchsorted(offsets, starts, "right") - 1
            words = np.bincount(doc, minlength=n).astype(np.int64)
            first_word = np.cumsum(words) - words
            start, length, period = Factors(hasher(data, starts, ends), hasher(data, starts, ends, 1), doc).runs()
            edge = np.zeros(len(starts) + 1, np.int64)
            np.add.at(edge, start + period, 1)
            np.add.at(edge, start + length, -1)
            kept = np.cumsum(edge[:-1]) == 0
            of = doc[start]
            values = pa.StructArray.from_arrays([pa.array(start - first_word[of]), pa.array(length), pa.array(period)], names=["start", "length", "period"])
            at = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=n)))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words), pa.ListArray.from_arrays(pa.array(at), values),
                 _kept_text(data, starts, ends, doc, kept, n).cast(pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    return docs.select(F.col("doc_id").cast("long"), led_text(F.col("text")).alias("text")).mapInArrow(run, RUNS)


def made_periodic(doc_id: Column, text: Column) -> Column:
    """The contract's input: in every tenth document by id hash the words from one on repeat with one period."""
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        tail = F.flatten(F.array_repeat(F.slice(w, a + 1, p), F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.slice(F.concat(F.slice(w, F.lit(1), a), tail), F.lit(1), n), " ")

    words = F.filter(F.split(text, BLANK), lambda w: w != "")
    # The one-row array names the words, so that they are split once.
    return F.when(h % 10 == 0, F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)))[0]).otherwise(text)


def q_periods(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.col("text").cast("string").alias("text"))
    found = periodic_runs(docs.select("doc_id", made_periodic(F.col("doc_id"), F.col("text")).alias("text")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.s")).alias("start"),
        F.col("longest.l").alias("length"),
        (-F.col("longest.p")).alias("period"),
        F.floor(1000 * F.col("longest.l") / -F.col("longest.p")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )
