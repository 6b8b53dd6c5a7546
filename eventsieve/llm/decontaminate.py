"""Benchmark passages in documents: CGK embedding, bit sampling, exact edit check.

Texts are sequences of lower-case words.  A document contains an item when
some window is within ``(1 - similarity)`` of the item's words in edits.

Method.  The CGK walk (Chakraborty, Goldenberg, Koucky, STOC 2016) copies the
current word at every step and moves on where a random bit of (step, word)
says so; sequences at a small edit distance come out at a small Hamming
distance.  One repetition samples ``SAMPLES`` steps of a walk as a bucket key;
``KEYS_A_WALK`` of them are read off one walk, which is the dear part.  Hits of a walk grow rarer with length, so an item of more than
``PIECE_WORDS`` words is cut into about equal pieces: the pieces' shares of
the edits, each rounded down and plus one, sum to more than the edits allowed,
so at least one piece keeps within its own share and is looked for like an
item of its size.  Items and pieces are grouped by size.  A window is embedded
only if it begins on a word of the items and could match at all: each edit
takes away at most one of its first words, so enough of them must be words of
the items.  As many repetitions are drawn as trial copies with the most edits
allowed need to be met at ``TRIAL_RECALL``, at the starts that are embedded:
copies edited at random, with words of the items and with words of no item, and
copies whose first, middle or last word is replaced by a word of no item, each
kind for itself.  A group that does not reach it is an error.  Windows that
share a bucket with an item and hold enough of its words are verified by their
exact edit distance, the words around a met piece by that of the whole item.

The benchmark is a stated query set: it is taken in blocks of bounded size,
each checked against all documents; documents are neither shuffled nor
joined.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventsieve.llm.texts import WordHash, flat, led_text, pieces

SIMILARITY = 0.8
SAMPLES = 3
KEYS_A_WALK = 8
TARGET_RECALL = 0.97
TRIAL_RECALL = 0.98  # measured on TRIAL_COPIES copies of each kind, so that the target holds beyond them
MAX_WALKS = 256
TRIAL_COPIES = 500
PIECE_WORDS = 100
SIZE_RATIO = 1.2
BLOCK_ITEMS = 20_000
BLOCK_BYTES = 32 << 20

# Bytes that make words: ASCII letters and digits and all bytes of other scripts.
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(128, 256)]] = True


def lowered(text: Column) -> Column:
    return led_text(F.lower(text.cast("string")))


def _spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    turns = np.diff(WORD_BYTE[data].view(np.int8), prepend=0, append=0)
    return np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)


def edits_allowed(n_words, similarity: float = SIMILARITY):
    return np.floor(np.asarray(n_words) * (1 - similarity) + 1e-9).astype(np.int64)


def _scores(item: list, text: list, anchored: bool) -> Iterator[int]:
    """Edits between ``item`` and the text up to each word (bit-parallel), from its first word or else from any."""
    masks: dict = defaultdict(int)
    for i, w in enumerate(item):
        masks[w] |= 1 << i
    n = len(item)
    full, top = (1 << n) - 1, 1 << (n - 1)
    pv, mv, score = full, 0, n
    for w in text:
        eq = masks.get(w, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | (~(xh | pv) & full), pv & xh
        score += bool(ph & top) - bool(mh & top)
        ph, mh = ((ph << 1) | anchored) & full, (mh << 1) & full
        pv, mv = mh | (~(xv | ph) & full), ph & xv
        yield score


def best_prefix(item: list, text: list) -> tuple[int, int]:
    """``(edits, words)`` of the prefix of ``text`` nearest to ``item``."""
    best, at = len(item), 0
    for j, score in enumerate(_scores(item, text, True)):
        if score < best:
            best, at = score, j + 1
    return best, at


def best_window(item: list, text: list) -> tuple[int, int, int]:
    """``(edits, first, end)`` of the words of ``text`` nearest to ``item``; of several the first, then the shortest."""
    best, first = len(item), len(text)
    for j, score in enumerate(_scores(item[::-1], text[::-1], False)):
        if score <= best:
            best, first = score, len(text) - 1 - j
    edits, words = best_prefix(item, text[first : first + len(item) + best])
    return edits, first, first + words


def cut(n_words: int) -> list[tuple[int, int]]:
    """``(first, end)`` of the pieces an item is looked for by; short items are one piece."""
    n = -(-n_words // PIECE_WORDS)
    return [(n_words * i // n, n_words * (i + 1) // n) for i in range(n)]


@dataclass
class Walk:
    turns: np.ndarray  # odd multiplier of every step
    samples: list[list[int]]  # the steps of every key

    def keys(self, words: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> list[np.ndarray]:
        """Bucket keys of the windows ``words[start:stop]``, one array for each sample; behind a window the walk sees the end mark 0."""
        at = starts.copy()
        wanted = {step for sample in self.samples for step in sample}
        seen_at = {}
        for step in range(max(wanted) + 1):
            seen = np.where(at < stops, words[np.minimum(at, stops)], np.uint64(0))
            if step in wanted:
                seen_at[step] = seen
            at += (seen * self.turns[step] >> np.uint64(63)).astype(np.int64)
        out = []
        for sample in self.samples:
            key = np.zeros(len(starts), np.uint64)
            for step in sample:
                key = (key ^ seen_at[step]) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(29)
            out.append(key)
        return out


def _walk(rng: np.random.Generator, length: int) -> Walk:
    samples = [sorted(rng.choice(length, min(SAMPLES, length), replace=False).tolist()) for _ in range(KEYS_A_WALK)]
    return Walk(rng.integers(0, 1 << 63, length, dtype=np.uint64) * np.uint64(2) + np.uint64(1), samples)


class Buckets:
    """The keys of a class's items under one sample."""

    def __init__(self, keys: np.ndarray):
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.first_bits = np.zeros(1 << 16, bool)
        self.first_bits[(self.keys >> np.uint64(48)).astype(np.int64)] = True

    def hits(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(place among own, item)`` of equal keys."""
        some = np.flatnonzero(self.first_bits[(own >> np.uint64(48)).astype(np.int64)])
        lo, hi = np.searchsorted(self.keys, own[some], "left"), np.searchsorted(self.keys, own[some], "right")
        n = hi - lo
        ends = np.cumsum(n)
        return np.repeat(some, n), self.order[np.repeat(lo - (ends - n), n) + np.arange(int(n.sum()))]


def _laid_out(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequences one after the other, an end mark (0) behind each."""
    lengths = np.array([len(s) for s in sequences], np.int64)
    words = np.concatenate([np.append(s, np.uint64(0)) for s in sequences])
    stops = np.cumsum(lengths + 1) - 1
    return words, stops - lengths, stops


def _outside(rng: np.random.Generator, n: int) -> np.ndarray:
    """Words of no item."""
    return rng.integers(1 << 62, 1 << 63, n, dtype=np.uint64) | np.uint64(1)


def _edited(rng: np.random.Generator, item: np.ndarray, edits: int, pool: np.ndarray, kind: int) -> np.ndarray:
    """A copy with ``edits`` edits; kinds 1, 2, 3 replace the first, the middle, the last word by one of no item."""

    def other() -> int:
        return int(rng.choice(pool)) if rng.integers(2) else int(_outside(rng, 1)[0])

    out = item.tolist()
    for i in range(edits):
        if i == 0 and kind:
            out[(0, 0, len(out) // 2, len(out) - 1)[kind]] = int(_outside(rng, 1)[0])
            continue
        what, at = rng.integers(3), int(rng.integers(len(out))) if out else 0
        if what == 0 and out:
            out[at] = other()
        elif what == 1:
            out.insert(at, other())
        elif out:
            del out[at]
    return np.array(out, np.uint64)


KINDS = 4


class SizeClass:
    """Items and pieces ``(place, first word, words)`` of about one size, their word table and their buckets."""

    def __init__(self, items: list[tuple[int, int, np.ndarray]], rng: np.random.Generator, similarity: float):
        self.items = items
        sizes = np.array([len(w) for _, _, w in items])
        self.window = int(sizes.min())
        self.needed = self.window - int(edits_allowed(sizes.max(), similarity))
        self.allowed = edits_allowed(sizes, similarity)
        self.words = [w.tolist() for _, _, w in items]
        pool = np.concatenate([w for _, _, w in items])
        # A table of 16 slots a word: a slot taken by another word only lets a window through to the check.
        self.low_bits = np.uint64((1 << max(10, (16 * len(pool)).bit_length())) - 1)
        self.member = np.zeros(int(self.low_bits) + 1, bool)
        self.member[pool & self.low_bits] = True
        words, starts, _ = _laid_out([w for _, _, w in items])
        # Trial copies with the most edits allowed, words of no item before them, any words behind.
        origin, kind = np.tile(np.resize(rng.permutation(len(items)), TRIAL_COPIES), KINDS), np.repeat(np.arange(KINDS), TRIAL_COPIES)
        copies = []
        for i, k in zip(origin.tolist(), kind.tolist(), strict=True):
            behind = np.where(rng.integers(0, 2, self.window) == 0, rng.choice(pool, self.window), _outside(rng, self.window))
            copies.append(np.concatenate([_outside(rng, 2), _edited(rng, items[i][2], int(self.allowed[i]), pool, k), behind]))
        c_words, _, c_stops = _laid_out(copies)
        own, stops = self._starts(c_words, np.repeat(c_stops, np.diff(c_stops, prepend=-1)))
        copy = np.searchsorted(c_stops, own)
        met = np.zeros(len(copies), bool)
        self.walks, self.buckets, self.recall = [], [], 0.0
        # Twice as many walk steps as words visit about the whole window of the smallest item's size.
        while self.recall < TRIAL_RECALL and len(self.walks) < MAX_WALKS:
            walk = _walk(rng, 2 * self.window)
            keys, trial = walk.keys(words, starts, starts + self.window), walk.keys(c_words, own, stops)
            for n, (of_items, of_copies) in enumerate(zip(keys, trial, strict=True), 1):
                met[copy[of_copies == of_items[origin[copy]]]] = True
                self.recall = min(float(met[kind == k].mean()) for k in range(KINDS))
                if self.recall >= TRIAL_RECALL:
                    break
            walk.samples = walk.samples[:n]
            self.walks.append(walk)
            self.buckets.append([Buckets(k) for k in keys[:n]])
        if self.recall < TRIAL_RECALL:
            raise RuntimeError(f"items of {self.window} to {sizes.max()} words are met at {self.recall:.3f} only, below {TRIAL_RECALL}")

    def _starts(self, words: np.ndarray, stop_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the windows that are embedded."""
        own = self.member[words & self.low_bits] & (words != 0)
        sums = np.concatenate(([0], np.cumsum(own, dtype=np.int64)))
        starts = np.flatnonzero(own)
        stops = np.minimum(starts + self.window, stop_of[starts])
        enough = sums[stops] - sums[starts] >= self.needed
        return starts[enough], stops[enough]

    def candidates(self, words: np.ndarray, stop_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(start, item)`` pairs that share a bucket, each once."""
        starts, stops = self._starts(words, stop_of)
        found = [np.zeros(0, np.int64)]
        for lo in range(0, len(starts), 1 << 15):
            own, ends = starts[lo : lo + (1 << 15)], stops[lo : lo + (1 << 15)]
            for walk, buckets in zip(self.walks, self.buckets, strict=True):
                for keys, bucket in zip(walk.keys(words, own, ends), buckets, strict=True):
                    place, item = bucket.hits(keys)
                    found.append(own[place] * len(self.items) + item)
        pairs = np.unique(np.concatenate(found))
        return self._may_match(words, stop_of, pairs // len(self.items), pairs % len(self.items))

    def _may_match(self, words: np.ndarray, stop_of: np.ndarray, starts: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs whose stretch holds as many of the item's words as the edits allowed leave it.

        Windows begin within the edits allowed of the match, so the words of a match all lie in that stretch.
        """
        keep = np.zeros(len(starts), bool)
        order = np.argsort(items, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(items[order])) + 1):
            if not len(own):
                continue
            item = self.items[items[own[0]]][2]
            allowed = int(self.allowed[items[own[0]]])
            sorted_words, reach = np.unique(item), np.arange(len(item) + allowed)
            for lo in range(0, len(own), 1 + (1 << 20) // len(reach)):
                some = own[lo : lo + 1 + (1 << 20) // len(reach)]
                at = starts[some][:, None] + reach
                seen = words[np.minimum(at, len(words) - 1)]
                place = np.minimum(np.searchsorted(sorted_words, seen), len(sorted_words) - 1)
                keep[some] = ((sorted_words[place] == seen) & (at < stop_of[starts[some]][:, None])).sum(1) >= len(item) - allowed
        return starts[keep], items[keep]

    def holds(self, item: int, text: np.ndarray) -> bool:
        """The same by the item's places: repeats of a word in the text count once for each place that wants it."""
        held = set(text.tolist())
        return sum(w in held for w in self.words[item]) >= len(self.words[item]) - int(self.allowed[item])


class Index:
    """The buckets of one block of benchmark items."""

    def __init__(self, items: list[tuple[int, str]], similarity: float = SIMILARITY, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.hash, self.similarity = WordHash(), similarity
        by_size: dict[int, list] = defaultdict(list)
        self.text: dict[int, list[bytes]] = {}
        for place, (_, text) in enumerate(items):
            data = np.frombuffer(("\n" + (text or "")).encode("utf-8", "surrogatepass"), np.uint8)
            starts, ends = _spans(data)
            if len(starts):
                ids = self.hash(data, starts, ends) | np.uint64(1)
                for a, b in cut(len(ids)):
                    by_size[int(np.log(b - a) / np.log(SIZE_RATIO))].append((place, a, ids[a:b]))
                self.text[place] = [data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
        self.ids = [i for i, _ in items]
        self.classes = [SizeClass(own, rng, similarity) for _, own in sorted(by_size.items())]

    def hits(self, column: pa.Array) -> list[tuple[int, int, int, int, int]]:
        """``(row, item place, edits, first byte, end byte)`` of the best window of each item in each row."""
        data, offsets = flat(column)
        starts, ends = _spans(data)
        if not len(starts):
            return []
        doc = np.searchsorted(offsets, starts, "right") - 1
        words = np.zeros(len(starts) + len(column), np.uint64)
        slot = np.arange(len(starts)) + doc
        words[slot] = self.hash(data, starts, ends) | np.uint64(1)
        counts = np.bincount(doc, minlength=len(column))
        stops = np.cumsum(counts + 1) - 1
        stop_of = np.repeat(stops, counts + 1)
        word_of = np.cumsum(words != 0) - 1  # slot -> word number
        ends_at = np.cumsum(counts)  # document -> word number behind its last
        best: dict[tuple[int, int], tuple[int, int, int]] = {}

        def meet(row: int, place: int, low: int, high: int, anchored: bool) -> None:
            item = self.text[place]
            text = [data[a:b].tobytes() for a, b in zip(starts[low:high], ends[low:high], strict=True)]
            if anchored:
                (edits, end), first = best_prefix(item, text), 0
            else:
                edits, first, end = best_window(item, text)
            if edits > int(edits_allowed(len(item), self.similarity)) or first == end:
                return
            found = (edits, int(starts[low + first] - offsets[row] - 1), int(ends[low + end - 1] - offsets[row] - 1))
            if found < best.get((row, place), (1 << 60, 0, 0)):
                best[row, place] = found

        around: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        for group in self.classes:
            for start, k in zip(*(x.tolist() for x in group.candidates(words, stop_of)), strict=True):
                place, offset, ids = group.items[k]
                if not group.holds(k, words[start : min(stop_of[start], start + len(ids) + int(group.allowed[k]))]):
                    continue
                n = len(self.text[place])
                allowed = int(edits_allowed(n, self.similarity))
                w, row = int(word_of[start]), int(doc[word_of[start]])
                if len(ids) == n:
                    meet(row, place, w, min(int(ends_at[row]), w + n + allowed), True)
                else:  # the whole item begins up to its edits before or behind where the piece says
                    low = w - offset - allowed
                    around[row, place].append((max(int(ends_at[row] - counts[row]), low), min(int(ends_at[row]), low + n + 3 * allowed)))
        for (row, place), stretches in around.items():
            low, high = min(stretches)
            for a, b in sorted(stretches):
                if a > high:
                    meet(row, place, low, high, False)
                    low = a
                high = max(high, b)
            meet(row, place, low, high, False)
        return [(row, place, *f) for (row, place), f in best.items()]


def item_blocks(benchmark: DataFrame, similarity: float = SIMILARITY) -> Iterator[Index]:
    """Indexes of the benchmark's items, a block of bounded size at a time."""
    block: list[tuple[int, str]] = []
    size = 0
    for r in benchmark.select(F.col("item_id").cast("long").alias("i"), F.lower(F.col("text").cast("string")).alias("t")).toLocalIterator():
        if block and (len(block) == BLOCK_ITEMS or size + len(r["t"] or "") > BLOCK_BYTES):
            yield Index(block, similarity)
            block, size = [], 0
        block.append((r["i"], r["t"]))
        size += len(r["t"] or "")
    if block:
        yield Index(block, similarity)


HITS = "doc_id long, item_id long, n_words long, edits long, similarity double, start long, end long"


def find_contamination(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document and item it contains: ``(doc_id, item_id, n_words, edits, similarity, start, end)``.

    The best window (fewest edits, then first) is given, in bytes of the
    lower-cased text.  Null and empty texts and items without words match
    nothing; items under five words match exactly; equal items each get
    their row; repeated documents give repeated rows; a very long text is
    searched whole; either table empty gives an empty one; other columns are
    ignored.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), lowered(F.col("text")))
    out = spark.createDataFrame([], HITS)
    for index in item_blocks(benchmark, similarity):

        def run(batches: Iterator[pa.RecordBatch], own=index) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches, 1):
                hits = own.hits(batch.column(1))
                ids = batch.column(0).to_pylist()
                rows = [(ids[r], own.ids[p], len(own.text[p]), e, 1 - e / len(own.text[p]), a, b) for r, p, e, a, b in sorted(hits)]
                if rows:
                    names = [f.split()[0] for f in HITS.split(", ")]
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=pa.schema(
                        [(n, pa.float64() if n == "similarity" else pa.int64()) for n in names]))

        out = out.unionByName(texts.mapInArrow(run, HITS))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, columns unchanged, that hold no item of the benchmark.

    Null and empty texts hold none; repeated rows are judged alike, repeated or
    null ids change nothing; a very long text is searched whole; an empty
    benchmark drops nothing, an empty table gives an empty one; columns of any
    name come through.
    """
    schema, last = docs.schema, len(docs.columns)
    for index in item_blocks(benchmark, similarity):

        def run(batches: Iterator[pa.RecordBatch], own=index) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches, last):
                keep = np.ones(batch.num_rows, bool)
                keep[[h[0] for h in own.hits(batch.column(last))]] = False
                yield batch.filter(pa.array(keep)).select(range(last))

        docs = docs.withColumn("__lowered_text", lowered(F.col("text"))).mapInArrow(run, schema)
    return docs


def q_decontamination(spark, sf_dir: str) -> DataFrame:
    return find_contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
