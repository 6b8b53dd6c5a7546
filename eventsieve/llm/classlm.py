"""Class-based n-gram scoring: exchange clustering of words into classes.

The model is Brown's class bigram: ``P(w | before) = P(class(w) | class(before))
* P(w | class(w))``.  Exchange clustering moves words to the class where the
likelihood of the training text grows most.  It starts on the driver with a
bounded set of units, moved one at a time until none moves: the end mark, the
most frequent training words, and for all other words ``SPELLINGS`` groups of
words with equal last bytes.  Then every training word, frequent or rare, is
moved by its own neighbours, in rounds: the counts of (word, class beside it)
over all training text are summed by word, and tasks take each word's best
class.  All words but the frequent ones move in the first round, half of all
words in each later one, in turns, so that neighbours do not move at once.
Rounds end when one gains less than ``LEAST_GAIN`` a training token, or moves
no word; a round that loses is taken back.  The number of classes grows with
the cube root of the training vocabulary.  Words never trained on keep the
class of their spelling group.  Counts are over all training documents.

On Spark.  Texts are split into words once.  A block of texts is stored as the
numbers of its own words, with the list of these words; every later pass reads
the stored blocks, whatever the cluster's size by then.  Words are dealt to
shards by hash.  Blocks and shards exchange packed arrays, one row for a block
and shard: a block lists its words once, a shard answers with their classes (and
at the end their counts) in the order of the list, and gets the block's counts of
(word, class beside it) by the word's place in that list, summed over the
block.  A common word is one entry of each block's list like any other, so no
task holds more than its shard, whose size is bounded by the number of shards.
Only class bigrams, sums by class and the first units come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventsieve.llm.texts import LOWER, WordHash, flat, frequent_first, id_bucket, led_text, packed, pieces, unpacked, word_spans
from eventsieve.session import materialize, release

TOP_WORDS = 511
SPELLINGS = 512
CLASSES = 64  # at least
PRIOR = 5.0
LEAST_GAIN = 0.02  # nats a training token
BLOCK_BYTES = 16 << 20
SHARD_WORDS = 400_000  # about how many entries of the blocks' lists a shard holds
TASK_BITS = 32


class Tokens:
    """The tokens of a column of led texts: every text's words, then its end mark (hash 0)."""

    def __init__(self, hasher: WordHash, column: pa.Array, both: bool):
        raw, offsets = flat(column)
        data = LOWER[raw]
        starts, ends = word_spans(data)
        doc = np.searchsorted(offsets, starts, "right") - 1
        n = len(column)
        slot = np.arange(len(starts)) + doc
        self.doc = np.repeat(np.arange(n), np.bincount(doc, minlength=n) + 1)
        self.is_end = np.ones(len(self.doc), bool)
        self.is_end[slot] = False
        self.h1 = np.zeros(len(self.doc), np.uint64)
        self.h1[slot] = hasher(data, starts, ends)
        if both:
            self.h2 = np.zeros(len(self.doc), np.uint64)
            self.h2[slot] = hasher(data, starts, ends, 1)
        tail = np.zeros(len(starts), np.uint64)
        for k in (1, 2, 3):  # the last three bytes, fewer in shorter words
            tail = tail * np.uint64(257) + np.where(ends - k >= starts, data[ends - k], 0).astype(np.uint64)
        self.spelling = np.zeros(len(self.doc), np.int64)
        self.spelling[slot] = ((tail * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % SPELLINGS


def _binary(columns: list[bytes | None]) -> list[pa.Array]:
    return [pa.array([c], pa.binary()) for c in columns]


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


# A block: its documents, their tokens as numbers of its own words, and these words (hashes, spelling group, training tokens).
BLOCK = "block long, doc_id array<long>, train array<boolean>, sizes binary, tokens binary, n_words long, h1 binary, h2 binary, spelling binary, n binary"


def store_blocks(docs: DataFrame, train: object) -> DataFrame:
    """``BLOCK`` rows of all documents, stored; ``train`` marks the rows to learn from."""

    def block(number: int, batch: pa.RecordBatch, hasher: WordHash) -> pa.RecordBatch:
        numbers, keys, sizes, done = [], [], [], 0
        for piece in pieces(iter([batch]), 2):
            t = Tokens(hasher, piece.column(2), True)
            h1, first, back = np.unique(t.h1, return_index=True, return_inverse=True)
            numbers.append((back + done).astype(np.int32))
            keys.append((h1, t.h2[first], t.spelling[first]))
            sizes.append(np.bincount(t.doc, minlength=piece.num_rows))
            done += len(h1)
        h1, h2, spelling = (np.concatenate([k[i] for k in keys]) for i in range(3))
        h1, first, back = np.unique(h1, return_index=True, return_inverse=True)
        tokens, sizes = back[np.concatenate(numbers)], np.concatenate(sizes)
        order, _, tokens = frequent_first(np.arange(len(h1)), np.bincount(tokens, minlength=len(h1)), tokens)
        learned = np.repeat(batch.column(1).to_numpy(zero_copy_only=False), sizes)
        values = [packed(sizes), packed(tokens), h1[order].tobytes(), h2[first][order].tobytes(), packed(spelling[first][order]),
                  packed(np.bincount(tokens[learned], minlength=len(h1)))]
        lists = [pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column(i)) for i in (0, 1)]
        made = _binary(values)
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *lists, *made[:2], pa.array([len(h1)], pa.int64()), *made[2:]], names=_names(BLOCK))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, number = WordHash(), TaskContext.get().partitionId() << TASK_BITS
        for batch in pieces(batches, 2, BLOCK_BYTES):
            yield block(number, batch, hasher)
            number += 1

    taken = docs.select(F.col("doc_id").cast("long").alias("doc_id"), train.alias("train"), led_text(F.col("text")).alias("text"))
    return materialize(taken.mapInArrow(run, BLOCK))


def _u64(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u8")


# A shard's own row (no block): hashes, spelling groups and counts of its words.  A block's list: which of the block's words
# (``at``) and their places among the shard's.
LISTS = "shard int, block long, at binary, place binary, h1 binary, spelling binary, c binary"


def shard_words(blocks: DataFrame) -> DataFrame:
    """``LISTS``: every shard's distinct words with their training counts, and every block's list of them; stored."""
    listed = blocks.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    shards = max(2, -(-listed // SHARD_WORDS))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, *arrays in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                h1, h2, spelling, n = _u64(arrays[0]), _u64(arrays[1]), unpacked(arrays[2]), unpacked(arrays[3])
                shard = ((h1 >> np.uint64(20)) % np.uint64(shards)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                for own in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
                    if len(own):
                        values = _binary([packed(own), h1[own].tobytes(), h2[own].tobytes(), packed(spelling[own]), packed(n[own])])
                        yield pa.RecordBatch.from_arrays([pa.array([shard[own[0]]], pa.int32()), pa.array([block], pa.int64()), *values], names=["shard", "block", "at", "h1", "h2", "spelling", "n"])

    def count(rows: pa.Table) -> pa.Table:
        shard, block = rows.column("shard")[0].as_py(), rows.column("block").to_pylist()
        lists = {c: rows.column(c).to_pylist() for c in ("at", "h1", "h2", "spelling", "n")}
        h1, h2 = (np.concatenate([_u64(x) for x in lists[c]]) for c in ("h1", "h2"))
        spelling, n = (np.concatenate([unpacked(x) for x in lists[c]]) for c in ("spelling", "n"))
        order = np.lexsort((h2, h1))
        fresh = np.concatenate(([True], (np.diff(h1[order]) != 0) | (np.diff(h2[order]) != 0)))
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(fresh) - 1
        first = order[fresh]
        sizes = np.array([len(x) // 8 for x in lists["h1"]])
        places = [packed(p) for p in np.split(place, np.cumsum(sizes)[:-1])]
        c = np.bincount(place, n, len(first)).astype(np.int64)
        m = len(block)
        return pa.table({
            "shard": pa.array([shard] * (m + 1), pa.int32()), "block": pa.array([None, *block], pa.int64()), "at": pa.array([None, *lists["at"]], pa.binary()),
            "place": pa.array([None, *places], pa.binary()), "h1": pa.array([h1[first].tobytes(), *[None] * m], pa.binary()),
            "spelling": pa.array([packed(spelling[first]), *[None] * m], pa.binary()), "c": pa.array([packed64(c), *[None] * m], pa.binary()),
        })

    dealt = blocks.select("block", "h1", "h2", "spelling", "n").mapInArrow(deal, "shard int, block long, at binary, h1 binary, h2 binary, spelling binary, n binary")
    return materialize(dealt.groupBy("shard").applyInArrow(count, LISTS))


def packed64(values: np.ndarray) -> bytes:
    """Counts that may pass 32 bits: low halves, then high halves."""
    low = packed(values & 0xFFFFFFFF)
    return len(low).to_bytes(8, "little") + low + packed(values >> 32)


def unpacked64(data: bytes) -> np.ndarray:
    low = int.from_bytes(data[:8], "little")
    return unpacked(data[8 : 8 + low]).astype(np.int64) | unpacked(data[8 + low :]).astype(np.int64) << 32


def units(h1: np.ndarray, spelling: np.ndarray, top: np.ndarray) -> np.ndarray:
    """Units of words: 0 the end mark, then the frequent words (``top``: their hashes, ascending), then spelling groups."""
    unit = 1 + len(top) + spelling.astype(np.int64)
    if len(top):
        at = np.minimum(np.searchsorted(top, h1), len(top) - 1)
        unit = np.where(top[at] == h1, 1 + at, unit)
    return np.where(h1 == 0, 0, unit)


def unit_bigrams(blocks: DataFrame, top: np.ndarray) -> np.ndarray:
    """Counts of neighbouring units over all training texts; a text starts behind an end mark."""
    size = 1 + len(top) + SPELLINGS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                unit = units(_u64(row["h1"]), unpacked(row["spelling"]), top)[unpacked(row["tokens"])]
                learned = np.repeat(np.array(row["train"], bool), unpacked(row["sizes"]))
                total += np.bincount((np.concatenate(([0], unit[:-1])) * size + unit)[learned], minlength=size * size)
        cell = np.flatnonzero(total)
        for lo in range(0, len(cell), 1 << 16):
            own = cell[lo : lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total[own])], names=["cell", "n"])

    # At most size**2 rows come back.
    taken = blocks.select("train", "sizes", "tokens", "h1", "spelling")
    cells = taken.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size * size)
    out[cells["cell"].to_numpy(np.int64)] = cells["n"].to_numpy(float)
    return out.reshape(size, size)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(bigrams: np.ndarray, classes: int = CLASSES, sweeps: int | None = None) -> np.ndarray:
    """Class of every unit; the end mark (unit 0) keeps class 0 to itself.

    Every unit in turn leaves its class and joins the one with the largest
    likelihood of the class bigrams, until a sweep moves none (or after ``sweeps``).
    """
    n = len(bigrams)
    weight = bigrams.sum(0) + bigrams.sum(1)
    order = np.argsort(-weight, kind="stable")
    order = order[order != 0]
    of = np.zeros(n, np.int64)
    of[order] = 1 + np.arange(n - 1) % (classes - 1)
    member = np.eye(classes)[of]
    table = member.T @ bigrams @ member
    least = 1e-10 * max(10.0, bigrams.sum())  # above the rounding of sums of this size, so that sweeps come to an end
    while sweeps is None or sweeps > 0:
        moved, sweeps = 0, sweeps and sweeps - 1
        for u in order:
            if not weight[u]:
                break
            old, own = of[u], bigrams[u, u]
            out, into = bigrams[u] @ member, bigrams[:, u] @ member
            out[old] -= own
            into[old] -= own
            table[old] -= out
            table[:, old] -= into
            table[old, old] -= own
            after_row, after_col = table + out[None, :], table.T + into[None, :]
            gain = (_xlogx(after_row) - _xlogx(table)).sum(1) + (_xlogx(after_col) - _xlogx(table.T)).sum(1)
            diag = np.diagonal(table)
            gain += _xlogx(diag + out + into + own) - _xlogx(diag + out) - _xlogx(diag + into) + _xlogx(diag)
            rows, cols = table.sum(1) + into, table.sum(0) + out  # the others' totals hold the unit whichever class it joins
            gain -= _xlogx(rows + out.sum() + own) - _xlogx(rows) + _xlogx(cols + into.sum() + own) - _xlogx(cols)
            gain[0] = -np.inf
            new = int(np.argmax(gain))
            if gain[new] <= gain[old] + least:
                new = old
            table[new] += out
            table[:, new] += into
            table[new, new] += own
            if new != old:
                of[u], moved = new, moved + 1
                member[u, old], member[u, new] = 0, 1
        if not moved:
            break
    return of


@dataclass
class Model:
    top: np.ndarray  # hashes of the frequent words, ascending
    of: np.ndarray  # unit -> class
    table: np.ndarray  # class bigrams
    class_tokens: np.ndarray
    class_words: np.ndarray

    def __post_init__(self):
        total, classes = self.class_tokens.sum(), len(self.table)
        share = (self.class_tokens + 1) / (total + classes)
        # log10 P(class | class before), and log10 of a class' tokens and words and one
        self.step = np.log10((self.table + PRIOR * share[None, :]) / (self.table.sum(1, keepdims=True) + PRIOR))
        self.emission = np.log10(self.class_tokens + self.class_words + 1)
        self.tokens, self.words = int(total), int(self.class_words.sum())


def likelihood(table: np.ndarray) -> float:
    return float(_xlogx(table).sum() - _xlogx(table.sum(0)).sum() - _xlogx(table.sum(1)).sum())


def fit(blocks: DataFrame, lists: DataFrame) -> Model:
    """Cluster the first units and count."""
    own = lists.filter("block is null").select("h1", "spelling", "c")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, words = np.zeros(SPELLINGS + 1, np.int64), np.zeros(SPELLINGS + 1, np.int64)  # the end mark last
        for batch in batches:
            for h1, spelling, c in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                h1, c = _u64(h1), unpacked64(c)
                group = np.where(h1 == 0, SPELLINGS, unpacked(spelling).astype(np.int64))
                np.add.at(tokens, group, c)
                np.add.at(words, group, c > 0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(SPELLINGS + 1)), pa.array(tokens), pa.array(words)], names=["s", "tokens", "words"])

    groups = {r["s"]: r for r in own.mapInArrow(sums, "s long, tokens long, words long").groupBy("s").agg(F.sum("tokens").alias("tokens"), F.sum("words").alias("words")).collect()}
    ends = groups[SPELLINGS]["tokens"] if groups else 0
    classes = max(CLASSES, int(np.ceil(np.cbrt(sum(r["words"] for s, r in groups.items() if s < SPELLINGS)))))
    wanted = max(TOP_WORDS, classes)

    def most(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h1, spelling, c in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                h1, c, spelling = _u64(h1), unpacked64(c), unpacked(spelling).astype(np.int64)
                some = np.lexsort((h1.view(np.int64), -c))[: wanted + 1]
                some = some[(c[some] > 0) & (h1[some] != 0)]
                yield pa.RecordBatch.from_arrays([pa.array(h1[some].view(np.int64)), pa.array(spelling[some]), pa.array(c[some])], names=["h1", "s", "c"])

    frequent = own.mapInArrow(most, "h1 long, s long, c long").orderBy(F.desc("c"), "h1").limit(wanted).collect()
    hashes = np.array([r["h1"] for r in frequent], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    top = hashes[order]
    spelled = 1 + len(top)
    tokens, words = np.zeros(spelled + SPELLINGS), np.zeros(spelled + SPELLINGS)
    tokens[0], words[0] = ends, float(ends > 0)
    for s, r in groups.items():
        if s < SPELLINGS:
            tokens[spelled + s], words[spelled + s] = r["tokens"], r["words"]
    for place, i in enumerate(order):
        r = frequent[i]
        tokens[1 + place], words[1 + place] = r["c"], 1
        tokens[spelled + r["s"]] -= r["c"]
        words[spelled + r["s"]] -= 1
    bigrams = unit_bigrams(blocks, top)
    of = exchange(bigrams, classes)
    member = np.eye(classes)[of]
    return Model(top, of, member.T @ bigrams @ member, member.T @ tokens, member.T @ words)


SMALL = 8
LEAST_MOVE = 0.01  # nats: a word moves for no less


class Gains:
    """What joining each class gives words by their cells, under fixed class bigrams ``table``.

    A cell is the class behind a word, or ``classes`` plus the class before it.
    """

    def __init__(self, table: np.ndarray):
        self.classes = len(table)
        self.margins = np.stack([table.sum(1), table.sum(0)])
        self.both = np.concatenate([table.T, table])  # cell -> counts beside it by the word's class
        # What k more add for small k: most words are rare, and their sums need no double precision.
        self.few = np.stack([self._grown(self.both, k) for k in range(SMALL + 1)]).astype(np.float32)
        self.few_margins = np.stack([[self._grown(m, k) for k in range(4 * SMALL)] for m in self.margins]).astype(np.float32)

    @staticmethod
    def _grown(counts: np.ndarray, by) -> np.ndarray:
        return _xlogx(counts + by) - _xlogx(counts)

    def _sums(self, word: np.ndarray, cell: np.ndarray, n: np.ndarray, words: int, totals: np.ndarray, small: bool) -> np.ndarray:
        gain = np.zeros((words, self.classes), np.float32 if small else np.float64)
        step = max(1, (1 << 22) // self.classes)
        for lo in range(0, len(word), step):
            w, at, by = word[lo : lo + step], cell[lo : lo + step], n[lo : lo + step]
            grown = self.few[by, at] if small else self._grown(self.both[at], by[:, None])
            first = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1])))
            gain[w[first]] += np.add.reduceat(grown, first, 0)
        for side in (0, 1):
            few = totals[side] < 4 * SMALL
            if small and few.all():
                gain -= self.few_margins[side][totals[side]]
            else:
                gain -= self._grown(self.margins[side][None], totals[side][:, None])
        return gain

    def best(self, word: np.ndarray, cell: np.ndarray, n: np.ndarray, old: np.ndarray) -> np.ndarray:
        """The class of every word (``old`` the present ones) that gives its cells, sorted by ``word``, the largest likelihood."""
        words = len(old)
        totals = np.stack([np.bincount(word, n * ((cell >= self.classes) == side), words).astype(np.int64) for side in (0, 1)])
        present = old[word]
        without = np.maximum(self.both[cell, present] - n, 0)  # the present class counts the word already
        stay = np.bincount(word, self._grown(without, n), words)
        for side in (0, 1):
            stay -= self._grown(np.maximum(self.margins[side][old] - totals[side], 0), totals[side])
        rare = np.ones(words, bool)
        rare[word[n > SMALL]] = False
        rare &= (totals < 4 * SMALL).all(0)
        new = old.copy()
        for small in (True, False):
            own = np.flatnonzero(rare == small)
            for lo in range(0, len(own), 1 << 16):
                some = own[lo : lo + (1 << 16)]
                number = np.full(words, -1, np.int64)
                number[some] = np.arange(len(some))
                rows = np.flatnonzero(number[word] >= 0)
                gain = self._sums(number[word[rows]], cell[rows], n[rows], len(some), totals[:, some], small)
                gain[:, 0] = -np.inf  # the end mark's own class
                gain[np.arange(len(some)), old[some]] = -np.inf
                best = gain.argmax(1)
                better = gain[np.arange(len(some)), best] > stay[some] + LEAST_MOVE
                new[some] = np.where(better, best, old[some])
        return new


# A shard's classes (no block), and what it answers to a block's list: the words' classes, at the end their counts too.
STATE = "shard int, block long, at binary, k binary, c binary, words binary, moved long"
# A block's counts for a shard: steps between places in its list, cell, times; and (shard -1) its class bigrams.
CELLS = "shard int, block long, step binary, cell binary, n binary"


def _answers(shard: int, lists: list[dict], k: np.ndarray, c: np.ndarray, classes: int, moved: int, counts: bool) -> pa.Table:
    """The shard's state and its answers."""
    words = np.bincount(k[c > 0], minlength=classes)
    places = [unpacked(r["place"]) for r in lists]
    return pa.table({
        "shard": pa.array([shard] * (len(lists) + 1), pa.int32()), "block": pa.array([None, *(r["block"] for r in lists)], pa.int64()),
        "at": pa.array([None, *(r["at"] for r in lists)], pa.binary()), "k": pa.array([packed(k), *(packed(k[p]) for p in places)], pa.binary()),
        "c": pa.array([None, *(packed64(c[p]) if counts else None for p in places)], pa.binary()),
        "words": pa.array([packed(words), *[None] * len(lists)], pa.binary()), "moved": pa.array([moved] * (len(lists) + 1), pa.int64()),
    })


def first_state(lists: DataFrame, model: Model) -> DataFrame:
    """Every word in the class of its unit, and the answers that say so; stored."""
    top, of, classes = model.top, model.of, len(model.table)

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.to_pylist()
        own = next(r for r in rows if r["block"] is None)
        k = of[units(_u64(own["h1"]), unpacked(own["spelling"]), top)]
        return _answers(own["shard"], [r for r in rows if r["block"] is not None], k, unpacked64(own["c"]), classes, 0, False)

    return materialize(lists.groupBy("shard").applyInArrow(run, STATE))


def count_cells(blocks: DataFrame, answers: DataFrame, classes: int, half: int | None) -> DataFrame:
    """``CELLS`` under the answers' classes, stored: what stands beside the words of all shards or of every second one."""

    def run(block: pa.Table, told: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        told = sorted(told.to_pylist(), key=lambda r: r["shard"])
        at = [unpacked(r["at"]) for r in told]
        # Words are numbered by shard and place in its list.
        number = np.empty(sum(map(len, at)), np.int64)
        number[np.concatenate(at)] = np.arange(len(number))
        of = np.concatenate([unpacked(r["k"]) for r in told]).astype(np.int64)
        wanted = np.repeat([half is None or r["shard"] % 2 == half for r in told], [len(a) for a in at])
        tokens, sizes = number[unpacked(row["tokens"])], unpacked(row["sizes"])
        learned = np.repeat(np.array(row["train"], bool), sizes)
        cls = of[tokens]
        before = np.concatenate(([0], cls[:-1]))  # an end mark stands before every text
        table = np.bincount((before * classes + cls)[learned], minlength=classes * classes)
        behind = np.append(cls[1:], 0)
        inner = learned & (cls > 0) & wanted[tokens]  # not the end mark, which stays
        keys = tokens[inner] * (2 * classes)
        keys = np.concatenate([keys + behind[inner], keys + classes + before[inner]])
        keys.sort()
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        times, keys = np.diff(first, append=len(keys)), keys[first]
        word, cell = keys // (2 * classes), keys % (2 * classes)
        ends = np.cumsum([len(a) for a in at])
        cuts = np.searchsorted(word, ends)
        out = [(-1, row["block"], b"", b"", packed(table))]
        for r, lo, hi, base in zip(told, [0, *cuts[:-1]], cuts, [0, *ends[:-1]], strict=True):
            if hi > lo:
                out.append((r["shard"], row["block"], packed(np.diff(word[lo:hi] - base, prepend=0)), packed(cell[lo:hi]), packed(times[lo:hi])))
        types = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=_names(CELLS))

    taken, told = blocks.select("block", "train", "sizes", "tokens"), answers.filter("block is not null").select("block", "shard", "at", "k")
    return materialize(taken.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(run, CELLS))


def class_bigrams(cells: DataFrame, classes: int) -> np.ndarray:
    """The blocks' class bigrams, summed by tasks and then here."""

    def run(rows: pa.Table) -> pa.Table:
        total = np.zeros(classes * classes, np.int64)
        for data in rows.column("n").to_pylist():
            total += unpacked(data)
        return pa.table({"t": pa.array([total.tobytes()], pa.binary())})

    own = cells.filter("shard = -1").select((F.pmod(F.xxhash64("block"), F.lit(16))).alias("g"), "n")
    parts = [np.frombuffer(r["t"], np.int64) for r in own.groupBy("g").applyInArrow(run, "t binary").collect()]  # 16 rows at most
    return sum(parts, np.zeros(classes * classes, np.int64)).astype(float).reshape(classes, classes)


def move_words(cells: DataFrame, lists: DataFrame, state: DataFrame, table: np.ndarray, top: np.ndarray, half: int | None) -> DataFrame:
    """State and answers of the moving shards, every word in its best class; the frequent words stay in the first round (``half`` None)."""
    classes = len(table)

    def run(counted: pa.Table, rows: pa.Table) -> pa.Table:
        rows = rows.to_pylist()
        own = next(r for r in rows if r["block"] is None and r["c"] is not None)
        k = unpacked(next(r["k"] for r in rows if r["k"] is not None)).astype(np.int64)
        asked = {r["block"]: r for r in rows if r["block"] is not None}
        keys, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for r in counted.to_pylist():
            place = unpacked(asked[r["block"]]["place"])[np.cumsum(unpacked(r["step"]).astype(np.int64))]
            keys.append(place.astype(np.int64) * (2 * classes) + unpacked(r["cell"]))
            times.append(unpacked(r["n"]).astype(np.int64))
        keys, times = np.concatenate(keys), np.concatenate(times)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        new = k.copy()
        if len(first):
            n = np.add.reduceat(times[order], first)
            word, back = np.unique(keys[first] // (2 * classes), return_inverse=True)
            new[word] = Gains(table).best(back, keys[first] % (2 * classes), n, k[word])
        if half is None:
            new = np.where(np.isin(_u64(own["h1"]), top), k, new)
        return _answers(own["shard"], list(asked.values()), new, unpacked64(own["c"]), classes, int((new != k).sum()), False)

    own_half = F.lit(True) if half is None else F.pmod("shard", F.lit(2)) == half
    held = state.filter("block is null").select("shard", "block", "at", F.lit(None).cast("binary").alias("place"), F.lit(None).cast("binary").alias("h1"), F.lit(None).cast("binary").alias("c"), "k")
    right = lists.select("shard", "block", "at", "place", "h1", "c", F.lit(None).cast("binary").alias("k")).unionByName(held).filter(own_half)
    left = cells.filter("shard >= 0").filter(own_half)
    return materialize(left.groupBy("shard").cogroup(right.groupBy("shard")).applyInArrow(run, STATE))


def refine(blocks: DataFrame, lists: DataFrame, model: Model) -> tuple[Model, DataFrame, list[float]]:
    """Move all training words by their own neighbours: the model, the words' state, and the gain of every round."""
    classes = len(model.table)
    state, gains = first_state(lists, model), []
    table, half = model.table, None
    cells = count_cells(blocks, state, classes, half)
    while True:
        moved = move_words(cells, lists, state, table, model.top, half)
        release(cells)
        if not moved.filter("block is null").agg(F.coalesce(F.sum("moved"), F.lit(0))).first()[0]:
            release(moved)
            break
        still = None if half is None else materialize(state.filter(F.pmod("shard", F.lit(2)) != half))
        trial = moved if still is None else moved.unionByName(still)
        half = 0 if half is None else 1 - half
        cells = count_cells(blocks, trial, classes, half)
        grown = class_bigrams(cells, classes)
        gains.append((likelihood(grown) - likelihood(table)) / max(1.0, table.sum()))
        if gains[-1] <= 0:  # taken back
            release(cells, moved, *([still] if still is not None else []))
            break
        old, state, table = state, trial, grown
        _release_parts(old)
        state._parts = [moved] + ([still] if still is not None else [])
        if gains[-1] < LEAST_GAIN:
            release(cells)
            break
    words = np.zeros(classes)
    for r in state.filter("block is null").select("words").mapInArrow(_sum_words(classes), "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        words[r["k"]] = r["n"]
    return Model(model.top, model.of, table, table.sum(0), words), state, gains


def _release_parts(state: DataFrame) -> None:
    for part in getattr(state, "_parts", [state]):
        release(part)


def _sum_words(classes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(classes, np.int64)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                total += unpacked(data)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(classes)), pa.array(total)], names=["k", "n"])

    return run


def final_answers(lists: DataFrame, state: DataFrame, classes: int) -> DataFrame:
    """What the shards tell each block in the end: class and count of its words."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.to_pylist()
        own = next(r for r in rows if r["block"] is None and r["c"] is not None)
        k = unpacked(next(r["k"] for r in rows if r["k"] is not None)).astype(np.int64)
        return _answers(own["shard"], [r for r in rows if r["block"] is not None], k, unpacked64(own["c"]), classes, 0, True)

    nothing = F.lit(None).cast("binary")
    held = state.filter("block is null").select("shard", "block", "at", nothing.alias("place"), nothing.alias("c"), "k")
    rows = lists.select("shard", "block", "at", "place", "c", nothing.alias("k")).unionByName(held)
    return rows.groupBy("shard").applyInArrow(run, STATE).filter("block is not null").select("block", "at", "k", "c")


SCORES = "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_texts(docs: DataFrame, train: object) -> DataFrame:
    """``(doc_id, train, n_tokens, n_known, train_tokens, base_score, score)``, one row per document.

    ``train`` marks the rows to learn from.  A null or empty text is its end
    mark alone; without training rows every token is unknown; repeated rows
    stay; of classes that serve a word equally the present one, then the first is
    taken; a very long text is one block; an empty table gives an empty one;
    other columns are ignored.
    """
    blocks = store_blocks(docs, train)
    lists = shard_words(blocks)
    model, state, _ = refine(blocks, lists, fit(blocks, lists))

    def run(block: pa.Table, told: pa.Table) -> pa.Table:
        row, told = block.to_pylist()[0], told.to_pylist()
        at = np.concatenate([unpacked(r["at"]) for r in told])
        k, c = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
        k[at], c[at] = np.concatenate([unpacked(r["k"]) for r in told]), np.concatenate([unpacked64(r["c"]) for r in told])
        tokens, per = unpacked(row["tokens"]), unpacked(row["sizes"]).astype(np.int64)
        n = len(per)
        doc = np.repeat(np.arange(n), per)
        cls, seen = k[tokens], np.log10(c + 1.0)[tokens]
        own = seen + model.step[np.concatenate(([0], cls[:-1])), cls] - model.emission[cls]  # an end mark stands before every text
        return pa.table({
            "doc_id": pa.array(row["doc_id"], pa.int64()), "train": pa.array(row["train"], pa.bool_()), "n_tokens": per,
            "n_known": np.bincount(doc, c[tokens] > 0, n).astype(np.int64), "train_tokens": np.full(n, model.tokens, np.int64),
            "base_score": np.bincount(doc, seen, n) - per * np.log10(model.tokens + model.words + 1.0), "score": np.bincount(doc, own, n),
        })

    told = final_answers(lists, state, len(model.table))
    taken = blocks.select("block", "doc_id", "train", "sizes", "tokens")
    scored = materialize(taken.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(run, SCORES))
    _release_parts(state)
    release(blocks, lists)
    return scored


def q_class_lm(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = score_texts(docs, id_bucket(F.col("doc_id"), 7) != 2)
    return scored.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
