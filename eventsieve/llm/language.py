"""Language of every word by a linear-chain conditional random field.

A word's emission is a sum of learned weights: byte n-grams of two to four
bytes of the word between two boundary marks (those holding a mark are its
affixes), hashed into fixed tables, and a lexicon score.  Label transitions
are learned with them by gradient steps on the log-likelihood, whose
marginals come from forward-backward.  Training sequences splice runs of
words of several documents, so that the model sees switches.

Only the fit is bounded (``ROWS_PER_LANGUAGE`` labelled rows, ``RUNS`` runs
of ``RUN_WORDS`` words of each, drawn over the whole text).  Prediction runs
exact forward-backward over all words of all whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventsieve.llm.texts import LOWER, flat, id_bucket, led_text, pieces

ROWS_PER_LANGUAGE = 300
LABEL_BYTES = 1 << 19  # text labelled at once: a byte takes some 100 bytes of tables
RUNS = 10
RUN_WORDS = 16
SPLICED = 3
EPOCHS = 6
BATCH = 192
RATE = 0.3
BITS3, BITS4, BITS_WORD = 17, 18, 18
STEP = 32
UNDETERMINED = "und"

# Bytes of ASCII letters in lower case, bytes of other scripts as they are, 0 elsewhere.
LETTER = np.zeros(256, np.uint8)
LETTER[ord("a") : ord("z") + 1] = LOWER[ord("a") : ord("z") + 1]
LETTER[ord("A") : ord("Z") + 1] = LOWER[ord("A") : ord("Z") + 1]
LETTER[128:] = np.arange(128, 256)


def letter_runs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(marked bytes, starts, ends, word keys)`` of the letter runs in ``data``.

    ``data`` starts every document with a line feed.  A word's key sums mixed
    hashes of its four-byte stretches, boundary marks included.
    """
    m = np.concatenate([LETTER[data], np.zeros(4, np.uint8)])
    turns = np.diff((m != 0).view(np.int8))
    starts, ends = np.flatnonzero(turns == 1) + 1, np.flatnonzero(turns == -1) + 1
    n = len(m) - 3
    four = np.ndarray(n, "<u4", m.tobytes(), strides=(1,))
    mixed = four.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    if not len(starts):
        return m, starts, ends, np.zeros(0, np.uint64)
    both = np.stack([starts - 1, ends], 1).ravel()
    return m, starts, ends, np.add.reduceat(mixed, both)[::2]


def word_grams(m: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """``(first row of each word, n-gram table rows)``; row 0 of a table is no n-gram."""
    width = ends - starts + 1
    heads = np.cumsum(width) - width
    at = np.arange(int(width.sum())) + np.repeat(starts - 1 - heads, width)
    b = [m[at + k].astype(np.uint32) for k in range(4)]
    two = b[0] | (b[1] << np.uint32(8))
    three = two | (b[2] << np.uint32(16))
    four = three | (b[3] << np.uint32(24))
    in1 = b[1] != 0
    g3 = ((three * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS3)) * in1
    g4 = ((four * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS4)) * (in1 & (b[2] != 0))
    return heads, [two, g3, g4]


def lexicon_rows(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(64 - BITS_WORD)).astype(np.int64)


@dataclass
class Model:
    langs: list[str]
    tables: list[np.ndarray]  # n-gram row -> weight of each language
    lexicon: np.ndarray  # word row -> log share of each language in the lexicon half of the sample
    lexicon_weight: np.ndarray
    first: np.ndarray
    steps: np.ndarray  # log transition weights

    def emissions(self, m: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Label scores of every word; each distinct word of the piece is scored once."""
        distinct, first, back = np.unique(keys, return_index=True, return_inverse=True)
        heads, grams = word_grams(m, starts[first], ends[first])
        total = np.take(self.tables[0], grams[0], axis=0)
        total += np.take(self.tables[1], grams[1], axis=0)
        total += np.take(self.tables[2], grams[2], axis=0)
        scores = np.add.reduceat(total, heads, axis=0) + self.lexicon[lexicon_rows(distinct)] * self.lexicon_weight
        return np.take(scores, back, axis=0)


def marginals(potentials: np.ndarray, lengths: np.ndarray, first: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Posterior label shares of every word of many sequences, exactly.

    ``potentials`` (words x labels, positive) lie sequence after sequence.
    Sequences are cut into stretches of ``STEP`` words; a product of transfer
    matrices per stretch carries the forward and backward messages over
    whole stretches, then all stretches run their words side by side.
    """
    n_labels = potentials.shape[1]
    lengths = lengths[lengths > 0]
    if not len(lengths):
        return np.zeros((0, n_labels), np.float32)
    counts = -(-lengths // STEP)
    heads = np.concatenate(([0], np.cumsum(counts)))  # first stretch of each sequence
    total = int(heads[-1])
    seq = np.repeat(np.arange(len(lengths)), counts)
    inner = np.arange(total) - heads[seq]
    size = np.minimum(STEP, lengths[seq] - inner * STEP)
    slot = np.repeat(np.arange(total) * STEP - (np.cumsum(size) - size), size) + np.arange(int(lengths.sum()))
    # Rows of the transfer matrix sum to one; their scale goes to every word that has a successor.  A
    # padded word of potential one then passes messages on unchanged, and no step needs a mask.
    scale = steps.sum(1)
    flow = (steps / scale[:, None]).astype(np.float32)
    pot = np.ones((total * STEP, n_labels), np.float32)
    pot[slot] = potentials * scale.astype(np.float32)
    last = slot[np.cumsum(lengths) - 1]
    pot[last] = potentials[np.cumsum(lengths) - 1]
    pot = np.ascontiguousarray(pot.reshape(total, STEP, n_labels).transpose(1, 0, 2))
    is_head = heads[:-1]
    first = (first / first.sum()).astype(np.float32)

    carry = np.broadcast_to(flow, (total, n_labels, n_labels)).copy()
    carry[is_head] = first  # whatever came before, the first word starts anew
    for k in range(STEP):
        if k:
            carry = (carry.reshape(-1, n_labels) @ flow).reshape(carry.shape)
        carry *= pot[k][:, None, :]
        if k % 8 == 7:
            carry /= carry.sum((1, 2), keepdims=True)

    ahead = np.full((total, n_labels), 1 / n_labels, np.float32)  # message into each stretch
    behind = np.ones((total, n_labels), np.float32)  # message from what follows it
    order = np.argsort(-counts, kind="stable")
    ranked = counts[order]
    for i in range(int(counts.max()) - 1):
        open_ = order[: int(np.searchsorted(-ranked, -(i + 1), "left"))]
        s = heads[open_] + i
        v = np.einsum("sa,sab->sb", ahead[s], carry[s])
        ahead[s + 1] = v / v.sum(1, keepdims=True)
        s = heads[open_ + 1] - 1 - i
        v = np.einsum("sab,sb->sa", carry[s], behind[s])
        behind[s - 1] = v / v.sum(1, keepdims=True)

    forward = np.empty_like(pot)
    for k in range(STEP):
        v = (ahead if k == 0 else forward[k - 1]) @ flow
        if k == 0:
            v[is_head] = first
        np.multiply(v, pot[k], out=forward[k])
        if k % 8 == 7:
            forward[k] /= forward[k].sum(1, keepdims=True)
    v = behind
    for k in range(STEP - 1, -1, -1):
        forward[k] *= v
        v = (v * pot[k]) @ flow.T
        if k % 8 == 7:
            v /= v.sum(1, keepdims=True)
    shares = np.ascontiguousarray(forward.transpose(1, 0, 2)).reshape(-1, n_labels)[slot]
    return shares / shares.sum(1, keepdims=True)


def _potentials(emissions: np.ndarray) -> np.ndarray:
    return np.exp(np.maximum(emissions - emissions.max(1, keepdims=True), -20.0)).astype(np.float32)


def _spliced(rng: np.random.Generator, runs: list[list[np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sequences of ``(word numbers, labels)``: runs of several languages one after the other."""
    pool = [(lang, run) for lang, own in enumerate(runs) for run in own]
    order = rng.permutation(len(pool))
    out = []
    for lo in range(0, len(order), SPLICED):
        chosen = [pool[i] for i in order[lo : lo + SPLICED]]
        out.append((np.concatenate([r for _, r in chosen]), np.concatenate([np.full(len(r), lang) for lang, r in chosen])))
    return out


def fit(texts: list[str], labels: list[str], seed: int = 7) -> Model | None:
    """Fit the field on a bounded sample of labelled texts; None without any labelled word."""
    langs = sorted(set(labels))
    if not langs:
        return None
    rng = np.random.default_rng(seed)
    n = len(langs)
    data = [np.frombuffer(("\n" + t).encode("utf-8", "surrogatepass"), np.uint8) for t in texts]
    offsets = np.cumsum([0, *map(len, data)])
    whole = np.concatenate(data)
    m, starts, ends, keys = letter_runs(whole)
    words = lexicon_rows(keys)
    if not len(starts):
        return None
    doc = np.searchsorted(offsets, starts, "right") - 1
    lang_of = np.array([langs.index(x) for x in labels])
    halves = rng.permutation(len(texts)) % 2 if len(texts) > 2 * n else np.zeros(len(texts), int)

    counts = np.zeros((1 << BITS_WORD, n))
    in_lexicon = halves[doc] == 0
    np.add.at(counts, (words[in_lexicon], lang_of[doc[in_lexicon]]), 1)
    counts /= np.maximum(counts.sum(0), 1)
    seen = counts.sum(1, keepdims=True) > 0
    share = (counts + 1e-7) / (counts + 1e-7).sum(1, keepdims=True)
    lexicon = np.where(seen, np.maximum(np.log(share), -4.0), 0.0).astype(np.float32)

    tables = [np.zeros((1 << b, n), np.float32) for b in (16, BITS3, BITS4)]
    model = Model(langs, tables, lexicon, np.full(n, 0.5, np.float32), np.zeros(n, np.float32), np.zeros((n, n), np.float32))
    bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
    runs: list[list[np.ndarray]] = [[] for _ in langs]
    for d in range(len(texts)):
        lo, hi = int(bounds[d]), int(bounds[d + 1])
        if hi > lo and (halves[d] == 1 or not halves.any()):
            for a in rng.integers(lo, max(lo + 1, hi - RUN_WORDS + 1), min(RUNS, -(-(hi - lo) // RUN_WORDS))):
                runs[lang_of[d]].append(np.arange(a, min(a + rng.integers(1, 2 * RUN_WORDS), hi)))
    squares = [np.full((len(t), n), 1e-6, np.float32) for t in tables]
    small = [np.full(x.shape, 1e-6) for x in (model.lexicon_weight, model.first, model.steps)]
    for _ in range(EPOCHS):
        sequences = _spliced(rng, runs)
        for lo in range(0, len(sequences), BATCH):
            part = sequences[lo : lo + BATCH]
            number, gold = np.concatenate([p[0] for p in part]), np.concatenate([p[1] for p in part])
            lengths = np.array([len(p[0]) for p in part])
            head_rows, rows = word_grams(m, starts[number], ends[number])
            owner = np.repeat(np.arange(len(number)), ends[number] - starts[number] + 1)
            local = sum(t[r] for t, r in zip(tables, rows, strict=True))
            emission = np.add.reduceat(local, head_rows, axis=0) + lexicon[words[number]] * model.lexicon_weight
            pot = _potentials(emission)
            first, steps = np.exp(model.first), np.exp(model.steps)
            post = marginals(pot, lengths, first, steps)
            heads = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            error = post.copy()
            error[np.arange(len(gold)), gold] -= 1
            # Expected transitions from neighbouring posteriors through the local pair potential.
            left = np.setdiff1d(np.arange(len(gold) - 1), heads[1:] - 1)
            pair = (post[left][:, :, None] * steps[None]) * pot[left + 1][:, None, :]
            pair *= (post[left + 1] / np.maximum(pair.sum(1), 1e-12))[:, None, :]
            moves = pair.sum(0)
            np.subtract.at(moves, (gold[left], gold[left + 1]), 1)
            scale = np.float32(1 / len(part))
            for t, sq, r in zip(tables, squares, rows, strict=True):
                touched, back = np.unique(r, return_inverse=True)
                spread = error[owner]
                grad = np.stack([np.bincount(back, spread[:, k], len(touched)) for k in range(n)], 1).astype(np.float32) * scale
                sq[touched] += grad * grad
                t[touched] -= RATE * grad / np.sqrt(sq[touched])
                t[0] = 0
            slopes = [(error * lexicon[words[number]]).sum(0) * scale, error[heads].sum(0) * scale, moves * scale]
            for x, sq, g in zip((model.lexicon_weight, model.first, model.steps), small, slopes, strict=True):
                sq += g * g
                x -= (0.1 * g / np.sqrt(sq)).astype(np.float32)
    return model


def training_rows(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> list:
    """A bounded, repeatable sample of labelled rows: about as many of each language."""
    labelled = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).filter(
        (id_bucket(F.col("doc_id"), 5) != 0) & F.col("text").isNotNull() & F.col("lang").isNotNull()
    )
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not counts:
        return []
    at = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    picked = F.lit(False)
    for lang, count in sorted(counts.items()):
        picked = picked | ((F.col("lang") == lang) & (at < int((1 << 30) * min(1.0, rows_per_language / count))))
    return labelled.filter(picked).select("text", "lang").orderBy(at).limit(2 * rows_per_language * len(counts)).collect()


def _label(m: Model | None, column: pa.Array):
    """``(language, score, sureness, words, runs, (label, start, end) of all runs)`` of a column of led texts."""
    data, offsets = flat(column)
    rows = len(column)
    letters, starts, ends, keys = letter_runs(data)
    doc = np.searchsorted(offsets, starts, "right") - 1
    lengths = np.bincount(doc, minlength=rows)
    pred, score, sure, n_runs = [UNDETERMINED] * rows, np.zeros(rows), np.zeros(rows), np.zeros(rows, np.int64)
    nothing = np.zeros(0, np.int64)
    if m is None or not len(starts):
        return pred, score, sure, lengths, n_runs, (nothing, nothing, nothing)
    post = marginals(_potentials(m.emissions(letters, starts, ends, keys)), lengths, np.exp(m.first), np.exp(m.steps))
    filled = np.flatnonzero(lengths)
    edges = np.concatenate(([0], np.cumsum(lengths[filled])[:-1]))
    means = np.add.reduceat(post.astype(np.float64), edges, axis=0) / lengths[filled][:, None]
    best = means.argmax(1)
    sure[filled] = np.add.reduceat(post.max(1).astype(np.float64), edges) / lengths[filled]
    # Runs of bytes beyond ASCII may hold no letter (other scripts' signs).
    ascii_letters = np.add.reduceat((LETTER[data] - np.uint8(1) < 127).astype(np.int64), offsets[:-1])
    for i, d in enumerate(filled.tolist()):
        if ascii_letters[d] or any(map(str.isalpha, column[d].as_py())):
            pred[d], score[d] = m.langs[best[i]], min(1.0, float(means[i, best[i]]))
    label = post.argmax(1)
    head = np.flatnonzero(np.concatenate(([True], (label[1:] != label[:-1]) | (doc[1:] != doc[:-1]))))
    keep = np.array([p != UNDETERMINED for p in pred])[doc[head]]
    tail = np.concatenate((head[1:], [len(label)])) - 1
    shift = offsets[doc[head]] + 1
    runs = (label[head][keep], (starts[head] - shift)[keep], (ends[tail] - shift)[keep])
    return pred, score, sure, lengths, np.bincount(doc[head][keep], minlength=rows), runs


def label_languages(docs: DataFrame, model: Model | None) -> DataFrame:
    """Every document's words labelled: ``(doc_id, lang_pred, score, n_words, n_runs, runs)``.

    ``score`` is the mean posterior of ``lang_pred`` over the words (letter
    runs); ``runs`` lists the stretches of one language as UTF-8 byte offsets
    ``(lang, start, end)``.  A text that is null, empty or without letters
    gives ``und``, 0.0 and no runs, as does every text where no model could
    be fitted.  Repeated rows stay, a very long text is labelled whole, other
    columns are ignored.
    """
    run_type = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    names = pa.array(model.langs if model else [], pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1, LABEL_BYTES):
            pred, score, _, lengths, n_runs, (lang, start, end) = _label(model, batch.column(1))
            listed = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum(n_runs))), pa.int32()),
                pa.StructArray.from_arrays(
                    [names.take(pa.array(lang)), pa.array(start, pa.int64()), pa.array(end, pa.int64())], ["lang", "start", "end"]
                ),
            ).cast(run_type)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(pred, pa.string()), pa.array(score), pa.array(lengths, pa.int64()), pa.array(n_runs, pa.int64()), listed],
                names=["doc_id", "lang_pred", "score", "n_words", "n_runs", "runs"],
            )

    schema = "doc_id long, lang_pred string, score double, n_words long, n_runs long, runs array<struct<lang:string,start:long,end:long>>"
    return docs.select(F.col("doc_id").cast("long"), led_text(F.col("text"))).mapInArrow(run, schema)


def keep_identified(docs: DataFrame, model: Model | None, least_sureness: float) -> DataFrame:
    """The rows of ``docs``, columns unchanged, whose words are labelled surely: the mean of each word's best
    posterior is ``least_sureness`` at least.

    A text of several languages stays however they share it; letters of no
    known language go, and so do texts that are null, empty or without letters,
    and every text where no model could be fitted.  Rows are judged each for
    itself: repeated rows, repeated or null ids change nothing.  Very long texts
    are judged whole; an empty table gives an empty one; columns of any name
    come through.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, batches_text, LABEL_BYTES):
            pred, _, sure, *_ = _label(model, batch.column(batches_text))
            keep = (np.array(pred) != UNDETERMINED) & (sure >= least_sureness)
            yield batch.filter(pa.array(keep)).select(range(batches_text))

    batches_text = len(docs.columns)
    return docs.withColumn("__led_text", led_text(F.col("text"))).mapInArrow(run, docs.schema)


def identify_languages(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> DataFrame:
    """Fit on the labelled part of ``docs`` and label all of it."""
    rows = training_rows(docs, rows_per_language)
    return label_languages(docs, fit([r["text"] for r in rows], [r["lang"] for r in rows]))


def q_language(spark, sf_dir: str) -> DataFrame:
    labelled = identify_languages(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return labelled.select("doc_id", (id_bucket(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score", "n_words", "n_runs")
