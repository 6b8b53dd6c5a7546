"""Personal data by patterns and a skip-chain conditional random field.

Patterns give the base spans.  The field works on a document's candidates
(loose numbers and tokens around an at sign, a superset of most base spans):
a node each, labelled with a kind or nothing.  Node weights come from shape
and neighbouring words; neighbours in the text share chain potentials;
candidates that repeat or resemble one another anywhere in the document
(equal last digits, equal mailbox names) share skip potentials through one
hub node per such entity, so that n repeats cost n edges.  Base spans are
observed.  Loopy message passing makes labels agree along the skip edges: a
repeat that the patterns miss takes the label of the one they found, and an
entity that the patterns never found takes the label its members' shapes and
neighbours agree on, if that is sure (``UNSEEN_THRESHOLD``).  A candidate that
resembles no other is left to the patterns.

Node and chain weights are fitted on a bounded sample (``TRAIN_ROWS`` rows)
with the base spans as labels.  So that the field does not lean on what the
patterns look for, phones and mailboxes are also shown without it: national
spellings, hosts without a dot.  All documents are then labelled whole.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("email", "ip", "card", "phone")
TRAIN_ROWS = 2000
FEATURES = 4096
EPOCHS = 60
L2 = 0.02
SKIP_WEIGHT = 6.0
ROUNDS = 30
LEAST_DIGITS = 7
KEY_DIGITS = 8
THRESHOLD = 0.5
UNSEEN_THRESHOLD = 0.9  # for entities without a base span

MAILBOX = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A run of digits is entered at its head only: where the head fails, every later digit of the run does.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOOSE = re.compile(r"\+?\(?[0-9](?:[ ().-]{0,2}[0-9])*+")
SUSPECT = re.compile(r"[0-9@]")
Span = tuple[int, int, int]  # kind number, start, end


def luhn(digits: str) -> bool:
    values = [int(d) for d in digits[::-1]]
    return (sum(values[::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches per kind, failing ones dropped; by kind, then start."""
    out: list[Span] = []
    at, floor = text.find("@"), 0
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in MAILBOX:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((0, start, found.end()))
        floor = found.end() if found else at + 1
        at = text.find("@", floor)
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        if 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


def candidates(text: str) -> list[tuple[int, int, str, str]]:
    """``(start, end, text, entity key)`` of loose numbers and at-sign tokens, by start."""
    out = []
    taken = -1
    mails = []
    at = text.find("@")
    while at >= 0:
        # The whole token: back to white space or the sign before, on to white space or the next one.
        start, end = at, at + 1
        while start > max(taken, 0) and not text[start - 1].isspace():
            start -= 1
        while end < len(text) and not text[end].isspace() and text[end] != "@":
            end += 1
        taken = at + 1
        while end > at + 1 and text[end - 1] in ".,;:!?)>\"'":
            end -= 1
        name = text[start:at].strip("<(\"'")
        start = at - len(name)
        if name and end > at + 1:
            mails.append((start, end, text[start:end], f"@{name.lower()}" if len(name) > 2 else ""))
            taken = max(taken, end)
        at = text.find("@", max(end, at + 1))
    k = 0
    for m in LOOSE.finditer(text):
        while k < len(mails) and mails[k][1] <= m.start():
            k += 1
        if k < len(mails) and mails[k][0] < m.end():
            continue
        digits = _digits(m[0])
        if len(digits) >= LEAST_DIGITS or m[0].count(".") == 3:
            out.append((*m.span(), m[0], digits[-KEY_DIGITS:] if len(digits) >= KEY_DIGITS else f".{m[0]}"))
    return sorted(mails + out)


def node_features(text: str, start: int, end: int, found: str) -> list[int]:
    digits = len(_digits(found))
    mail = "@" in found
    shape = re.sub("[0-9]+", "9", re.sub("[^0-9.@+() -]+", "a", found))[:24]
    before, after = text[max(0, start - 24) : start].split(), text[end : end + 24].split()
    names = [
        "bias", f"mail{mail}", f"n{min(digits, 24)}", f"s{shape}", f"+{found[0] == '+'}", f"dots{min(found.count('.'), 5)}",
        f"dom{mail and '.' in found.rpartition('@')[2]}", f"ok{16 <= digits <= 19 and luhn(_digits(found))}",
        f"b{before[-1].lower() if before else ''}", f"a{after[0].lower() if after else ''}",
    ]
    return [crc32(x.encode("utf-8", "surrogatepass")) % FEATURES for x in names]


N_FEATURES = 10


def hidden(found: str, kind: int) -> list[str]:
    """Spellings of a phone or mailbox that its pattern does not look for."""
    if KINDS[kind] == "email":
        name, _, host = found.rpartition("@")
        return [f"{name}@{host.split('.')[0]}", f"{name}@localhost"]
    if KINDS[kind] != "phone" or not found.startswith("+"):
        return []
    digits = _digits(found)
    own = digits[1:] if len(digits) > 9 else digits
    cut = [own[:3], own[3:6], own[6:]]
    return [" ".join(cut), "-".join(cut), f"({cut[0]}) {cut[1]}-{cut[2]}", f"0{cut[0]} {cut[1]}{cut[2]}", f"0{own[:2]} {own[2:6]} {own[6:]}", f"0{own}"]


@dataclass
class Model:
    nodes: np.ndarray  # feature -> score of nothing and of each kind
    chain: np.ndarray  # log potential of neighbouring labels


@dataclass
class Graph:
    """The candidates of several documents as one graph of separate parts."""

    features: np.ndarray  # nodes x N_FEATURES
    seen: np.ndarray  # label of base spans, -1 elsewhere
    chain: np.ndarray  # pairs of neighbours
    skip: np.ndarray  # (node, hub)
    hubs: int


def graph(found: list[tuple[str, list[Span], list]]) -> Graph:
    features, seen, chain, skip, hubs = [], [], [], [], 0
    for text, base, nodes in found:
        first, ours = len(seen), {}
        by_start = sorted((s, e, k) for k, s, e in base)
        starts, furthest = [s for s, _, _ in by_start], list(accumulate((e for _, e, _ in by_start), max))
        for i, (start, end, string, key) in enumerate(nodes):
            features.append(node_features(text, start, end, string))
            over, at = [], bisect_left(starts, end) - 1
            while at >= 0 and furthest[at] > start:  # none further left reaches the node where this one's furthest end does not
                if by_start[at][1] > start:
                    over.append(by_start[at][2])
                at -= 1
            seen.append(1 + min(over) if over else -1)
            if i:
                chain.append((first + i - 1, first + i))
            if key:
                ours.setdefault(key, []).append(first + i)
        for members in ours.values():
            if len(members) > 1:
                skip += [(m, hubs) for m in members]
                hubs += 1
    pair = lambda x: np.array(x, np.int64).reshape(-1, 2)
    return Graph(np.array(features, np.int64).reshape(-1, N_FEATURES), np.array(seen, np.int64), pair(chain), pair(skip), hubs)


def shown_hidden(found: list[tuple[str, list[Span], list]]) -> tuple[np.ndarray, np.ndarray]:
    """``(features, labels)`` of base candidates in the spellings their patterns miss, in their places."""
    features, labels = [], []
    for text, base, nodes in found:
        by_place = {(s, e): k for k, s, e in base}
        for start, end, string, _ in nodes:
            kind = by_place.get((start, end))
            for other in hidden(string, kind) if kind is not None else []:
                features.append(node_features(text, start, end, other))
                labels.append(1 + kind)
    return np.array(features, np.int64).reshape(-1, N_FEATURES), np.array(labels, np.int64)


def fit(graph_: Graph, more: tuple[np.ndarray, np.ndarray] | None = None) -> Model | None:
    """Node weights by regularised logistic steps, chain potentials from label pairs; base spans are the labels.

    ``more`` adds labelled nodes without neighbours (``shown_hidden``)."""
    n, labels = len(graph_.seen), len(KINDS) + 1
    if not n:
        return None
    gold = np.maximum(graph_.seen, 0)
    chain_gold, node_features_ = gold, graph_.features
    if more is not None and len(more[1]):
        node_features_, gold = np.concatenate([graph_.features, more[0]]), np.concatenate([gold, more[1]])
        n = len(gold)
    weights, squares = np.zeros((FEATURES, labels)), np.full((FEATURES, labels), 1e-6)
    for _ in range(EPOCHS):
        score = weights[node_features_].sum(1)
        error = np.exp(score - score.max(1, keepdims=True))
        error /= error.sum(1, keepdims=True)
        error[np.arange(n), gold] -= 1
        flat = node_features_.ravel()
        grad = np.stack([np.bincount(flat, np.repeat(error[:, k], N_FEATURES), FEATURES) for k in range(labels)], 1) / n + L2 / n * weights
        squares += grad * grad
        weights -= 0.3 * grad / np.sqrt(squares)
    weights = np.clip(weights, -0.5, 0.5)  # a node alone says at most e**5 against one label
    pairs = np.ones((labels, labels))
    np.add.at(pairs, (chain_gold[graph_.chain[:, 0]], chain_gold[graph_.chain[:, 1]]), 1)
    chain = np.log(pairs * pairs.sum() / np.outer(pairs.sum(1), pairs.sum(0)))
    return Model(weights, np.clip(chain, -1, 1))


def message_passing(model: Model, graph_: Graph) -> np.ndarray:
    """Label shares of every node after loopy message passing along chain and skip edges."""
    n, labels = len(graph_.seen), len(KINDS) + 1
    score = np.concatenate([model.nodes[graph_.features].sum(1), np.zeros((graph_.hubs, labels))])
    known = np.flatnonzero(graph_.seen >= 0)
    score[known] = -60.0
    score[known, graph_.seen[known]] = 0.0
    local = np.exp(score - score.max(1, keepdims=True))
    agree = np.exp(SKIP_WEIGHT * np.eye(labels) - SKIP_WEIGHT)
    chain = np.exp(model.chain)
    sides = [graph_.chain, graph_.chain[:, ::-1], graph_.skip + [0, n], (graph_.skip + [0, n])[:, ::-1]]
    matrices = [chain, chain.T, agree, agree]
    source = np.concatenate([s[:, 0] for s in sides])
    target = np.concatenate([s[:, 1] for s in sides])
    c, k = len(graph_.chain), len(graph_.skip)
    back = np.concatenate([np.arange(c) + c, np.arange(c), 2 * c + k + np.arange(k), 2 * c + np.arange(k)])
    parts = np.cumsum([0, c, c, k, k])
    log_message = np.zeros((len(source), labels))
    for _ in range(ROUNDS):
        gathered = np.log(local + 1e-30)
        for y in range(labels):
            gathered[:, y] += np.bincount(target, log_message[:, y], len(local))
        outgoing = gathered[source] - log_message[back]
        outgoing = np.exp(outgoing - outgoing.max(1, keepdims=True, initial=-1e9))
        new = np.concatenate([outgoing[parts[i] : parts[i + 1]] @ matrices[i] for i in range(4)])
        new = np.log(new / new.sum(1, keepdims=True) + 1e-30)
        change = np.abs(new - log_message).max(initial=0)
        log_message = 0.5 * log_message + 0.5 * new
        if change < 1e-3:
            break
    gathered = np.log(local + 1e-30)
    for y in range(labels):
        gathered[:, y] += np.bincount(target, log_message[:, y], len(local))
    shares = np.exp(gathered - gathered.max(1, keepdims=True))
    return (shares / shares.sum(1, keepdims=True))[:n]


def possible(found: str, kind: int) -> bool:
    """Whether an entity without a base span can be of the kind at all: a mailbox has its sign, a phone 7 to 15 digits, a card its check digit."""
    digits = _digits(found)
    return {"email": "@" in found, "phone": "@" not in found and 7 <= len(digits) <= 15, "card": 16 <= len(digits) <= 19 and luhn(digits)}.get(KINDS[kind], False)


def alone(text: str, start: int, end: int) -> bool:
    """Whether no letter or digit touches the stretch: parts of longer codes are no entities."""
    return not text[max(0, start - 1) : start].isalnum() and not text[end : end + 1].isalnum()


def find_spans(texts: list[str | None], model: Model | None) -> list[tuple[list[Span], list[Span]]]:
    """``(base, added)`` spans of every text."""
    out: list[tuple[list[Span], list[Span]]] = [([], []) for _ in texts]
    rows = []
    for i, text in enumerate(texts):
        if text and SUSPECT.search(text):
            out[i] = (base_spans(text), [])
            nodes = candidates(text)
            if nodes and model is not None:
                rows.append((i, (text, out[i][0], nodes)))
    if not rows:
        return out
    built = graph([r for _, r in rows])
    shares = message_passing(model, built)
    found = np.zeros(built.hubs, bool)
    found[built.skip[built.seen[built.skip[:, 0]] >= 0, 1]] = True
    least = np.full(len(shares), 2.0)  # what resembles nothing else is left to the patterns
    least[built.skip[:, 0]] = np.where(found[built.skip[:, 1]], THRESHOLD, UNSEEN_THRESHOLD)
    label = np.where(1 - shares[:, 0] > least, 1 + shares[:, 1:].argmax(1), 0)
    at = 0
    for i, (_, base, nodes) in rows:
        for j, (start, end, string, _) in enumerate(nodes):
            kind = int(label[at + j]) - 1
            if least[at + j] == UNSEEN_THRESHOLD and not (possible(string, kind) and alone(texts[i], start, end)):
                continue
            if kind >= 0 and built.seen[at + j] < 0 and not any(k == kind and s < end and e > start for k, s, e in base):
                out[i][1].append((kind, start, end))
        at += len(nodes)
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def fit_on(docs: DataFrame, rows: int = TRAIN_ROWS) -> Model | None:
    """Fit on a bounded, repeatable sample of documents that hold a digit or an at sign."""
    text = F.col("text").cast("string")
    suspect = docs.filter(text.rlike("[0-9@]")).select(text.alias("t"), F.xxhash64("doc_id").alias("h"))
    found = suspect.count()
    if not found:
        return None
    # Thinned by hash before the limit, so that no partition sends more than its share of the sample.
    share = min(1.0, 1.2 * rows / found)
    thinned = suspect.filter(F.pmod("h", F.lit(1 << 30)) < int((1 << 30) * share))
    texts = [r["t"] for r in thinned.orderBy("h", "t").limit(rows).select("t").collect()]
    found = [(t, base_spans(t), candidates(t)) for t in texts]
    return fit(graph(found), shown_hidden(found))


OUT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def detect_pii(docs: DataFrame, model: Model | None) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added)``, one row per document.

    The counts and the digest are of the base spans, ``spans`` holds those of
    the field too, ``n_added`` counts them.  A null or empty text has none;
    repeated rows stay; a very long text is labelled whole; an empty table
    gives an empty one; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = find_spans(batch.column(1).to_pylist(), model)
            columns = [batch.column(0)]
            columns += [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in range(len(KINDS))]
            columns.append(pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found], pa.string()))
            columns.append(pa.array([joined(base + added) for base, added in found], pa.string()))
            columns.append(pa.array([len(added) for _, added in found], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in OUT.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, OUT)


def mask(text: str, spans: list[Span]) -> str:
    """The text with every stretch of spans replaced by its first kind in brackets."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask_pii(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with personal data masked in ``text``; an ``n_chars`` column follows, others stay.

    Every row stays, repeated ones too; null and empty texts stay as they are;
    ids do not matter; a very long text is masked whole; an empty table gives an
    empty one; columns of any other name come through.
    """
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            found = find_spans(texts, model)
            new = [mask(t, base + added) if base or added else t for t, (base, added) in zip(texts, found, strict=True)]
            yield batch.set_column(place, "text", pa.array(new, batch.column(place).type))

    fields = [T.StructField("text", T.StringType()) if f.name == "text" else f for f in docs.schema.fields]
    masked = docs.withColumn("text", F.col("text").cast("string")).mapInArrow(run, T.StructType(fields))
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked


def q_pii(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return detect_pii(docs, fit_on(docs))
