import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventsieve.llm import classlm as C
from eventsieve.llm.texts import WordHash


def tokens(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered) + [None]


def brute(rows):
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    c = Counter(w for i, t in rows if not held[i] for w in tokens(t))
    n, v = sum(c.values()), len(c)
    return {
        i: (held[i], len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t)))
        for i, t in rows
    }


def same(got, expected):
    assert got.keys() == expected.keys()
    for i, e in expected.items():
        assert got[i][:4] == e[:4] and got[i][4] == pytest.approx(e[4], rel=1e-9, abs=1e-9)


def test_documents(spark):
    got = C.q_class_lm(spark, "/root/testdata/sf0.01").collect()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    same({r.doc_id: (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got}, brute([(r.doc_id, r.text) for r in docs]))
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > 0.98 * sum(r.base_score for r in held)  # closer to zero than the base
    assert np.mean([r.score > r.base_score for r in held]) > 0.8
    assert all(r.score < 0 for r in got)


def prepared(spark, rows, train=None):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    blocks = C.store_blocks(docs, F.lit(True) if train is None else train)
    return blocks, C.shard_words(blocks)


def word_classes(lists, state):
    """``{hash: (class, count)}`` of all words."""
    k = {r.shard: C.unpacked(r.k) for r in state.filter("block is null").collect()}
    out = {}
    for r in lists.filter("block is null").collect():
        out |= dict(zip(C._u64(r.h1).tolist(), zip(k[r.shard].tolist(), C.unpacked64(r.c).tolist(), strict=True), strict=True))
    return out


def word_hash(w):
    data = np.frombuffer((w or "").encode(), np.uint8)
    return int(WordHash()(data, np.array([0]), np.array([len(data)]))[0]) if w else 0


def test_probabilities_sum_to_one(spark):
    rows = [(i, " ".join(np.random.default_rng(i).choice(["a", "b", "cc", "dd", "eee"], 30))) for i in range(60)]
    blocks, lists = prepared(spark, rows)
    seed = C.fit(blocks, lists)
    model, state, _ = C.refine(blocks, lists, seed)
    count = Counter(w for _, t in rows for w in tokens(t))
    own = word_classes(lists, state)
    assert {word_hash(w): c for w, c in count.items()} == {h: c for h, (_, c) in own.items()}
    for m, of in ((seed, None), (model, own)):
        assert (m.tokens, m.words) == (sum(count.values()), 6)
        assert np.allclose((10**m.step).sum(1), 1)
        share = np.zeros(C.CLASSES)
        for w, c in count.items():
            k = of[word_hash(w)][0] if of else m.of[0 if w is None else 1 + int(np.searchsorted(m.top, np.uint64(word_hash(w))))]
            share[k] += (c + 1) / 10 ** m.emission[k]
        used = share > 0
        assert np.allclose(share[used] + 1 / 10 ** m.emission[used], 1)  # what is left is for one unseen word


def test_scores_equal_a_plain_version(spark, monkeypatch):
    """The whole score from the word classes, by counting class bigrams and words in plain Python."""
    monkeypatch.setattr(C, "TOP_WORDS", 10)
    monkeypatch.setattr(C, "CLASSES", 5)
    monkeypatch.setattr(C, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(C, "SHARD_WORDS", 100)
    rng = np.random.default_rng(8)
    vocabulary = [f"w{i}x{i % 7}" for i in range(150)]
    rows = [(i, " ".join(rng.choice(vocabulary, 40 + i, p=np.arange(150, 0, -1) / 11325))) for i in range(70)] + [(90, None), (91, "never seen words")]
    held = F.col("doc_id") % 5 != 0
    seen = {}
    real = C.refine

    def spy(blocks, lists, model):
        out = real(blocks, lists, model)
        seen.update(own=word_classes(lists, out[1]), classes=len(out[0].table), blocks=blocks.count(), shards=lists.filter("block is null").count())
        return out

    monkeypatch.setattr(C, "refine", spy)
    got = {r.doc_id: r for r in C.score_texts(spark.createDataFrame(rows, "doc_id long, text string"), held).collect()}
    assert seen["blocks"] > 2 and seen["shards"] > 2
    of = {w: seen["own"][word_hash(w)][0] for _, t in rows for w in tokens(t)}
    c, pairs, before, total, words = Counter(), Counter(), Counter(), Counter(), Counter()
    for i, t in rows:
        if i % 5 and i is not None:
            last = 0
            for w in tokens(t):
                c[w] += 1
                pairs[last, of[w]] += 1
                before[last] += 1
                last = of[w]
    for w, n in c.items():
        total[of[w]] += n
        words[of[w]] += 1
    n, k = sum(c.values()), seen["classes"]
    for i, t in rows:
        score, last = 0.0, 0
        for w in tokens(t):
            share = (total[of[w]] + 1) / (n + k)
            step = (pairs[last, of[w]] + C.PRIOR * share) / (before[last] + C.PRIOR)
            score += math.log10(step) + math.log10((c[w] + 1) / (total[of[w]] + words[of[w]] + 1))
            last = of[w]
        assert got[i].score == pytest.approx(score, rel=1e-9)


def test_a_cluster_that_changes_between_jobs_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK_BYTES", 20_000)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = F.col("doc_id") % 7 != 2
    plain = {r.doc_id: tuple(r) for r in C.score_texts(docs, held).collect()}
    real, before = C.fit, (spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.shuffle.partitions"))

    def changed(blocks, lists):
        spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        return real(blocks, lists)

    monkeypatch.setattr(C, "fit", changed)
    try:
        again = {r.doc_id: tuple(r) for r in C.score_texts(docs, held).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.shuffle.partitions", before[1])
    assert again.keys() == plain.keys()
    for i, r in plain.items():
        assert again[i][:6] == pytest.approx(r[:6]) and again[i][6] == pytest.approx(r[6], rel=1e-9)


def test_best_classes_against_trying_all_of_them():
    rng = np.random.default_rng(4)
    classes, words = 6, 60
    table = rng.poisson(400, (classes, classes)).astype(float)
    old = rng.integers(1, classes, words)
    rows = [(w, c, int(rng.choice([1, 2, 5, 9, 30] if w % 2 else [1, 2]))) for w in range(words) for c in sorted(rng.choice(2 * classes, 4, replace=False))]
    word, cell, n = (np.array([r[i] for r in rows]) for i in range(3))
    got = C.Gains(table).best(word, cell, n, old)
    for w in range(words):
        mine = [(c, m) for v, c, m in rows if v == w]
        trials = []
        for k in range(1, classes):
            # The word's own counts leave its class and join another; the classes beside it stay, each side for itself.
            t, u = table.copy(), table.copy()
            for c, m in mine:
                if c < classes:
                    t[old[w], c] -= m
                    t[k, c] += m
                else:
                    u[c - classes, old[w]] -= m
                    u[c - classes, k] += m
            margin_rows, margin_cols = table.sum(1), table.sum(0)
            out, into = sum(m for c, m in mine if c < classes), sum(m for c, m in mine if c >= classes)
            margin_rows[old[w]] -= out
            margin_rows[k] += out
            margin_cols[old[w]] -= into
            margin_cols[k] += into
            trials.append(C._xlogx(t).sum() + C._xlogx(u).sum() - C._xlogx(margin_rows).sum() - C._xlogx(margin_cols).sum())
        value = trials[got[w] - 1]
        assert value >= max(trials) - C.LEAST_MOVE - 1e-3


def likelihood(bigrams, of):
    member = np.eye(C.CLASSES)[of]
    t = member.T @ bigrams @ member
    return C._xlogx(t).sum() - C._xlogx(t.sum(0)).sum() - C._xlogx(t.sum(1)).sum()


def test_exchange_finds_planted_classes_and_no_single_move_helps():
    rng = np.random.default_rng(1)
    kind = rng.integers(0, 3, 40)
    rate = np.array([[1, 30, 1], [1, 1, 30], [30, 1, 1]])
    bigrams = rng.poisson(rate[kind][:, kind] * 5).astype(float)
    bigrams[0] = bigrams[:, 0] = 1
    of = C.exchange(bigrams, 4, 30)
    for a in range(1, 40):
        for b in range(1, 40):
            assert (of[a] == of[b]) == (kind[a] == kind[b])
    best = likelihood(bigrams, of)
    for u in range(1, 40):
        for c in range(1, 4):
            trial = of.copy()
            trial[u] = c
            assert likelihood(bigrams, trial) <= best + 1e-6


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "One one ONE"), (4, "é É \x0b x"), (5, "w " * 50000), (6, "long" * 30000), (7, " ")]
    rows += [(i, "the of and") for i in range(8, 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS block", "2 AS train", "3 AS h1")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    got = C.score_texts(docs, held).collect()
    same({r.doc_id: (not r.train, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got}, brute(rows))
    assert C.score_texts(docs.limit(0), held).collect() == []
    untrained = C.score_texts(docs.limit(3), F.lit(False)).collect()
    assert [(r.n_known, r.train_tokens, r.base_score) for r in untrained] == [(0, 0, 0.0)] * 3
    again = C.score_texts(spark.createDataFrame([(3, "a b"), (3, "a b"), (None, "a b")], "doc_id long, text string"), F.lit(True)).collect()
    assert sorted(str((r.doc_id, r.n_known)) for r in again) == ["(3, 3)", "(3, 3)", "(None, 3)"]


def test_rare_words_take_the_class_of_their_neighbours(spark, monkeypatch):
    monkeypatch.setattr(C, "TOP_WORDS", 20)
    monkeypatch.setattr(C, "CLASSES", 4)
    rng = np.random.default_rng(3)
    kinds = [[f"{chr(97 + i % 26)}{i}{k}zzz" for i in range(150)] for k in "xy"]  # spelling tells nothing: equal last bytes
    rows = [(i, " ".join(str(rng.choice(kinds[j % 2])) for j in range(100))) for i in range(60)]
    blocks, lists = prepared(spark, rows)
    seed = C.fit(blocks, lists)
    model, state, gains = C.refine(blocks, lists, seed)
    assert C.likelihood(model.table) > C.likelihood(seed.table) and gains[0] > C.LEAST_GAIN
    frequent = set(seed.top.tolist())
    own = {h: k for h, (k, _) in word_classes(lists, state).items() if h and h not in frequent}
    found = np.zeros((2, len(model.table)))
    for side, kind in enumerate(kinds):
        for w in kind:
            if word_hash(w) in own:
                found[side, own[word_hash(w)]] += 1
    assert found.sum() == 280 and found.max(0).sum() > 0.95 * found.sum()  # a class holds words of one kind
    assert (model.tokens, model.words) == (seed.tokens, seed.words) and np.allclose((10**model.step).sum(1), 1)


def test_classes_grow_with_the_vocabulary(spark):
    few, many = ([(0, " ".join(f"w{i}" for i in range(n)))] for n in (100, 300_000))
    sizes = []
    for rows in (few, many):
        sizes.append(len(C.fit(*prepared(spark, rows)).table))
    assert sizes == [64, 67]


def test_rounds_go_on_while_they_gain(spark, monkeypatch):
    """More than two rounds where they help, the frequent words among the movers, and none past the stated gain."""
    monkeypatch.setattr(C, "LEAST_GAIN", 1e-6)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    blocks = C.store_blocks(docs, F.lit(True))
    lists = C.shard_words(blocks)
    seed = C.fit(blocks, lists)
    model, state, gains = C.refine(blocks, lists, seed)
    assert len(gains) > 2 and all(g > 0 for g in gains[:-1])
    assert C.likelihood(model.table) == pytest.approx(C.likelihood(seed.table) + sum(g for g in gains if g > 0) * model.tokens, rel=1e-6)
    own = word_classes(lists, state)
    assert any(own[h][0] != seed.of[1 + i] for i, h in enumerate(seed.top.tolist()))
    print(gains)


def test_counts_past_32_bits_pack():
    values = np.array([0, 1, (1 << 32) - 1, 1 << 32, 1 << 45, 7], np.int64)
    assert C.unpacked64(C.packed64(values)).tolist() == values.tolist() and C.unpacked64(C.packed64(values[:0])).tolist() == []
