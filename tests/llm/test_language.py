import itertools
import zlib

import numpy as np
import pytest

from eventsieve.llm import language as L


def test_forward_backward_against_all_label_paths():
    rng = np.random.default_rng(3)
    first, steps = rng.random(3) + 0.1, rng.random((3, 3)) + 0.1
    lengths = np.array([1, 0, 5, 2, 6])
    pot = (rng.random((14, 3)) + 0.05).astype(np.float32)
    got = L.marginals(pot, lengths, first, steps)
    at = 0
    for n in lengths[lengths > 0]:
        expected = np.zeros((n, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            w = first[path[0]] * pot[at, path[0]]
            for t in range(1, n):
                w *= steps[path[t - 1], path[t]] * pot[at + t, path[t]]
            for t, y in enumerate(path):
                expected[t, y] += w
        expected /= expected.sum(1, keepdims=True)
        assert np.allclose(got[at : at + n], expected, atol=1e-5)
        at += n


def test_long_sequences_against_a_plain_loop():
    rng = np.random.default_rng(4)
    first, steps = rng.random(4) + 0.1, rng.random((4, 4)) + 0.1
    lengths = np.array([700, 32, 33, 64, 1])
    pot = np.exp(rng.normal(0, 3, (int(lengths.sum()), 4))).astype(np.float32)
    pot /= pot.max(1, keepdims=True)
    got, at = L.marginals(pot, lengths, first, steps), 0
    for n in lengths:
        p = pot[at : at + n].astype(float)
        f, b = np.zeros((n, 4)), np.ones((n, 4))
        f[0] = first * p[0]
        for t in range(1, n):
            f[t] = (f[t - 1] / f[t - 1].sum()) @ steps * p[t]
        for t in range(n - 2, -1, -1):
            b[t] = steps @ (p[t + 1] * b[t + 1])
            b[t] /= b[t].sum()
        expected = f * b / (f * b).sum(1, keepdims=True)
        assert np.allclose(got[at : at + n], expected, atol=1e-3)
        at += n


@pytest.fixture(scope="module")
def sample(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang").collect()
    train = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5]
    return rows, L.fit([r.text for r in train], [r.lang for r in train])


def test_held_out_accuracy(spark, sample):
    got = {r.doc_id: r for r in L.q_language(spark, "/root/testdata/sf0.01").collect()}
    rows, _ = sample
    assert len(got) == len(rows)
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert np.mean([got[r.doc_id].lang_pred == r.lang for r in held]) >= 0.95
    assert all(0 <= r.score <= 1 for r in got.values())


def test_words_of_switched_text_are_labelled(spark, sample):
    rows, model = sample
    by = {lang: [r.text.split() for r in rows if r.lang == lang and 60 < len(r.text.split()) < 400] for lang in ("en", "fr", "de")}
    parts = [(lang, " ".join(own[k][:40])) for k in range(12) for lang, own in by.items()]
    text = " ".join(p for _, p in parts)
    row = L.label_languages(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    raw, right, total, at = text.encode(), 0, 0, 0
    label = np.array([""] * len(raw), dtype="U2")
    for r in row.runs:
        label[r.start : r.end] = r.lang
    for lang, part in parts:
        n = len(part.encode())
        own = label[at : at + n]
        right, total, at = right + (own == lang).sum(), total + (own != "").sum(), at + n + 1
    assert right / total > 0.9


def test_edges(spark, sample):
    _, model = sample
    docs = spark.createDataFrame(
        [(1, None), (2, ""), (3, "123 — 45 !?"), (4, "the of and"), (4, "the of and"), (None, "the of and"), (6, "de la " * 40000), (7, "x" * 200000), (8, "①②。、")],
        "doc_id long, text string",
    ).selectExpr("*", "'z' lang_pred", "1 score", "2 runs")
    got = [(r.doc_id, r.lang_pred, r.score, r.n_words) for r in L.label_languages(docs, model).collect()]
    by = {}
    for g in got:
        by.setdefault(g[0], []).append(g[1:])
    assert all(by[i][0][0] == "und" and by[i][0][1] == 0.0 for i in (1, 2, 3, 8))
    assert len(by[4]) == 2 and by[4][0][0] == "en" and by[None][0][0] == "en"
    assert by[6][0][0] in ("fr", "es") and by[6][0][2] == 80000 and by[7][0][2] == 1


def test_no_labels_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "the of", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in L.identify_languages(docs).collect()] == [("und", 0.0)] * 2
    assert L.identify_languages(docs.limit(0)).collect() == []
