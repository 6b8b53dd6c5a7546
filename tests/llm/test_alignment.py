"""Alignment of two tokenizers against a byte-by-byte brute force."""

import hashlib
from collections import Counter

import pytest

np = pytest.importorskip("numpy")
pytest.importorskip("tokenizers")
pytest.importorskip("sentencepiece")
pytest.importorskip("public_tokenizers")

from eventsieve.llm import alignment, vocabularies  # noqa: E402


@pytest.fixture(scope="module")
def made():
    read, path = vocabularies.read_file, vocabularies.public_file
    return alignment.Vocabularies(read(path("byte_bpe_50k.json")), read(path("piece_bpe_32k.model")))


def brute(made, texts):
    """Per text: tokens of both sides, groups as text, links; then the counts over all."""
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(vocabularies.public_file("byte_bpe_50k.json"))
    a_side.encode_special_tokens = True
    found = []
    for t in texts:
        if not t:
            found.append(([], [], "", []))
            continue
        a, b = a_side.encode(" " + t, add_special_tokens=False).ids, made.b.encode(t)
        if any(b"".join(table[i] for i in ids) != (" " + t).encode() for table, ids in ((made.a_bytes, a), (made.b_bytes, b))):
            found.append(([], [], "", []))
            continue
        owner_a = [k for k, i in enumerate(a) for _ in made.a_bytes[i]]
        owner_b = [k for k, i in enumerate(b) for _ in made.b_bytes[i]]
        links = sorted(set(zip(owner_a, owner_b, strict=True)))
        n = len(owner_a)
        ends = [x for x in range(1, n + 1) if x == n or (owner_a[x] != owner_a[x - 1] and owner_b[x] != owner_b[x - 1])]
        groups, lo = [], 0
        for hi in ends:
            ga, gb = sorted(set(owner_a[lo:hi])), sorted(set(owner_b[lo:hi]))
            groups.append(",".join(str(a[k]) for k in ga) + "|" + ",".join(str(b[k]) for k in gb))
            lo = hi
        found.append((a, b, ";".join(groups), [(a[x], b[y]) for x, y in links]))
    count = Counter(p for f in found for p in f[3])
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    return [
        (len(a), len(b), len(g.split(";")) if g else 0, len(links), sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links), g,
         hashlib.sha256(g.encode()).hexdigest() if g else "")
        for a, b, g, links in found
    ], count


TEXTS = [
    "The quick brown fox jumps over the lazy dog.", "Unbelievable antidisestablishmentarianism, whhati theding areintionon!", None, "", " ", "  two spaces  ",
    "aaaaaaaaaaaaaaaaaaaaaa aaa aa a", "naïve café Zoë 東京 🙂 ﬁ", "mark ▁ inside", "<|endoftext|> and </s> <s> <unk> <0x41>", "tabs\tand\nlines\r\n", "x\x00y",
    "1234567890 12,345.67", "def f(x):\n    return x  # comment\n", "é combining", "The quick brown fox jumps over the lazy dog.", "ﬀ ½ Ⅳ", " nbsp", "ABC" * 50,
    "﻿bom", "a b", "l'été d'Anna it's we'll",
]


def test_operator_matches_brute_force(spark, made):
    long_text = "Erwher oran erti, ndndhe is ththea édatin for of 3 thinston. " * 2500
    texts = [*TEXTS, long_text, "x" * 3000]
    rows = [(i % 21 if i != 3 else None, t, 1, "c") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_a int, pairs string").repartition(3)
    expected, count = brute(made, texts)
    got = alignment.align(docs, keep_groups=True)
    mine = sorted((str(r["doc_id"]), *(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups", "groups_sha256"))) for r in got.documents.collect())
    assert mine == sorted((str(r[0]), *e) for r, e in zip(rows, expected, strict=True))
    assert {(r["a"], r["b"]): r["n"] for r in got.counts.collect()} == dict(count)
    assert sum(e[0] > 0 for e in expected) > 12 and sum(e[0] == 0 for e in expected) >= 3


def test_blocks_ask_for_their_pairs_alone(spark, made, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 200)
    texts = [f"{w} {x}ization of the {w}{x} pre{w}" for w in ("alpha", "wherre", "thonin", "gamma") for x in ("nation", "oner", "atst", "itty")] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    expected, _ = brute(made, texts)
    blocks = alignment._blocks(docs, made, False)
    assert blocks.filter("block is not null").count() > 6
    got = {r["doc_id"]: r for r in alignment.align(docs).documents.collect()}
    for i, e in enumerate(expected):
        r = got[i]
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) == (*e[:6], e[7])
        assert r["groups"] is None


def test_same_bytes_prefer_written_pieces(made):
    written = {t for i, t in enumerate(made.b_bytes) if not made.b.is_byte(i)}
    for i, other in enumerate(made.same.tolist()):
        if other >= 0:
            assert made.a_bytes[i] == made.b_bytes[other]
            assert not made.b.is_byte(other) or made.a_bytes[i] not in written
    assert (made.same >= 0).sum() > 10_000


def test_empty_table_and_query(spark, made, tmp_path):
    empty = alignment.align(spark.createDataFrame([], "doc_id long, text string"))
    assert empty.documents.collect() == [] and empty.counts.collect() == []
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = alignment.q_alignment(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    expected, _ = brute(made, TEXTS)
    assert {r["doc_id"]: tuple(r)[1:] for r in got.collect()} == {i: (*e[:6], e[7]) for i, e in enumerate(expected)}
