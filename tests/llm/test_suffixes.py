import hashlib
import random
from collections import defaultdict

import pytest

from eventsieve.llm import suffixes as S


def brute(texts, length):
    seen = defaultdict(list)
    raw = [(t or "").encode() for t in texts]
    for d, b in enumerate(raw):
        for s in range(len(b) - length + 1):
            seen[b[s : s + length]].append((d, s))
    gone = [bytearray(len(b)) for b in raw]
    for places in seen.values():
        if len(places) > 1:
            for d, s in places:
                gone[d][s : s + length] = b"\1" * length
    out = []
    for b, g in zip(raw, gone, strict=True):
        kept = bytes(x for x, y in zip(b, g, strict=True) if not y)
        spans = sum(1 for i in range(len(g)) if g[i] and (i == 0 or not g[i - 1]))
        out.append((len(b), sum(g), spans, hashlib.sha256(kept).hexdigest()))
    return out


def run(spark, rows, **k):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(((r.doc_id if r.doc_id is not None else -1), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.remove_repeats(docs, **k).collect())


def expected(rows, length):
    return sorted((i if i is not None else -1, *b) for (i, _), b in zip(rows, brute([t for _, t in rows], length), strict=True))


def test_documents_against_all_windows(spark):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.q_suffixes(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert got == {r.doc_id: b for r, b in zip(docs, brute([r.text for r in docs], 200), strict=True)}
    assert sum(v[1] for v in got.values()) > 0


@pytest.mark.parametrize("seed", range(4))
def test_shuffled_passages_near_the_length(spark, monkeypatch, seed):
    monkeypatch.setattr(S, "CONTEXTS_A_CELL", [4000, 1, 2, 5][seed])
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choices("abcdé \n", k=n))
    passages = [word(rng.choice([18, 19, 20, 21, 22, 30, 60])) for _ in range(12)]
    rows = []
    for i in range(150):
        parts = [rng.choice([word(rng.randint(0, 30)), rng.choice(passages), rng.choice(passages)[: rng.randint(1, 40)]]) for _ in range(rng.randint(0, 8))]
        rows.append((i, "".join(parts)))
    rows += [(200, "ab" * 40), (201, "a" * 100), (202, rows[3][1]), (202, rows[3][1])]
    assert run(spark, rows, length=20, gram=8) == expected(rows, 20)


def test_hot_passage_spreads_and_stays_exact(spark):
    rng = random.Random(7)
    hot = "".join(rng.choices("abcdefgh ", k=90))
    rows = []
    for i in range(400):
        at = rng.randrange(len(hot))
        edited = hot[:at] + rng.choice("XYZW") + hot[at + 1 :]
        rows.append((i, edited if i % 2 else "".join(rng.choices("abcdefgh ", k=rng.randint(0, 60))) + hot))
    assert run(spark, rows, length=40, gram=12) == expected(rows, 40)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "x" * 199), (4, "y" * 200), (5, "y" * 200), (None, "z" * 201), (7, "w" * 100000), (7, "q" * 150)]
    assert run(spark, rows) == expected(rows, 200)
    assert run(spark, []) == []
    clash = spark.createDataFrame([(1, "k" * 250, 1, 2, "m")], "doc_id long, text string, f int, r int, _metadata string")
    row = S.remove_repeats(clash).first()
    assert (row.n_bytes, row.n_removed, row.n_spans, row.kept) == (250, 250, 1, b"")
    with pytest.raises(ValueError):
        S.remove_repeats(clash, length=20, gram=15)


def test_leads_that_fill_several_ranges_are_spread_and_stay_exact(spark, monkeypatch):
    rng = random.Random(11)
    hot = "the same opening of forty bytes or more, " + "".join(rng.choices("abcdefgh ", k=60))
    rows = []
    for i in range(300):
        at = rng.randrange(len(hot))
        rows.append((i, "".join(rng.choices("xyz ", k=rng.randint(0, 30))) + hot[: rng.choice([70, len(hot)])] + hot[at:] + rng.choice("PQRS") * 3))

    def repeated(texts, buckets, length, gram):
        got = S.np.unique(real(texts, 17, length, gram))
        return S.np.sort(S.np.repeat(got, 5))

    real = S.sample_splitters
    monkeypatch.setattr(S, "sample_splitters", repeated)
    monkeypatch.setattr(S, "MOST_CELLS", 32)
    spread = S.np.array([5, 5, 5, 9], S.np.uint64)
    leads = S.np.array([4, 5, 5, 5, 6, 9, 10], S.np.uint64)
    assert S.bucket_of(leads, S.np.arange(7).astype(S.np.uint64), spread).tolist() == [0, 1, 2, 0, 3, 3, 4]
    buckets = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    try:
        assert run(spark, rows, length=40, gram=12) == expected(rows, 40)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", buckets)


def test_rows_a_join_or_union_repeats_are_rows_of_their_own(spark, tmp_path):
    spark.createDataFrame([(1, "m" * 30 + "abcdefghij" * 25), (2, "none of it" * 3)], "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    assert S.is_plain_scan(docs.filter("doc_id > 0")) and not S.is_plain_scan(docs.union(docs))
    twice = docs.join(spark.createDataFrame([(1, "x"), (1, "y")], "doc_id long, tag string"), "doc_id")
    for frame in (twice, docs.filter("doc_id = 1").union(docs.filter("doc_id = 1"))):
        assert [(r.n_bytes, r.n_removed) for r in S.remove_repeats(frame).collect()] == [(280, 280)] * 2
