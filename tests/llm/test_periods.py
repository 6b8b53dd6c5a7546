"""Periodic runs against a plain search over all periods."""

import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

np = pytest.importorskip("numpy")

from eventsieve.llm import periods  # noqa: E402

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(w):
    n, found = len(w), {}
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            length = j - i + p
            if j > i and length >= max(6, 4 * p):
                if not any(all(w[x] == w[x + q] for x in range(i, i + length - q)) for q in range(1, p)):
                    found[i, p] = length
            i = j + 1
    return [(i, length, p) for (i, p), length in sorted(found.items())]


def factors_of(texts):
    words = [t for text in texts for t in text]
    ids = np.array([hash(t) & 0xFFFFFFFF for t in words], np.uint64)
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts]).astype(np.int64)
    return periods.Factors(ids, ids, doc)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=60), max_size=4))
def test_small_alphabets_match_the_plain_search(texts):
    start, length, period = factors_of(texts).runs()
    got, base = list(zip(start.tolist(), length.tolist(), period.tolist(), strict=True)), 0
    expected = []
    for t in texts:
        expected += [(base + s, n, p) for s, n, p in plain_runs(t)]
        base += len(t)
    assert got == expected


def test_nested_periods_match_the_plain_search():
    rng = random.Random(3)
    for _ in range(150):
        block = [rng.choice("ab") for _ in range(rng.randint(1, 6))]
        for _ in range(3):
            block = block * rng.randint(1, 5) + [rng.choice("abcd") for _ in range(rng.randint(0, 3))]
        block = block[:400]
        assert list(zip(*(x.tolist() for x in factors_of([block]).runs()), strict=True)) == plain_runs(block)


def collapsed(w, runs):
    drop = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in drop)


def test_operator_on_edge_cases(spark):
    long_text = "ab cd " * 150_000 + "end"
    rows = [(1, "a a a a a a b"), (2, None), (3, ""), (4, " \t\n"), (5, "x y x y x y x y"), (None, "é é é é é é"),
            (5, "x y x y x y x y"), (7, "a a a a a"), (8, "           "), (9, long_text),
            (10, "A a A a A a A a"), (11, "a a a"), (12, "a a a")]
    docs = spark.createDataFrame([(i, t, 1, [2]) for i, t in rows], "doc_id long, text string, n_words int, runs array<int>").repartition(2)
    got = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periods.periodic_runs(docs).collect()), key=str)
    expected = []
    for i, t in rows:
        w = WORDS.findall(t or "")
        runs = plain_runs(w) if len(w) < 100 else [(0, 300_000, 2)]
        expected.append((i, len(w), runs, collapsed(w, runs)))
    assert got == sorted(expected, key=str)


def test_empty_table(spark):
    assert periods.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_matches_brute_force(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["aa", "b", "c", "dé", "e", "f"]) for _ in range(rng.randint(0, 60)))) for i in range(400)]
    rows += [(1000, None), (1001, ""), (1002, "  \n"), (1003, "one")] + [(2000 + i, "word " * i) for i in range(30)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in periods.q_periods(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    periodic = 0
    for i, t in rows:
        w = WORDS.findall(t or "")
        n, h = len(w), zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        runs = plain_runs(w)
        periodic += bool(runs)
        r = got[i]
        assert r["n_runs"] == len(runs)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        assert r["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed(w, runs).encode()).hexdigest()
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        mine = None if best is None else (*best, 1000 * best[1] // best[2])
        assert (None if r["start"] is None else (r["start"], r["length"], r["period"], r["exponent_milli"])) == mine
    assert periodic > 40
