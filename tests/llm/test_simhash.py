import itertools
import re

import numpy as np
import pytest
import xxhash

from eventsieve.llm import simhash as S
from eventsieve.llm.components import connected_components

SMALL = "/root/testdata/sf0.001"


def slow_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps, max_bits=3):
    ids = list(fps)
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in itertools.combinations(ids, 2):
        if (fps[a] ^ fps[b]).bit_count() <= max_bits:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in S.simhash_components(docs).collect()}
    fps = {i: slow_fingerprint(t) for i, t in rows}
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{f:016x}" for i, f in fps.items()}
    assert {i: r.component_id for i, r in got.items()} == slow_components(fps)


def test_documents_against_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    check(spark, rows)


def test_nulls_empty_short_long_and_repeats(spark):
    words = "alpha beta Gamma delta été Ünder naïve x y zeta".split(" ")
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, " ".join(words * 3000)),
            (8, "\x0bone\x0c"), (9, "a b c d"), (10, "İı ſ K q")]
    check(spark, rows)


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, fp string, rep int, component long")
    assert S.simhash_components(empty).collect() == []
    one = spark.createDataFrame([(3, "a b c d", "x", 1, 9), (3, "a b c d", "y", None, 8), (None, "a b c d", "z", 2, 7)], empty.schema)
    assert sorted(str(r.component_id) for r in S.simhash_components(one).collect()) == ["3", "3", "3"]


@pytest.mark.parametrize("n,near", [(300, 300), (3000, 40)])
def test_planted_neighbours_in_large_buckets(n, near):
    rng = np.random.default_rng(n)
    base = rng.integers(0, 1 << 63, dtype=np.uint64)
    masks = [sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 9), replace=False)) for _ in range(n)]
    fp = np.unique(np.array([int(base) ^ m for m in masks], np.uint64))
    rep = rng.permutation(len(fp)).astype(np.int64)
    a, b = S.bucket_links(fp, rep, 3)
    expected = slow_components(dict(zip(rep.tolist(), fp.tolist(), strict=True)))
    got = {int(r): int(r) for r in rep}
    got.update(zip(a.tolist(), b.tolist(), strict=True))
    assert got == expected


def test_segment_counts_bound_the_distance_and_the_grid_misses_none():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, 3, replace=False)) for _ in x], np.uint64)
    y = x ^ flips
    ex, ey = S.segment_counts(x), S.segment_counts(y)
    assert (S.manhattan(ex, ey) <= 3).all()
    counts = lambda e: np.stack([(e >> np.uint64(2 * k)) & np.uint64(3) for k in range(32)]).astype(int)
    z = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
    ez = S.segment_counts(z)
    assert (S.manhattan(ex, ez) == np.abs(counts(ex) - counts(ez)).sum(0)).all()
    assert np.any([(ex & np.uint64(m)) == (ey & np.uint64(m)) for m in S.grid_masks(3)], axis=0).all()


def test_components_of_a_long_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(100, 300)] + [(1000, 2000 + i) for i in range(300)] + [(5, 5), (None, 7)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 301)}, 1000: 1000, **{2000 + i: 1000 for i in range(300)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_hot_nodes_are_joined_apart(spark, monkeypatch):
    import random

    from eventsieve.llm import components

    rng = random.Random(3)
    links = [(0, i) for i in range(1, 400)] + [(500 + i, 900) for i in range(300)] + [(399, 500)] + [(2000 + rng.randrange(60), 2000 + rng.randrange(60)) for _ in range(70)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    expected = {x: root(x) for pair in links for x in pair if pair[0] != pair[1]}
    for least, most in ((2, 10**9), (256, 10_000), (10**9, 10_000)):  # all hot, the hubs alone, none
        monkeypatch.setattr(components, "HOT_DEGREE", least)
        monkeypatch.setattr(components, "MOST_HOT", most)
        got = {r.id: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
        assert got == expected
