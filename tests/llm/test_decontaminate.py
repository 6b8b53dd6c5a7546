import random

import numpy as np
import pytest

from eventsieve.llm import decontaminate as D

SF = "/root/testdata/sf0.01"


def slow_prefix(item, text):
    row = list(range(len(item) + 1))
    best = (row[-1], 0)
    for j, w in enumerate(text, 1):
        last, row[0] = row[0], j
        for i, x in enumerate(item, 1):
            last, row[i] = row[i], min(last + (x != w), row[i] + 1, row[i - 1] + 1)
        best = min(best, (row[-1], j))
    return best


def test_bit_parallel_distance_against_dynamic_programming():
    rng = random.Random(5)
    for _ in range(400):
        item = rng.choices("abcd", k=rng.randint(1, 70))
        text = rng.choices("abcd", k=rng.randint(0, 80))
        assert D.best_prefix(item, text) == slow_prefix(item, text)


def test_whole_documents_hold_what_a_plain_search_finds(spark):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    got = {(r.doc_id, r.item_id): r for r in D.find_contamination(docs, bench).collect()}
    items = bench.collect()
    exact = {(d.doc_id, i.item_id) for d in docs.collect() for i in items if i.text.lower() in d.text.lower()}
    assert exact and exact <= got.keys()
    assert all(got[k].edits == 0 and got[k].similarity == 1 for k in exact)


def test_edited_passages_and_clean_documents(spark):
    rng = random.Random(9)
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    vocabulary = [w for r in spark.read.parquet(f"{SF}/documents.parquet").limit(100).collect() for w in r.text.split()]
    rows, expected = [], {}
    for n in range(300):
        item = rng.choice(items)
        words = item.text.split()
        allowed = int(D.edits_allowed(len(words)))
        over = n % 3 == 0
        for _ in range(2 * allowed + 6 if over else rng.randint(0, allowed)):
            at = rng.randrange(len(words))
            words[at : at + 1] = rng.choice([[rng.choice(vocabulary)], [words[at], rng.choice(vocabulary)], []])
        rows.append((n, " ".join(rng.choices(vocabulary, k=60) + words + rng.choices(vocabulary, k=rng.choice([0, 60])))))
        if not over:
            expected[n] = item.item_id
    got = D.find_contamination(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items)).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    assert np.mean([(n, i) in found for n, i in expected.items()]) >= 0.95
    text, size = dict(rows), {i.item_id: i.text for i in items}
    for r in got:  # every hit is verified: brute force over all windows finds the same distance
        words, item = D_words(text[r.doc_id]), D_words(size[r.item_id])
        assert r.edits == min(slow_prefix(item, words[s : s + 2 * len(item)])[0] for s in range(len(words)))
        assert r.edits <= D.edits_allowed(len(item)) and r.n_words == len(item)


def D_words(text):
    data = np.frombuffer(("\n" + text.lower()).encode(), np.uint8)
    return [data[a:b].tobytes() for a, b in zip(*D._spans(data), strict=True)]


def test_edges(spark):
    docs = spark.createDataFrame(
        [(1, None, 1), (2, "", 1), (3, "Alpha beta, GAMMA delta!", 1), (3, "Alpha beta, GAMMA delta!", 1), (4, "été NAÏVE " * 30000 + "one two three four five", 1), (None, "alpha beta gamma delta", 1)],
        "doc_id long, text string, item_id int",
    )
    bench = spark.createDataFrame(
        [(10, None, "x"), (11, "", "x"), (12, "alpha beta gamma delta", "x"), (13, "alpha beta gamma delta", "x"), (14, "...", "x"), (15, "One two three four five", "x"), (16, "alpha beta gamma", "x"), (17, "alpha beta gamma omega", "x")],
        "item_id long, text string, doc_id string",
    )
    got = sorted(((r.doc_id or 0), r.item_id, r.edits) for r in D.find_contamination(docs, bench).collect())
    assert got == [(0, 12, 0), (0, 13, 0), (0, 16, 0), (3, 12, 0), (3, 12, 0), (3, 13, 0), (3, 13, 0), (3, 16, 0), (3, 16, 0), (4, 15, 0)]
    assert D.find_contamination(docs.limit(0), bench).collect() == []
    assert D.find_contamination(docs, bench.limit(0)).collect() == []


@pytest.mark.parametrize("limit", [1, 7])
def test_blocks_of_items_give_the_same(spark, monkeypatch, limit):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet").limit(12)
    whole = {(r.doc_id, r.item_id, r.edits) for r in D.find_contamination(docs, bench).collect()}
    monkeypatch.setattr(D, "BLOCK_ITEMS", limit)
    assert {(r.doc_id, r.item_id, r.edits) for r in D.find_contamination(docs, bench).collect()} == whole


def test_best_window_against_all_windows():
    rng = random.Random(6)
    for _ in range(300):
        item = rng.choices("abcd", k=rng.randint(1, 30))
        text = rng.choices("abcd", k=rng.randint(0, 40))
        edits, first, end = D.best_window(item, text)
        slow = [(e, s, s + n) for s in range(len(text)) for e, n in [slow_prefix(item, text[s:])] if n]
        assert edits == min([len(item), *(e for e, _, _ in slow)])
        if edits < len(item):
            assert (edits, first, end) == min(slow)


@pytest.mark.parametrize("size", [500, 1000])
def test_long_items_at_the_most_edits(size):
    rng = random.Random(size)
    words = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choices(words, k=size))) for i in range(5)]
    index = D.Index(items)
    assert min(group.recall for group in index.classes) >= D.TARGET_RECALL
    rows, places = [], []
    for n in range(40):
        copy = items[n % 5][1].split()
        for _ in range(size // 5):
            at = rng.randrange(len(copy))
            copy[at : at + 1] = rng.choice([[rng.choice(words)], [copy[at], rng.choice(words)], []])
        rows.append("\n" + " ".join(rng.choices(words, k=80) + copy + rng.choices(words, k=rng.choice([0, 80]))))
        places.append((n, n % 5))
    got = index.hits(D.pa.array(rows))
    assert np.mean([p in {h[:2] for h in got} for p in places]) >= D.TARGET_RECALL
    assert {h[:2] for h in got} <= set(places) and all(h[2] <= size // 5 for h in got)


def test_a_size_below_the_promised_recall_is_an_error(monkeypatch):
    monkeypatch.setattr(D, "MAX_WALKS", 0)
    with pytest.raises(RuntimeError, match="below"):
        D.Index([(0, " ".join(f"w{i}" for i in range(50)))])


@pytest.mark.parametrize("size", [5, 7, 15, 25, 100, 500])
@pytest.mark.parametrize("where", ["first", "middle", "last", "any"])
def test_copies_with_outside_words_are_met(size, where):
    """The most edits allowed, one of them an outside word at the first, the middle or the last place; outside words around."""
    rng = random.Random(size)
    words = [f"w{i}" for i in range(2000)]
    items = [(i, " ".join(rng.choices(words, k=size))) for i in range(8)]
    index = D.Index(items)
    copies = 400 if size < 500 else 40
    rows, places = [], []
    for n in range(copies):
        copy = items[n % 8][1].split()
        for e in range(size // 5):
            at = rng.randrange(len(copy))
            if e == 0 and where != "any":
                at = {"first": 0, "middle": len(copy) // 2, "last": len(copy) - 1}[where]
                copy[at] = f"out{n}"
            else:
                copy[at : at + 1] = rng.choice([[f"x{rng.randrange(10**9)}"], [copy[at], rng.choice(words)], [], [rng.choice(words)]])
        rows.append("\n" + " ".join([f"y{i}" for i in range(20)] + copy + rng.choices(words, k=20)))
        places.append((n, n % 8))
    got = {h[:2] for h in index.hits(D.pa.array(rows))}
    assert np.mean([p in got for p in places]) >= D.TARGET_RECALL


def test_words_filter_loses_no_match():
    """Every pair that the exact check accepts passes the counts of words ahead of it."""
    rng = random.Random(2)
    words = [f"w{i}" for i in range(30)]  # few words: repeats everywhere
    items = [(i, " ".join(rng.choices(words, k=10 + i % 5))) for i in range(20)]
    index = D.Index(items)
    rows = ["\n" + " ".join(rng.choices(words, k=400)) for _ in range(20)] + ["\n" + " ".join(t for _, t in items)]
    got = {h[:3] for h in index.hits(D.pa.array(rows))}
    index_all = D.Index(items)
    for group in index_all.classes:
        group._may_match = lambda words, stop_of, starts, item: (starts, item)
        group.holds = lambda item, text: True
    assert {h[:3] for h in index_all.hits(D.pa.array(rows))} == got and len(got) >= 20
