import numpy as np
import pytest

from eventsieve.llm import embeddings as E

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    def fine(v):
        return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)

    links, up = {i: 0 for i, _, _ in rows}, {i: i for i, _, _ in rows}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    good = [(i, np.array(v, np.float32).astype(float), y) for i, v, y in rows if fine(v) and y is not None]
    for a in range(len(good)):
        for b in range(a):
            (i, x, p), (j, y, q) = good[a], good[b]
            if p == q and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                links[i] += 1
                links[j] += 1
                r, s = root(i), root(j)
                up[max(r, s)] = min(r, s)
    return {i: (links[i], root(i), root(i) == i) for i, _, _ in rows}


def run(spark, rows):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in E.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_table_against_all_pairs(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in table.select("vec_id", "embedding", "label").collect()]
    expected = brute(rows)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in E.q_embeddings(spark, "/root/testdata/sf0.01").collect()}
    assert got.keys() == expected.keys()
    assert all(got[i][0] <= expected[i][0] for i in got)  # no link below the bound, none counted twice
    assert sum(v[0] for v in got.values()) >= 0.95 * sum(v[0] for v in expected.values())
    assert np.mean([got[i] == expected[i] for i in got]) >= 0.97


@pytest.mark.parametrize("block", [8, 2048])
def test_planted_neighbours_and_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(E, "BLOCK", block)
    rng = np.random.default_rng(2)
    rows, n = [], 0
    for label in range(2):
        for _ in range(12):
            centre = rng.normal(size=16)
            for _ in range(10):
                noise = rng.normal(size=16)
                rows.append((n, (centre + 0.02 * noise).tolist(), label))
                n += 1
    rows += [(n + i, rows[0][1], 0) for i in range(30)]
    got, expected = run(spark, rows), brute(rows)
    assert all(got[i][0] <= expected[i][0] for i in got)
    assert np.mean([got[i] == expected[i] for i in got]) >= 0.97


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1), (7, [1.0, 1.0], None), (8, [1.0, 1.0], None),
            (9, [1.0, 1.0], 2), (10, [1.0, 1.0], 2), (11, [2.0, 2.0], 2), (12, [1.0, 1.0], 3), (13, [1.0, 1.0, 0.0], 2), (14, [-1.0, -1.0], 2)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == {}
    extra = spark.createDataFrame([(1, [1.0, 0.0], 1, 5, 6)] * 2 + [(None, [1.0, 0.0], 1, 5, 6)], SCHEMA + ", rep int, key int")
    assert sorted(str((r.vec_id, r.n_links, r.component_id)) for r in E.near_vectors(extra).collect()) == ["(1, 2, 1)", "(1, 2, 1)", "(None, 2, 1)"]
