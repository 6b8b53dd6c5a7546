import hashlib
import math
import re
from fractions import Fraction

import duckdb
import pytest

from eventsieve.llm import mixing as M


def brute(rows):
    """Targets by repeated cutting and resharing, copies by one exact running sum per source."""
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sources = sorted({s for _, _, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    total = {s: sum(size(t) for _, t, x in rows if x == s) for s in sources}
    target, cut = {}, set()
    while True:
        rest = sum(total.values()) - 3 * sum(total[s] for s in cut)
        open_ = sum(w for s, w in weight.items() if s not in cut)
        target = {s: Fraction(3 * total[s]) if s in cut else Fraction(weight[s] * rest, open_) for s in sources}
        above = {s for s in sources if target[s] > 3 * total[s]}
        if not above:
            break
        cut |= above
    out = {}
    for s in sources:
        shift = int(hashlib.md5(((s if s is not None else "\0") + "|42").encode()).hexdigest()[:8], 16) / 2**32
        each = float(target[s]) / total[s] if total[s] else 0.0
        for r, (i, t) in enumerate(sorted(((i, t) for i, t, x in rows if x == s), key=lambda p: (size(p[1]), p[0]))):
            n = min(3, math.floor((r + 1) * each + shift) - math.floor(r * each + shift))
            out[i] = (size(t), total[s], float(target[s]), n * size(t))
    return out


def run(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = M.mix_sources(docs).collect()
    return {r.doc_id: (r["size"], r.source_size, r.target, r.taken) for r in got}


def words(n):
    return " ".join(["w"] * n)


CASES = {
    "hot_source": [(i, words(1 + i % 7), "a" if i % 3 else f"s{i % 11}") for i in range(400)],
    "cut_small_sources": [(i, words(50), "z") for i in range(200)] + [(500, words(3), "a"), (501, words(5), "b"), (502, words(9), None), (503, words(1), "é")],
    "nulls_empty_ties": [(1, None, "a"), (2, "", "a"), (3, " \n", None), (4, "x y z", None), (5, "one", "Z"), (6, "two", "Z"), (7, words(20000), "long")],
    "no_words": [(1, None, "a"), (2, "", None)],
}


@pytest.mark.parametrize("name", CASES)
def test_against_brute_force_and_sql(spark, name):
    rows = CASES[name]
    expected = brute(rows)
    got = run(spark, rows)
    assert got.keys() == expected.keys()
    for i, e in expected.items():
        assert got[i][:2] == e[:2] and got[i][3] == e[3] and got[i][2] == pytest.approx(e[2], rel=1e-12)
        assert got[i][3] <= 3 * got[i][0]
    assert run(spark, rows) == got
    with duckdb.connect() as con:
        con.execute("create table documents(doc_id bigint, text varchar, source varchar)")
        con.executemany("insert into documents values (?,?,?)", rows)
        assert {r[0]: tuple(r[1:]) for r in con.sql(M.ORACLE_SQL).fetchall()} == got


def test_taken_words_come_near_targets(spark):
    sf = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = M.mix_sources(sf).collect()
    for s in {r.source for r in rows}:
        own = [r for r in rows if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r["size"] for r in own)


def test_empty_table_and_clashing_columns(spark):
    schema = "doc_id long, text string, source string, at long, part int, first long, target string, n int"
    assert M.mix_sources(spark.createDataFrame([], schema)).collect() == []
    got = M.mix_sources(spark.createDataFrame([(1, "a b", "s", 1, 2, 3, "t", 4)] * 2, schema)).collect()
    assert sorted(r.taken for r in got) == [2, 2]
