import importlib
import math
import random

import pytest

import corpus_pipeline as C
from eventsieve.llm import decontaminate, language, mixing, pii, simhash
from tests.llm.test_decontaminate import slow_prefix, D_words
from tests.llm.test_mixing import brute
from tests.llm.test_simhash import slow_components, slow_fingerprint

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(90001, None, "en", "src1", 0), (90002, "123 456", None, None, 7)], docs.schema)
    docs = docs.unionByName(extra)
    columns = docs.columns
    frames = {}
    for name, stage in C.STAGES:
        before, docs = docs, stage(spark, docs, SF)
        frames[name] = (before.collect(), docs.collect())
        if name != "source_mix":
            assert docs.columns == columns and docs.schema.simpleString() == before.schema.simpleString()

    before, after = frames["language"]
    assert {r.doc_id for r in before} - {r.doc_id for r in after} == {90001, 90002}
    before, after = frames["simhash_near_dedup"]
    groups = slow_components({r.doc_id: slow_fingerprint(r.text) for r in before})
    assert sorted(r.doc_id for r in after) == sorted(set(groups.values()))
    before, after = frames["benchmark_decontamination"]
    items = [D_words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    dirty = set()
    for r in before:
        words = D_words(r.text)
        for item in items:
            own, allowed = set(item), decontaminate.edits_allowed(len(item))
            at = [w in own for w in words]
            for s in range(len(words)):
                if at[s] and sum(at[s : s + len(item)]) >= len(item) - allowed and slow_prefix(item, words[s : s + 2 * len(item)])[0] <= allowed:
                    dirty.add(r.doc_id)
                    break
    assert dirty and {r.doc_id for r in before} - {r.doc_id for r in after} == dirty
    before, after = frames["personal_data"]
    old = {r.doc_id: r for r in before}
    assert len(after) == len(before) and any("[EMAIL]" in r.text or "[PHONE]" in r.text for r in after)
    for r in after:
        spans = pii.base_spans(old[r.doc_id].text)
        assert not pii.base_spans(r.text) and r.n_chars == len(r.text)
        assert spans or r.text == old[r.doc_id].text
    before, after = frames["source_mix"]
    expected = brute([(r.doc_id, r.text, r.source) for r in before])
    taken = {}
    for r in after:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r["size"]
    assert {i: t for i, t in taken.items() if t} == {i: e[3] for i, e in expected.items() if e[3]}
    texts = {r.doc_id: r.text for r in before}
    assert all(r.text == texts[r.doc_id] for r in after)


def test_run_applies_the_stages_in_order(spark):
    assert [n for n, _ in C.STAGES] == ["language", "simhash_near_dedup", "benchmark_decontamination", "personal_data", "source_mix"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in C.STAGES:
        docs = stage(spark, docs, SF)
    assert sorted(map(str, C.run(spark, SF).collect())) == sorted(map(str, docs.collect()))


def test_empty_and_clashing_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", "1 AS size", "'x' AS target", "2 AS copies", "3 AS fp", "4 AS item_id").limit(0)
    for name, stage in C.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.collect() == [], name


def test_repeated_rows_keep_one(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (2, "a b c d"), (None, "z y x w"), (5, None), (6, "")], "doc_id long, text string")
    got = sorted(str(r.doc_id) for r in simhash.keep_representatives(docs).collect())
    assert got == ["1", "5", "None"]
    assert math.isclose(C.LEAST_SURENESS, 0.7) and importlib.import_module("corpus_pipeline") is C
    assert language and mixing


@pytest.mark.parametrize("rows, kept", [
    ([(3, "A"), (5, "A"), (5, "C")], [(3, "A"), (5, "C")]),
    ([(5, "A"), (5, "C")], [(5, "A"), (5, "C")]),
    ([(5, "A"), (5, "A"), (5, "A")], [(5, "A")]),
    ([(None, "A"), (None, "A"), (2, "A"), (None, "C"), (None, "C")], [(2, "A"), (None, "C")]),
    ([(None, None), (None, ""), (7, None)], [(7, None)]),
    ([], []),
])
def test_rows_are_told_apart_by_place(spark, rows, kept):
    texts = {"A": " ".join(f"alpha{i}" for i in range(40)), "C": " ".join(f"gamma{i}" for i in range(40)), "": "", None: None}
    docs = spark.createDataFrame([(i, texts[t], "x", 1) for i, t in rows], "doc_id long, text string, fp string, component int")
    got = simhash.keep_representatives(docs)
    assert got.columns == docs.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in got.collect()) == sorted((str(i), str(texts[t])) for i, t in kept)


def test_texts_of_several_languages_stay_and_junk_goes(spark):
    rng = random.Random(4)
    rows = language.training_rows(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    model = language.fit([r["text"] for r in rows], [r["lang"] for r in rows])
    by = {}
    for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("lang is not null and length(text) > 200").collect():
        by.setdefault(r.lang, []).append(r.text)
    mixed = [" ".join(" ".join(rng.choice(by[k]).split()[:25]) for k in rng.sample(sorted(by), 3)) for _ in range(200)]
    junk = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(40)) for _ in range(200)]
    clean = [t for own in by.values() for t in own[:100]]
    docs = spark.createDataFrame(list(enumerate(mixed + junk + clean)), "doc_id long, text string")
    kept = {r.doc_id for r in language.keep_identified(docs, model, C.LEAST_SURENESS).select("doc_id").collect()}
    assert len(kept & set(range(200))) >= 198
    assert len(kept & set(range(200, 400))) <= 2
    assert len([i for i in range(400, 400 + len(clean)) if i in kept]) >= 0.995 * len(clean)


def test_run_on_clashing_columns_nulls_and_very_long_texts(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    words = " ".join(r.text for r in docs.filter("lang = 'en'").limit(40).collect()).split()
    long_text = " ".join(random.Random(1).choices(words, k=200_000))
    extra = spark.createDataFrame([(None, None, None, None, None), (None, docs.first().text, "en", None, 3), (70001, long_text, "en", "src1", 1), (70002, long_text, "en", None, 1)], docs.schema)
    whole = docs.unionByName(extra).selectExpr("*", "1 AS size", "'t' AS Target", "2 AS copy", "3 AS row", "4 AS fp", "5 AS item_id", "array(6) AS rep")
    whole.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = C.run(spark, str(tmp_path))
    assert got.columns == [*whole.columns, "size_mix", "target_mix", "copy_mix"]
    rows = got.collect()
    plain = {r.doc_id for r in C.run(spark, SF).collect()}
    assert {r["size"] for r in rows} == {1} and {r["row"] for r in rows} == {3} and {r["Target"] for r in rows} == {"t"}
    assert len({r.doc_id for r in rows} & plain) >= 0.8 * len(plain)
    assert {r.size_mix for r in rows if r.doc_id in (70001, 70002)} <= {200_000}
