import numpy as np
import pytest

from eventsieve.llm import tokens as T
from eventsieve.session import shared_path


def test_documents_against_direct_counts(spark):
    encode = T.encoder(T.read_ranks(T.public_vocabulary())).encode_ordinary
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r.n_tokens for r in T.q_tokens(spark, "/root/testdata/sf0.001").collect()}
    assert got == {r.doc_id: len(encode(r.text)) for r in docs.collect()}


@pytest.mark.parametrize("block", [1, 2, 3, 7, 64, 1 << 19])
def test_blocks_stitch_documents_of_any_length(spark, tmp_path, block):
    rng = np.random.default_rng(block)
    expected = []
    for f in range(4):
        docs = [rng.integers(0, T.SEPARATOR, rng.choice([0, 0, 1, 2, 5, 9, 40])).tolist() for _ in range(30)]
        flat, begin = [], 0
        for d in docs:
            expected.append((f, begin, len(d)))
            flat += [*d, T.SEPARATOR]
            begin = len(flat)
        if f % 2:  # a last document without separator
            flat += [1, 2, 3]
            expected.append((f, begin, 3))
        (tmp_path / f"part-{f}").write_bytes(np.array(flat, "<u2").tobytes())
    (tmp_path / "part-9").write_bytes(b"")
    got = T.scan_files(spark, str(tmp_path), header=False, block_tokens=block).collect()
    assert sorted((int(r.file[-1]), r.begin, r.n_tokens) for r in got) == expected


@pytest.mark.parametrize("block", [1, 4, 6, 1000])
def test_headers_across_blocks(spark, block):
    ids = [0, -1, 50256, 2**63 - 1, -(2**63), 12345678901, None, 7, 7]
    rows = [(i, ["", "a b c", None, "été " * 50][k % 4]) for k, i in enumerate(ids)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' file", "1 block", "2 tokens")
    path = shared_path(spark, "t")
    T.write_files(docs, path)
    encode = T.encoder(T.read_ranks(T.public_vocabulary())).encode_ordinary
    got = T.scan_files(spark, path, block_tokens=block).collect()
    assert sorted(str((r.doc_id, r.n_tokens)) for r in got) == sorted(str((i, len(encode(t or "")))) for i, t in rows)


def test_long_texts_empty_table_and_bad_files(spark, tmp_path):
    docs = spark.createDataFrame([(1, "word " * 300000), (2, "x" * 100000), (3, "<|endoftext|>")], "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in T.count_tokens(docs).collect()}
    assert got[1] >= 300000 and got[2] > 0 and got[3] > 1
    assert T.count_tokens(docs.limit(0)).collect() == []
    (tmp_path / "part-0").write_bytes(b"abc")
    with pytest.raises(Exception, match="half a token"):
        T.scan_files(spark, str(tmp_path)).collect()
