"""Packing: exact round trip of all tokens, best fit against a linear search, bounded padding."""

import functools
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

np = pytest.importorskip("numpy")
pa = pytest.importorskip("pyarrow")
pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")

from eventsieve.llm import packing, vocabularies  # noqa: E402


def plain_best_fit(items, window):
    filled = []
    for item in sorted(items, key=lambda p: -p[2]):
        rooms = [(window - sum(p[2] for p in w), i) for i, w in enumerate(filled)]
        fits = [r for r in rooms if r[0] >= item[2]]
        if fits:
            filled[min(fits)[1]].append(item)
        else:
            filled.append([item])
    return filled


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=60))
def test_best_fit_matches_a_linear_search(lengths):
    items = [(i, 0, n) for i, n in enumerate(lengths)]
    got, expected = packing.best_fit(items, 32), plain_best_fit(items, 32)
    # Which of two windows with equal room takes an item is open; the rooms left are not.
    assert sorted(sum(p[2] for p in w) for w in got) == sorted(sum(p[2] for p in w) for w in expected)
    assert sorted(p for w in got for p in w) == sorted(items)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=40), st.integers(0, 8))
def test_closing_windows_keeps_every_token(lengths, tolerance):
    closed, rest = packing.topped_up(packing.best_fit([(i, 0, n) for i, n in enumerate(lengths)], 64), 64, tolerance)
    tail = packing.at_powers_of_two(rest, 64, tolerance)
    for w in closed:
        assert 64 - tolerance <= sum(p[2] for p in w) <= 64
    for w in tail:
        total = sum(p[2] for p in w)
        assert total & (total - 1) == 0 or 64 - total <= tolerance
    tokens = sorted((d, at) for w in closed + tail for d, start, n in w for at in range(start, start + n))
    assert tokens == [(d, at) for d, n in enumerate(lengths) for at in range(n)]


TEXTS = [
    "It's  been 3 days,\nsaid Zoë ... ok. Then x's, y.z \t and so on; no more 12,345 <|endoftext|> words. ", "", " ", "a", " a", "a ", "a b", "a  b c", "a. b, c; d", "1 2 3 x",
    "naïve café 東京 x 🙂 y", "tabs\tand lines\r\n and", "it's we'll I'd", "ends with space ", " <|endoftext|> a", "x" * 500, "a b" * 100, "end.\n\nNext, one\nTwo\n\n\nThree.\nFour ,\n five.\n\n", "e.g. x.y,z\n", "a\n\n b\n\n1\n\né", "\u00a0 b \u2028 c",
]


def same_ids(tokenizer, texts):
    encode = vocabularies.TextEncoder(tokenizer)
    column = pa.array(texts, pa.string())
    expected = [tokenizer.made.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in encode(column)] == expected
    assert [x.tolist() for x in encode.by_chunks(column)] == expected
    assert tokenizer.encode([t.encode() for t in texts]) == expected


@pytest.mark.parametrize("plain", [False, True])
def test_encoding_in_parts_is_encoding_whole_texts(plain, monkeypatch):
    monkeypatch.setattr(vocabularies, "BATCH_BYTES", 300)
    made = vocabularies.ByteLevel(vocabularies.read_file(vocabularies.public_file("byte_bpe_50k.json")), plain)
    assert made.quick is not None and not made.is_plain("東".encode()) and made.is_plain("Zoë".encode()) and made.is_plain(b"<|endoftext|>") == plain
    for texts in (TEXTS, TEXTS[::-1], ["".join(TEXTS)] * 3, [""]):
        same_ids(made, texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab .,'s1\n\té東<\u027f\u0280\u01c5\u00aa\u00b2", max_size=40), min_size=1, max_size=5))
def test_encoding_in_parts_on_any_text(texts):
    same_ids(tokenizer(), texts)


def test_both_libraries_class_the_plain_characters_alike():
    made = tokenizer()
    for c in map(chr, range(0x280)):
        for t in (c, f"a{c}b", f" {c} ", f"{c}{c}1{c}", f"'{c}s.{c}"):
            assert made.quick.encode_ordinary(t) == made.made.encode(t, add_special_tokens=False).ids, hex(ord(c))


def test_other_vocabularies_are_read_by_their_library_alone():
    assert vocabularies.ByteLevel(vocabularies.read_file(vocabularies.public_file("word_bpe_49k.json"))).quick is None


def test_memo_forgets_and_stays_right(monkeypatch):
    monkeypatch.setattr(vocabularies, "REMEMBERED", 3)
    memo = vocabularies.Memo(lambda texts: [[len(t)] for t in texts])
    for n in range(1, 8):
        assert memo([b"x" * i for i in range(n)]) == [[i] for i in range(n)]
        assert len(memo.known) <= 3


def test_chunks_with_equal_hashes_stay_apart():
    class Flat:
        def __call__(self, data, starts, ends, which=0):
            return np.zeros(len(starts), np.uint64) if which == 0 else (ends - starts).astype(np.uint64)

    chunks = vocabularies.Chunks(Flat(), pa.array(["a bb ccc bb"]))
    assert [chunks.texts[i] for i in chunks.chunk] == [b"a", b" bb", b" ccc", b" bb"]


@functools.cache
def tokenizer():
    return vocabularies.ByteLevel(vocabularies.read_file(vocabularies.public_file("byte_bpe_50k.json")))


def check(rows, texts):
    """All tokens once, sequences gapless, within the window and hardly padded; ``texts`` is a list of (id, text)."""
    made = tokenizer()
    by_row, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_row[r["row_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    found = []
    for own in by_row.values():
        own.sort(key=lambda r: r["start"])
        ids = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in own])
        ends = np.cumsum([r["length"] for r in own])
        assert [r["start"] for r in own] == [0, *ends[:-1]] and {r["doc_tokens"] for r in own} == {len(ids)}
        found.append((str(own[0]["doc_id"]), ids.tolist()))
    assert sorted(found) == sorted((str(i), [*made.made.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in texts)
    padding = total = 0
    for own in by_sequence.values():
        own.sort(key=lambda r: r["offset"])
        ends = np.cumsum([r["length"] for r in own])
        assert [r["offset"] for r in own] == [0, *ends[:-1]] and ends[-1] <= 2048
        total += int(ends[-1])
        padding += 0 if int(ends[-1]).bit_count() == 1 else 2048 - int(ends[-1])
    assert padding <= 8 * len(by_sequence)
    return padding, total


def test_round_trip_on_edge_cases(spark):
    texts = [(i, f"word{i} and others, " * (i % 37)) for i in range(300)]
    texts += [(1, None), (1, ""), (None, "no id"), (None, "no id"), (7, "same"), (7, "same"), (8, "x" * 9000), (9, "a long one. " * 20_000), (10, " \n")]
    docs = spark.createDataFrame([(i, t, 5, 6) for i, t in texts], "doc_id long, text string, start int, sequence_id int").repartition(3)
    packed = packing.pack_documents(docs).cache()
    check(packed.collect(), texts)
    whole = {r["sequence_id"]: r for r in packing.padded_sequences(packed).collect()}
    assert sum(r["n_tokens"] for r in whole.values()) == sum(r["length"] for r in packed.collect())
    for r in whole.values():
        assert len(r["ids"]) == 4 * (r["n_tokens"] if int(r["n_tokens"]).bit_count() == 1 else 2048)
    first = packed.filter("offset = 0").first()
    assert bytes(whole[first["sequence_id"]]["ids"]).startswith(bytes(first["ids"]))
    packed.unpersist()


def test_rounds_carry_open_windows(spark, monkeypatch):
    monkeypatch.setattr(packing, "ROUND_TOKENS", 3000)
    monkeypatch.setattr(packing, "pieces", lambda batches, at: (b.slice(i, 1) for b in batches for i in range(b.num_rows)))
    packer = packing.Packer(2048, 8)
    out = []
    for i in range(50):
        packer.add(i, np.full(700 + 13 * i, i, np.uint32))
        if packer.held >= 3000:
            out += packer.sequences(False)
            packer.forget()
            assert packer.held < 3000
    out += packer.sequences(True)
    assert sorted((d, at) for w in out for d, start, n in w for at in range(start, start + n)) == [(i, at) for i in range(50) for at in range(700 + 13 * i)]


def test_empty_table_and_parameters(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(empty).collect() == []
    with pytest.raises(ValueError):
        packing.pack_documents(empty, window=1000)


def test_query_gives_the_digests(spark, tmp_path):
    texts = [(i, f"text {i} " * i) for i in range(120)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = packing.q_packing(spark, str(tmp_path)).collect()
    made = tokenizer()
    ids = {i: [*made.made.encode(t, add_special_tokens=False).ids, 1] for i, t in texts}
    assert sum(r["length"] for r in got) == sum(map(len, ids.values()))
    for r in got:
        own = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes()) and r["doc_tokens"] == len(ids[r["doc_id"]])
