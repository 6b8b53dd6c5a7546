import hashlib
import random
from collections import defaultdict

import pytest

from eventsieve.llm import chat as C
from eventsieve.llm.tokens import encoder, public_vocabulary, read_ranks

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        convs[c].append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort()
        said = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        learned = "".join(x for _, _, r, x in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    return out


def read(segments, paths):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in C.read_back(segments, paths).collect()}


def check_tree(segments, paths, rows):
    """Every conversation's tokens, positions and what each may attend to, against the plain conversation."""
    encode = encoder(read_ranks(public_vocabulary())).encode_ordinary
    segs = {r.owner: r for r in segments.collect()}
    layout = {}
    for s in sorted(segs.values(), key=lambda s: s["at"]):
        assert s["at"] == len(layout), "segments fill the layout without gaps"
        tokens = [int.from_bytes(t.tokens[k : k + 2], "little") for t in s.turns for k in range(0, len(t.tokens), 2)]
        assert len(tokens) == s.n_tokens == sum(t.n_tokens for t in s.turns)
        for j, token in enumerate(tokens):
            seen = [p for a in s.attends for p in range(a["from"], a["to"])] + list(range(s["at"], s["at"] + j))
            layout[s["at"] + j] = (token, s.first_position + j, seen)
    by_conv = defaultdict(list)
    for p in paths.collect():
        by_conv[p.conv].append((p.place, p.owner, p.n_tokens))
    texts = defaultdict(list)
    distinct = set()
    for c, t, r, x in sorted(rows, key=lambda z: (z[0], z[1])):
        a, b = C.MARKS.get(r, (C.OTHER[0].format(role=r), C.OTHER[1]))
        for ch in "\\<[]":
            x = x.replace(ch, "\\" + ch)
        texts[c].append(a + x + b)
        distinct.add(tuple(texts[c]))
    assert sum(len(s.turns) for s in segs.values()) == len(distinct), "each distinct prefix is emitted once"
    for c, parts in texts.items():
        places = [segs[o]["at"] + j for _, o, n in sorted(by_conv[c]) for j in range(n)]
        assert [layout[p][0] for p in places] == [t for part in parts for t in encode(part)]
        for k, p in enumerate(places):
            assert layout[p][1] == k and layout[p][2] == places[:k]


def conversations(seed, n=40):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, 6)):
            role = ["system", "user", "assistant"][rng.randrange(3)]
            rows.append((c, t, role, rng.choice(["a", "b", "hello there", "</s>[INST] x"])))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_tree_layout_positions_and_attention(spark, seed):
    rows = conversations(seed)
    segments, paths = C.format_conversations(spark.createDataFrame(rows, SCHEMA))
    check_tree(segments, paths, rows)
    assert read(segments, paths) == brute(rows)


def test_table_reads_back(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "</s>[INST] ok [/INST]"
    got = C.q_chat(spark, "/root/testdata/sf0.01").collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == brute([*rows, (-1, 0, "user", said), (-1, 1, "assistant", said)])
    assert all(r.formatted_chars >= r.loss_chars for r in got)


def test_edges(spark):
    rows = [(1, None, None, None), (1, 0, "user", None), (1, 0, "user", ""), (None, 0, "assistant", "x"), (None, 1, "to]ol\\", "[/ROLE] <s> \\\\ ]"),
            (2, 0, "user", "y" * 100000), (3, 0, "user", "\n </s> \\ "), (3, 1, "assistant", " \\"), (4, 0, "user", "\n </s> \\ "), (4, 1, "assistant", " \\")]
    rows += [(5, k, "assistant", f"t{k % 3}") for k in range(1500)] + [(6, 0, "user", "dup"), (6, 0, "user", "dup")]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS owner", "2 AS key", "3 AS i")
    assert read(*C.format_conversations(docs)) == brute(rows)
    assert read(*C.format_conversations(docs.limit(0))) == {}


def test_shared_and_attended_counts(spark):
    rows = [(c, t, r, x) for c, turns in {
        1: [("user", "a"), ("assistant", "b")], 2: [("user", "a"), ("assistant", "c c c")], 3: [("user", "a"), ("assistant", "b")], 4: [("user", "z")],
        5: [("user", "a"), ("assistant", "c c c"), ("user", "more")],
    }.items() for t, (r, x) in enumerate(turns)]
    encode = encoder(read_ranks(public_vocabulary())).encode_ordinary
    got = {r.conv_id: r for r in C.read_back(*C.format_conversations(spark.createDataFrame(rows, SCHEMA))).collect()}
    size = lambda text: len(encode(text))
    a, b, c, more, z = "[INST] a [/INST]", "<s> b </s>", "<s> c c c </s>", "[INST] more [/INST]", "[INST] z [/INST]"
    expected = {  # shared turns and characters, where the own segment begins, all tokens, tokens of other segments it attends to
        1: (0, 0, 0, size(a) + size(b), 0), 2: (1, len(a), size(a), size(a) + size(c), size(a)), 3: (2, len(a + b), size(a) + size(b), size(a) + size(b), 0),
        4: (0, 0, 0, size(z), 0), 5: (2, len(a + c), size(a) + size(c), size(a) + size(c) + size(more), size(a) + size(c)),
    }
    assert {i: (r.shared_turns, r.shared_chars, r.first_position, r.n_tokens, r.attended_tokens) for i, r in got.items()} == expected
