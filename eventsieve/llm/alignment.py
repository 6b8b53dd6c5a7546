"""Alignment of two tokenizers over a corpus: groups of tokens between common byte ends, and pair counts.

``A`` is a byte-level BPE read on a space and the text, ``B`` a piece model
read on the text (it adds the space itself).  Byte offsets where tokens of both
end cut a text into groups; two tokens are linked where their bytes overlap.
A pair's count is the number of its links in the corpus.

Method.  Most groups are one token of each side with the same bytes.  An array
from every id of ``A`` to the id of ``B`` with its bytes is made first; such
groups are recognised by it and counted in a vector of the vocabulary's length,
one per task.  Only the pairs of other groups are counted one by one: a block
of texts lists its distinct pairs once, with their links as places in that
list, and sends the list through the shuffle that sums pairs over the corpus.
The sums come back to the blocks that listed them; the vectors' sums, one row
an id, go to the tasks as arrays.

Texts are cut into chunks at spaces that no token reaches over, so both sides
have an end at every cut: groups and links are found once for each distinct
chunk of a block and weighted by its occurrences.  Blocks are pieces of one
task's texts, stored in the shared folder between the two passes, so texts are
encoded once and a lost task is read again from there.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventsieve.llm.texts import WordHash, frequent_first, packed, pieces, unpacked
from eventsieve.llm.vocabularies import ByteLevel, Chunks, Memo, byte_level_alphabet, in_batches, laid_out, picked, public_file, read_file
from eventsieve.session import materialize, release

BLOCK_BYTES = 2 << 20
TASK_BITS = 32
BLANK_MARK = "▁"


class Vocabularies:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, a: bytes, b: bytes):
        import sentencepiece

        self.made = a, b
        self.a = ByteLevel(a, plain_specials=True)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        made, alphabet = json.loads(a), byte_level_alphabet()
        ids = made["model"]["vocab"] | {t["content"]: t["id"] for t in made.get("added_tokens", [])}
        self.a_bytes = [b""] * (1 + max(ids.values()))
        for token, i in ids.items():
            if all(c in alphabet for c in token):
                self.a_bytes[i] = bytes(alphabet[c] for c in token)
        shown = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK_MARK, " ").encode() for i, p in enumerate(shown)]
        if any(BLANK_MARK in p.lstrip(BLANK_MARK) for p in shown):
            raise ValueError("pieces that go on behind a blank reach over the cuts between chunks")
        # Of two ids with equal bytes the written piece comes before the bare byte.
        of_bytes = {self.b_bytes[i]: i for i in sorted(range(len(shown)), key=lambda i: not self.b.is_byte(i))}
        self.same = np.array([of_bytes.get(t, -1) for t in self.a_bytes], np.int64)
        self.a_length, self.b_length = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self._spelled = [(np.frombuffer(b"".join(t), np.uint8), n) for t, n in ((self.a_bytes, self.a_length), (self.b_bytes, self.b_length))]

    def __reduce__(self):
        return Vocabularies, self.made  # tasks read the files' contents

    def encode(self, texts: list[bytes]) -> list[tuple[bytes, bytes] | None]:
        """The ids of both sides for every text, as 32-bit numbers; None where their bytes are not a space and the text."""
        out = []
        for lo, hi in in_batches(texts):
            spaced = [b" " + t for t in texts[lo:hi]]
            sides = self.a.encode(spaced), self.b.encode([t.decode("utf-8", "surrogatepass") for t in texts[lo:hi]], num_threads=1)
            flat_sides = [laid_out(parts) for parts in sides]
            right = self._spells(spaced, *flat_sides[0], 0) & self._spells(spaced, *flat_sides[1], 1)
            cut = []
            for ids, sizes in flat_sides:
                raw, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(sizes)).tolist()
                cut.append([raw[x:y] for x, y in zip([0, *ends[:-1]], ends, strict=True)])
            out += [both if ok else None for ok, both in zip(right.tolist(), zip(*cut, strict=True), strict=True)]
        return out

    def _spells(self, texts: list[bytes], ids: np.ndarray, sizes: np.ndarray, side: int) -> np.ndarray:
        """Whether the tokens' bytes, one after the other, are the text."""
        letters, lengths = self._spelled[side]
        wanted = np.fromiter(map(len, texts), np.int64, len(texts))
        right = sums_of(lengths[ids], sizes) == wanted
        same = picked(letters, lengths, ids[np.repeat(right, sizes)]) == np.frombuffer(b"".join(t for t, ok in zip(texts, right.tolist(), strict=True) if ok), np.uint8)
        right[right] = sums_of(~same, wanted[right]) == 0
        return right


def sums_of(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of stretches of ``values`` that stand one after the other."""
    sums = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return np.diff(sums[np.cumsum(sizes)], prepend=0) if len(sizes) else np.zeros(0, np.int64)


class Block:
    """Groups and links of the tokens of some chunks, weighted by how often each occurs."""

    def __init__(self, tables: Tables, tokens: list[tuple[bytes, bytes]], weight: np.ndarray):
        n = len(tokens)
        sides = [[t[s] for t in tokens] for s in (0, 1)]
        a, b = (np.frombuffer(b"".join(parts), "<u4").astype(np.int64) for parts in sides)
        size_a, size_b = (np.fromiter(map(len, parts), np.int64, n) // 4 for parts in sides)
        of_a, of_b = (np.repeat(np.arange(n), size) for size in (size_a, size_b))
        # A chunk has equally many bytes on both sides, so places go on from one to the next.
        end_a, end_b = np.cumsum(tables.a_length[a]), np.cumsum(tables.b_length[b])
        close_a, close_b = np.isin(end_a, end_b, assume_unique=True), np.isin(end_b, end_a, assume_unique=True)
        group_a, group_b = np.cumsum(close_a) - close_a, np.cumsum(close_b) - close_b
        groups = int(close_a.sum())
        count_a, count_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
        first_a, first_b = np.cumsum(count_a) - count_a, np.cumsum(count_b) - count_b
        regular = (count_a == 1) & (count_b == 1)
        regular[regular] = tables.same[a[first_a[regular]]] == b[first_b[regular]]
        self.n_a, self.n_b = size_a, size_b
        self.n_groups = np.bincount(of_a[close_a], minlength=n)
        # One-to-one groups of equal bytes: the ids of side A, by chunk.
        one = first_a[regular]
        self.same, self.same_of = a[one], np.bincount(of_a[one], minlength=n)
        self.vector = np.bincount(self.same, weight[of_a[one]], tables.size_a).astype(np.int64)
        # Every stretch between two neighbouring ends lies in one token of each side: one link.
        some_a, some_b = np.flatnonzero(~regular[group_a]), np.flatnonzero(~regular[group_b])
        ends = np.unique(np.concatenate([end_a[some_a], end_b[some_b]]))
        link_a, link_b = some_a[np.searchsorted(end_a[some_a], ends)], some_b[np.searchsorted(end_b[some_b], ends)]
        pairs, links = np.unique(a[link_a] << 32 | b[link_b], return_inverse=True)
        times = np.bincount(links, weight[of_a[link_a]], len(pairs)).astype(np.int64)
        self.pairs, self.times, self.links = frequent_first(pairs, times, links)
        self.links_of = np.bincount(of_a[link_a], minlength=n)
        # Written order: a group's A tokens, then its B tokens.
        written = np.empty(len(a) + len(b), np.int64)
        written[np.arange(len(a)) + first_b[group_a]] = a + close_a * tables.size_a
        written[np.arange(len(b)) + (first_a + count_a)[group_b]] = b + 2 * tables.size_a + close_b * tables.size_b
        self.written = written

    def group_texts(self, tables: Tables) -> list[bytes]:
        """Every chunk's groups, ``a1,a2|b1;a3|b2;``."""
        out, done = [], 0
        written = self.written.tolist()
        for size in (self.n_a + self.n_b).tolist():
            out.append(b"".join(map(tables.written.__getitem__, written[done : done + size])))
            done += size
        return out


class Tables:
    """Arrays by token id: bytes, the id of B with A's bytes, ids as written with what stands behind them."""

    def __init__(self, v: Vocabularies):
        self.a_length, self.b_length = v.a_length, v.b_length
        self.same, self.size_a, self.size_b = v.same, len(v.a_bytes), len(v.b_bytes)
        self.written = [b"%d%s" % (i, mark) for size, marks in ((self.size_a, (b",", b"|")), (self.size_b, (b",", b";"))) for mark in marks for i in range(size)]


DOCUMENT = "struct<doc_id: long, n_a: long, n_b: long, n_groups: long, n_links: long, chunks: int, groups: string, groups_sha256: string>"
PAIR = "struct<a: int, b: int, n: long>"
# A block's row, or a task's last row, which holds its vector.  By document: its occurrences of chunks; by chunk: its
# one-to-one groups (ids of A) and its other links (places in the list of pairs).
ARRAYS = ("occurrences", "same", "same_of", "links", "links_of")
BLOCK = f"block long, documents array<{DOCUMENT}>, {', '.join(f'{c} binary' for c in ARRAYS)}, pairs array<{PAIR}>, vector binary"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string, groups_sha256 string"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _structs(size: int, columns: dict[str, pa.Array]) -> pa.Array:
    """One list of structs."""
    values = pa.StructArray.from_arrays(list(columns.values()), names=list(columns))
    return pa.ListArray.from_arrays(pa.array([0, size], pa.int32()), values)


def _blocks(docs: DataFrame, vocabularies: Vocabularies, keep_groups: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, hasher, memo = Tables(vocabularies), WordHash(), Memo(vocabularies.encode)
        total = np.zeros(tables.size_a, np.int64)
        number = TaskContext.get().partitionId() << TASK_BITS

        def row(block: int | None, ids: pa.Array, column: pa.Array, vector: bytes | None) -> pa.RecordBatch:
            nonlocal total
            chunks = Chunks(hasher, column, bare=True)
            tokens, n = memo(chunks.texts), len(column)
            spelled = np.fromiter((t is not None for t in tokens), bool, len(tokens))
            lost = np.zeros(n, bool)
            lost[chunks.doc[~spelled[chunks.chunk]]] = True
            kept = ~lost[chunks.doc]
            used, occurrences, times = np.unique(chunks.chunk[kept], return_inverse=True, return_counts=True)
            used, times, occurrences = frequent_first(used, times, occurrences)
            of = np.bincount(chunks.doc[kept], minlength=n)
            own = Block(tables, [tokens[i] for i in used.tolist()], times)
            total += own.vector
            texts, at = own.group_texts(tables), np.cumsum(of) - of
            every = occurrences.tolist()
            groups = [b"".join(map(texts.__getitem__, every[a : a + size]))[:-1] for a, size in zip(at.tolist(), of.tolist(), strict=True)]
            by_chunk = {"n_a": own.n_a, "n_b": own.n_b, "n_groups": own.n_groups, "n_links": own.same_of + own.links_of}
            documents = _structs(n, {
                "doc_id": ids, **{c: pa.array(sums_of(x[occurrences], of), pa.int64()) for c, x in by_chunk.items()}, "chunks": pa.array(of, pa.int32()),
                "groups": pa.array([g.decode() for g in groups] if keep_groups else [None] * n, pa.string()),
                "groups_sha256": pa.array([hashlib.sha256(g).hexdigest() if g else "" for g in groups], pa.string()),
            })
            pairs = _structs(len(own.pairs), {
                "a": pa.array(own.pairs >> 32, pa.int32()), "b": pa.array(own.pairs & 0xFFFFFFFF, pa.int32()), "n": pa.array(own.times, pa.int64()),
            })
            arrays = [occurrences, own.same, own.same_of, own.links, own.links_of]
            values = [pa.array([block], pa.int64()), documents, *(pa.array([packed(x)], pa.binary()) for x in arrays), pairs, pa.array([vector], pa.binary())]
            return pa.RecordBatch.from_arrays(values, names=["block", "documents", *ARRAYS, "pairs", "vector"])

        for batch in pieces(batches, 1, BLOCK_BYTES):
            yield row(number, batch.column(0), batch.column(1), None)
            number += 1
        yield row(None, pa.array([], pa.int64()), pa.array([], pa.string()), total.astype("<i8").tobytes())

    return docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(run, BLOCK)


def _vector_pairs(stored: DataFrame, same: np.ndarray) -> DataFrame:
    """``(a, b, n)`` of the tasks' vectors: at most one row an id and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for vector in batch.column(0):
                n = np.frombuffer(vector.as_buffer(), "<i8")
                used = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(same[used], pa.int32()), pa.array(n[used])], names=["a", "b", "n"])

    return stored.filter("vector is not null").select("vector").mapInArrow(run, "a int, b int, n long")


@dataclass
class Alignment:
    documents: DataFrame  # RESULT, one row per document
    counts: DataFrame  # (a, b, n, best): links of every pair of ids, and the largest n of its b


def align(docs: DataFrame, a: str | None = None, b: str | None = None, keep_groups: bool = False) -> Alignment:
    """Align every text of ``docs(doc_id, text)`` under the vocabulary files ``a`` and ``b``.

    ``documents`` has one row per input row.  Texts that are null, empty, or
    whose tokens do not spell a space and the text on both sides have no
    tokens: zeros, empty ``groups`` and ``groups_sha256``.  ``groups`` is given
    with ``keep_groups`` only, its digest always.  ``n_best`` counts the links
    whose count is the largest of their ``b``, ties included.  Repeated rows and
    ids, null ids too, come back as they are and count each time; very long
    texts go by their chunks; an empty table gives empty
    ones; other columns are ignored.
    """
    spark: SparkSession = docs.sparkSession
    vocabularies = Vocabularies(read_file(a or public_file("byte_bpe_50k.json")), read_file(b or public_file("piece_bpe_32k.model")))
    stored = materialize(_blocks(docs, vocabularies, keep_groups))
    blocks = stored.filter("block is not null")
    listed = blocks.select("block", F.posexplode("pairs").alias("place", "pair")).select("block", "place", "pair.a", "pair.b", "pair.n")
    summed = listed.select("a", "b", "n").unionByName(_vector_pairs(stored, vocabularies.same)).groupBy("a", "b").agg(F.sum("n").alias("n"))
    summed = materialize(summed)
    counts = materialize(summed.join(summed.groupBy("b").agg(F.max("n").alias("best")), "b").select("a", "b", "n", "best"))
    release(summed)
    # At most one row an id of A.
    of_same = spark.createDataFrame([(i, int(x)) for i, x in enumerate(vocabularies.same) if x >= 0], "a int, b int")
    known = counts.join(F.broadcast(of_same), ["a", "b"]).toPandas()
    same_n, same_best = np.zeros(len(vocabularies.same), np.int64), np.zeros(len(vocabularies.same), bool)
    same_n[known["a"]], same_best[known["a"]] = known["n"], known["n"] == known["best"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            documents, answers = batch.column("documents"), batch.column("answers")
            for i in range(batch.num_rows):
                own, got = documents[i].values, answers[i].values
                place = got.field("place").to_numpy() if got is not None else np.zeros(0, np.int64)
                n, is_best = np.zeros(len(place), np.int64), np.zeros(len(place), bool)
                if len(place):
                    n[place] = got.field("n").to_numpy()
                    is_best[place] = got.field("is_best").to_numpy(zero_copy_only=False)
                arrays = {c: unpacked(batch.column(c)[i].as_py()) for c in ARRAYS}
                of_document = own.field("chunks").to_numpy()
                counted = []
                for same_value, value in ((same_best, is_best), (same_n, n)):
                    by_chunk = sums_of(same_value[arrays["same"]], arrays["same_of"]) + sums_of(value[arrays["links"]], arrays["links_of"])
                    counted.append(pa.array(sums_of(by_chunk[arrays["occurrences"]], of_document), pa.int64()))
                columns = [own.field(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")] + counted
                if len(own):
                    yield pa.RecordBatch.from_arrays(columns + [own.field("groups"), own.field("groups_sha256")], names=_names(RESULT))

    # A pair stands once in a block's list, so its key has at most one row a block; AQE splits such keys further.
    asked = listed.select("block", "place", "a", "b").join(counts.select("a", "b", "n", (F.col("n") == F.col("best")).alias("is_best")), ["a", "b"])
    answers = asked.groupBy("block").agg(F.collect_list(F.struct("place", "n", "is_best")).alias("answers"))  # as long as the block's list
    done = materialize(blocks.select("block", "documents", *ARRAYS).join(answers, "block", "left").mapInArrow(run, RESULT))
    release(stored)
    return Alignment(done, counts)


def q_alignment(spark, sf_dir: str) -> DataFrame:
    found = align(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    release(found.counts)
    return found.documents.drop("groups")
