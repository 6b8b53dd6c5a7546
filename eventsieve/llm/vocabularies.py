"""Public tokenizers inside tasks: files read once on the driver, texts encoded by their distinct chunks.

A text is cut before single spaces that stand between two plain characters.
No token of the vocabularies and no rule that splits texts ahead of merging
reaches over such a space, so a text's ids are its chunks' ids one after the
other.  Prose repeats its words: each distinct chunk of a piece of texts is
encoded once, and a task remembers the last ones it met.  A text without such
spaces is one chunk.

The byte-level vocabulary splits texts by a pattern ahead of merging, so texts
for it alone are also cut where the pattern always splits: before a full stop,
comma or line feed behind a letter, before a line feed behind a stop or comma,
and before the last line feed ahead of a letter (the pattern leaves the last
blank of a run to what follows).
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa

from eventsieve.llm.texts import WordHash, flat

REMEMBERED = 1 << 18  # chunks
REMEMBERED_BYTES = 1 << 23
BATCH_BYTES = 1 << 18

_LETTER, _PLAIN = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
_PLAIN[:] = _LETTER
_PLAIN[[*range(ord("0"), ord("9") + 1), ord("."), ord(",")]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord("."), ord(",")]] = True
_LINE_FEED = 0x0A


def public_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def read_file(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def byte_level_alphabet() -> dict[str, int]:
    """The character that stands for every byte: itself where it prints in Latin-1, else the next one from 256 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in prints]
    return {**{chr(b): b for b in prints}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


def merge_ranks(content: bytes) -> dict[bytes, int] | None:
    """Token bytes to ids of a plain byte-level BPE file whose ids follow its merges; None for any other kind."""
    made, alphabet = json.loads(content), byte_level_alphabet()
    model, split = made["model"], made.get("pre_tokenizer") or {}
    if made.get("normalizer") or model.get("type") != "BPE" or any(model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges", "end_of_word_suffix")):
        return None
    if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
        return None
    specials = {t["content"] for t in made.get("added_tokens", [])}
    ranks = {bytes(alphabet[c] for c in token): i for token, i in model["vocab"].items() if token not in specials}
    order = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    return ranks if [model["vocab"][t] for t in order] == list(range(256, 256 + len(order))) else None


class ByteLevel:
    """A byte-level BPE file read by ``tokenizers``; with ``plain_specials`` special tokens' strings are ordinary text.

    Texts of plain characters go through ``tiktoken`` over the same file's
    ranks, which gives the same ids several times faster: both know the classes
    of characters below U+0280 alike.  Others, and texts that hold a special
    token's string, go through ``tokenizers`` itself.
    """

    OTHER_BYTES = bytes(range(0xCA, 0x100))  # characters from U+0280 on begin with one of them

    def __init__(self, content: bytes, plain_specials: bool = False):
        self.content, self.plain_specials = content, plain_specials
        self.specials = [] if plain_specials else [t["content"].encode() for t in json.loads(content).get("added_tokens", [])]
        ranks = merge_ranks(content)
        self.quick = None
        if ranks is not None:
            import public_tokenizers
            import tiktoken

            self.quick = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def made(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one thread
        from tokenizers import Tokenizer

        made = Tokenizer.from_str(self.content.decode("utf-8"))
        made.encode_special_tokens = self.plain_specials
        return made

    def is_plain(self, text: bytes) -> bool:
        if self.quick is None or not text.isascii() and len(text.translate(None, self.OTHER_BYTES)) != len(text):
            return False
        return not self.specials or not any(s in text for s in self.specials)

    def encode(self, texts: list[bytes]) -> list[list[int]]:
        """The ids of every text, without special tokens around them."""
        out: list = [None] * len(texts)
        rest, plain, quick = [], self.is_plain, self.quick and self.quick.encode_ordinary
        for i, t in enumerate(texts):
            if plain(t):
                out[i] = quick(t.decode())
            else:
                rest.append(i)
        for lo, hi in in_batches([texts[i] for i in rest]):
            own = rest[lo:hi]
            made = self.made.encode_batch_fast([texts[i].decode("utf-8", "surrogatepass") for i in own], add_special_tokens=False)
            for i, e in zip(own, made, strict=True):
                out[i] = e.ids
        return out


def in_batches(texts: list, limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """``(first, end)`` places of texts of about ``limit`` together."""
    lo = size = 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def chunk_starts(data: np.ndarray, offsets: np.ndarray, fine: bool = False) -> np.ndarray:
    """Where chunks begin in texts that stand one after the other (``fine``: by the pattern too); an empty text has none."""
    begins = np.zeros(len(data), bool)
    if len(data) > 2:
        before, own, behind = data[:-2], data[1:-1], data[2:]
        begins[1:-1] = (own == 0x20) & _PLAIN[before] & _LETTER[behind]
        if fine:
            feed, stop = own == _LINE_FEED, _STOP[before]
            begins[1:-1] |= (feed | _STOP[own]) & _LETTER[before] | feed & (stop | (before == _LINE_FEED) & _LETTER[behind])
    lo, hi = offsets[:-1], offsets[1:]
    lo, hi = lo[hi > lo], hi[hi > lo]
    begins[hi - 1] = False  # what stands behind it is another text
    begins[lo] = True
    return np.flatnonzero(begins)


def _distinct(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places of the distinct pairs, and every row's number among them."""
    _, first, back = np.unique(h1, return_index=True, return_inverse=True)
    if (h2[first][back] != h2).any():  # one hash stands for two texts
        _, first, back = np.unique(np.stack([h1, h2], 1), axis=0, return_index=True, return_inverse=True)
    return first, back.reshape(-1)


class Chunks:
    """The distinct chunks of a column of texts (``texts``), and for every occurrence its chunk and document.

    With ``bare`` the space that a later chunk begins with is left out; ``fine``: see ``chunk_starts``.
    """

    def __init__(self, hasher: WordHash, column: pa.Array, bare: bool = False, fine: bool = False):
        data, offsets = flat(column)
        starts = chunk_starts(data, offsets, fine)
        self.doc = np.searchsorted(offsets, starts, "right") - 1
        ends = np.append(starts[1:], len(data))
        if bare:
            starts = starts + (starts > offsets[self.doc])
        first, self.chunk = _distinct(hasher(data, starts, ends), hasher(data, starts, ends, 1))
        raw = data.tobytes()
        self.texts = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]


class Memo:
    """What ``encode`` gives for chunks; those met lately are remembered, in bounded memory."""

    def __init__(self, encode: Callable[[list[bytes]], list]):
        self.encode, self.known, self.size = encode, {}, 0

    def __call__(self, texts: list[bytes]) -> list:
        known = self.known
        new = [t for t in texts if t not in known]
        known.update(zip(new, self.encode(new), strict=True))
        out = [known[t] for t in texts]
        self.size += sum(map(len, new))
        if len(known) > REMEMBERED or self.size > REMEMBERED_BYTES:
            self.known, self.size = {}, 0
        return out


def laid_out(parts: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids one after the other, and how many each part has."""
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.fromiter(chain.from_iterable(parts), np.int64, int(sizes.sum())), sizes


def picked(values: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The values of the parts ``which``, in that order; parts stand one after the other and have ``sizes`` values."""
    first = np.cumsum(sizes) - sizes
    own = sizes[which]
    ends = np.cumsum(own)
    return values[np.repeat(first[which] - (ends - own), own) + np.arange(int(ends[-1]) if len(ends) else 0)]


class TextEncoder:
    """Ids of whole texts under a byte-level tokenizer."""

    def __init__(self, tokenizer: ByteLevel):
        self.tokenizer, self.hasher, self.memo = tokenizer, WordHash(), Memo(tokenizer.encode)

    def __call__(self, column: pa.Array) -> list[np.ndarray]:
        """The ids of every text of the column."""
        data, offsets = flat(column)
        raw, out, rest = data.tobytes(), [None] * len(column), []
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            if self.tokenizer.is_plain(raw[a:b]):
                out[i] = self.plain(raw[a:b])
            else:
                rest.append(i)
        if rest:
            for i, ids in zip(rest, self.by_chunks(column.take(pa.array(rest))), strict=True):
                out[i] = ids
        return out

    def plain(self, text: bytes) -> np.ndarray:
        """A plain text in stretches of bounded size, cut where chunks begin."""
        cuts = [0, len(text)]
        if len(text) > BATCH_BYTES:
            starts = chunk_starts(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
            wanted = np.searchsorted(starts, np.arange(BATCH_BYTES, len(text), BATCH_BYTES))
            cuts[1:1] = sorted(set(starts[wanted[wanted < len(starts)]].tolist()))
        parts = [self.tokenizer.quick.encode_to_numpy(text[a:b].decode(), disallowed_special=()) for a, b in zip(cuts, cuts[1:], strict=False)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def by_chunks(self, column: pa.Array) -> list[np.ndarray]:
        chunks = Chunks(self.hasher, column, fine=True)
        ids, sizes = laid_out(self.memo(chunks.texts))
        own = np.bincount(chunks.doc, sizes[chunks.chunk], len(column)).astype(np.int64)
        return np.split(picked(ids, sizes, chunks.chunk).astype(np.uint32), np.cumsum(own)[:-1])
