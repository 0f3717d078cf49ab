"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For every prefix of a pretoken's bytes the encoding has exactly one valid last token.  Going left to right,
the last token of prefix ``i`` is the token ``t`` ending at ``i`` that may follow the stored last token of
prefix ``i - len(t)``: a pair may stand side by side when merging their joined bytes would keep them apart.
The table of last tokens is all the state: the ids of any prefix follow by walking it backwards, bytes can be
appended by extending it, and after an edit only the tail from the first changed byte has to be redone.

Defined results: a null text counts as empty (0 ids).  Special strings inside texts are ordinary text.
Repeated rows give repeated rows; other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable
from functools import cached_property
from itertools import chain

import ahocorasick
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandcast.llm.common import map_rows

CACHE_ENTRIES = 150_000       # pretokens in each of two generations
PAIR_ENTRIES = 250_000


class Vocabulary:
    """Ranks of a tiktoken file: id -> bytes, bytes -> id, and how each token is put together."""

    def __init__(self, tokens: dict[bytes, int]):
        self.ids = tokens
        self.size = max(tokens.values()) + 1
        self.bytes: list[bytes] = [b""] * self.size
        for b, i in tokens.items():
            self.bytes[i] = b
        self.longest = max(map(len, tokens))
        self.parts: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        for i in sorted(tokens.values()):
            b = self.bytes[i]
            if len(b) > 1 and (last := self._last_two(b, i)):
                self.parts[i] = last
                self.joined[last] = i
        self._pairs: dict[int, bool] = {}

    @classmethod
    def load(cls, path: str) -> "Vocabulary":
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})

    def _last_two(self, b: bytes, below: int) -> tuple[int, int] | None:
        """The pair whose merge makes token ``below``: merge its bytes by ranks under its own."""
        parts = [b[i:i + 1] for i in range(len(b))]
        while len(parts) > 2:
            rank, at = min(((self.ids.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1)))
            if rank >= below:
                return None            # no merge path: only a whole pretoken can be this token
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return self.ids[parts[0]], self.ids[parts[1]]

    def __getstate__(self):
        return {k: x for k, x in self.__dict__.items() if k != "matches"} | {"_pairs": {}}

    @cached_property
    def matches(self) -> ahocorasick.Automaton:
        """Finds every token that ends at a byte, longest first (bytes as Latin-1 characters).

        Only tokens that merging can reach; any other is only ever a whole pretoken.
        """
        found = ahocorasick.Automaton()
        for data, i in self.ids.items():
            if len(data) == 1 or i in self.parts:
                found.add_word(data.decode("latin-1"), (len(data), i))
        found.make_automaton()
        return found

    def may_follow(self, left: int, right: int) -> bool:
        """``kept_apart``, remembered for up to ``PAIR_ENTRIES`` pairs."""
        key = left << 32 | right
        found = self._pairs.get(key)
        if found is None:
            if len(self._pairs) >= PAIR_ENTRIES:
                self._pairs.clear()
            found = self._pairs[key] = self.kept_apart(left, right)
        return found

    def last_tokens(self, data: bytes, last: list[int]) -> None:
        """Extend ``last`` (the last token of every prefix so far, after a leading -1) to all of ``data``."""
        pairs, n = self._pairs.get, len(last)
        shift = max(0, n - self.longest)
        for at, (length, t) in self.matches.iter(data[shift:].decode("latin-1")):
            end = at + 1 + shift
            if end < n:                          # this prefix has its token
                continue
            begin = end - length
            if begin:
                before = last[begin]
                fits = pairs(before << 32 | t)
                if fits is None:
                    fits = self.may_follow(before, t)
                if not fits:
                    continue
            last.append(t)
            n += 1
        if n != len(data) + 1:
            raise ValueError("the vocabulary lacks a single byte")

    def walk(self, last: list[int], length: int) -> list[int]:
        """Ids of the first ``length`` bytes: the last tokens, backwards."""
        out = []
        while length > 0:
            t = last[length]
            out.append(t)
            length -= len(self.bytes[t])
        out.reverse()
        return out

    def kept_apart(self, left: int, right: int) -> bool:
        """Would merging the joined bytes of the two tokens keep this boundary?

        Undo the later of the two last merges again and again; if the symbols that face each other across
        the boundary could have been joined before either side was complete, the pair is not valid.
        """
        before = self.size                       # merges with a rank below this happened while both stood
        while True:
            made = self.joined.get((left, right))
            if made is not None and made < before:
                return False
            undo_left = left in self.parts and (left > right or right not in self.parts)
            if undo_left:
                before, left = left, self.parts[left][1]
            elif right in self.parts:
                before, right = right + 1, self.parts[right][0]   # on equal rank the left pair merges first
            else:
                return True


class PrefixEncoding:
    """Encoding of one pretoken that grows at its end and can be edited.

    ``last[i]`` is the only valid last token of the first ``i`` bytes.
    """

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.v, self.data, self.last = vocabulary, bytearray(), [-1]
        self.append(data)

    def append(self, data: bytes) -> None:
        self.data += data
        self.v.last_tokens(bytes(self.data), self.last)

    def replace(self, begin: int, end: int, data: bytes) -> None:
        """Put ``data`` in place of bytes ``begin:end``; prefixes that end before the edit are kept."""
        tail = bytes(self.data[end:])
        del self.data[begin:]
        del self.last[begin + 1:]
        self.append(data + tail)

    def ids(self, length: int | None = None) -> list[int]:
        """Ids of the first ``length`` bytes (all, if not given)."""
        return self.v.walk(self.last, len(self.data) if length is None else length)


class _Pieces(dict):
    """Pretoken -> ids in two generations: when the young one is full it becomes the old one.

    A pretoken that is met again moves to the young generation, so frequent ones stay and memory is bounded.
    """

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.v, self.old = vocabulary, {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.old.get(piece)
        if ids is None:
            data = piece.encode("utf-8")
            whole = self.v.ids.get(data)         # a pretoken that is a token stays whole
            if whole is not None:
                ids = (whole,)
            else:
                last = [-1]
                self.v.last_tokens(data, last)
                ids = tuple(self.v.walk(last, len(data)))
        if len(piece) <= 64:
            if len(self) >= CACHE_ENTRIES:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    """Encodes whole texts to ids and decodes ids to bytes."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.v, self.split, self.pieces = vocabulary, regex.compile(pattern), _Pieces(vocabulary)

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.pieces.__getitem__, self.split.findall(text))))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.v.bytes.__getitem__, ids))


def _with_codec(docs: DataFrame, vocabulary: str, pattern: str, columns: list[str], schema: str, row) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(vocabulary))

    def make() -> Callable[..., tuple]:
        codec = Codec(shared.value, pattern)
        digits = list(map(str, range(codec.v.size)))
        return lambda *values: row(codec, digits, *values)

    return map_rows(docs, columns, schema, make)


def encode(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """``doc_id, ids array<int>`` of every row of ``docs`` (doc_id, text)."""
    return _with_codec(docs, vocabulary, pattern, ["doc_id", "text"], "doc_id long, ids array<int>",
                       lambda codec, _, doc_id, text: (doc_id, codec.encode(text or "")))


def decode(encoded: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """``doc_id, data binary`` from ``encode``'s rows (null ids: empty)."""
    return _with_codec(encoded, vocabulary, pattern, ["doc_id", "ids"], "doc_id long, data binary",
                       lambda codec, _, doc_id, ids: (doc_id, codec.decode(ids or [])))


def round_trip_digests(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """Encode every whole text, decode the ids again, and return the digests of both.

    ``doc_id, n_tokens, ids_sha256`` (decimal ids joined by one space) ``, decoded_sha256``.
    """
    def row(codec: Codec, digits: list[str], doc_id, text):
        ids = codec.encode(text or "")
        return (doc_id, len(ids),
                hashlib.sha256(" ".join(map(digits.__getitem__, ids)).encode()).hexdigest(),
                hashlib.sha256(codec.decode(ids)).hexdigest())

    return _with_codec(docs.select("doc_id", F.col("text").cast("string").alias("text")), vocabulary, pattern,
                       ["doc_id", "text"],
                       "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", row)
