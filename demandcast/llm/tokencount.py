"""Token counts by heap-and-linked-list byte-pair merging.

Every pretoken starts as a linked list of byte symbols.  A heap holds the adjacent pairs that the merge
table knows, keyed by (rank, position); the lowest is popped, checked against the list (a stale entry is
skipped), merged, and the two new neighbouring pairs are pushed.  The count is the initial number of symbols
minus the merges done; identifiers are never emitted.

Defined results: a null text counts as empty (0 bytes, 0 tokens).  Literal special strings inside a text are
one token each, as the library's default has them.  Repeated rows give repeated rows; other columns of the
input are ignored.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable

import regex
from pyspark.sql import DataFrame

from demandcast.llm.common import map_rows

#: Fixed value: the split pattern of the byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE_ENTRIES = 200_000


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in of each byte in the vocabulary file -> the byte.

    Bytes that print stand for themselves; the others take the code points from 256 on, in order.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class MergeTable:
    """Merges of a ``tokenizers`` JSON file as (left bytes, right bytes) -> rank, and its special strings."""

    def __init__(self, ranks: dict[tuple[bytes, bytes], int], specials: list[str]):
        self.ranks, self.specials = ranks, specials

    @classmethod
    def load(cls, path: str) -> "MergeTable":
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        ranks = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            ranks.setdefault((bytes(map(alphabet.__getitem__, left)), bytes(map(alphabet.__getitem__, right))), rank)
        return cls(ranks, [t["content"] for t in spec["added_tokens"]])


def merged_length(data: bytes, ranks: dict[tuple[bytes, bytes], int]) -> int:
    """Symbols left after merging ``data``: a heap of pairs over a doubly linked list."""
    n = len(data)
    if n < 2:
        return n
    symbol = [data[i:i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, symbol[i], symbol[i + 1]) for i in range(n - 1)
            if (r := ranks.get((symbol[i], symbol[i + 1]))) is not None]
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if symbol[i] != left or j >= n or symbol[j] != right:   # one side was merged away meanwhile
            continue
        symbol[i], symbol[j] = left + right, b""
        merges += 1
        k = after[j]
        after[i] = k
        if k < n:
            before[k] = i
            if (r := ranks.get((symbol[i], symbol[k]))) is not None:
                heapq.heappush(heap, (r, i, symbol[i], symbol[k]))
        if (h := before[i]) >= 0 and (r := ranks.get((symbol[h], symbol[i]))) is not None:
            heapq.heappush(heap, (r, h, symbol[h], symbol[i]))
    return n - merges


class _Counts(dict):
    """Pretoken -> its token count, computed at first sight; emptied when full, so memory is bounded."""

    def __init__(self, ranks):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, piece: str) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        n = merged_length(piece.encode("utf-8"), self.ranks)
        if len(piece) <= 64:
            self[piece] = n
        return n


class TokenCounter:
    """Counts tokens of whole texts under one merge table."""

    def __init__(self, table: MergeTable):
        self.split = regex.compile(PATTERN)
        self.specials = regex.compile("|".join(map(regex.escape, sorted(table.specials, key=len, reverse=True)))) \
            if table.specials else None
        self.counts = _Counts(table.ranks)

    def count(self, text: str) -> int:
        if self.specials and self.specials.search(text):
            found = sum(1 for _ in self.specials.finditer(text))
            return found + sum(self._plain(part) for part in self.specials.split(text))
        return self._plain(text)

    def _plain(self, text: str) -> int:
        return sum(map(self.counts.__getitem__, self.split.findall(text)))


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 1024) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs`` (doc_id, text).

    ``vocabulary`` is a tokenizers JSON file readable by the driver; its merge table (bounded by the
    vocabulary) is broadcast once.
    """
    table = docs.sparkSession.sparkContext.broadcast(MergeTable.load(vocabulary))

    def make() -> Callable[..., tuple]:
        counter = TokenCounter(table.value)

        def row(doc_id, text):
            text = text or ""
            n = counter.count(text)
            return doc_id, len(text.encode("utf-8")), n, n > limit
        return row

    return map_rows(docs, ["doc_id", "text"], "doc_id long, n_bytes long, n_tokens long, over_limit boolean", make)
