"""Packing token sequences by swap-based local search.

*Pieces.*  Every document becomes its token ids and an end id; a document longer than a sequence is cut into whole
pieces of the sequence length, the remainder first.  The pieces are written once with a row locator; ids stay in the
task that made them, only lengths travel.  Whole pieces fill a sequence alone and travel no further.

*Search.*  The other pieces are dealt by a hash of their locator (even, whatever the documents repeat) to groups of
about ``GROUP`` pieces.  A group starts from best fit in falling length.  Then underfull bins trade: one piece moves,
or pieces are exchanged one for one or two for one, from the emptiest bin to one at least as full.  Every trade makes
the sum of squared fills larger, and of all trades the one that raises it most is made; bins that run empty are
dropped.  The search ends when a pass over all bins empties none, or at a lower bound of the number of bins.

*Rounds.*  The emptiest ``LEFT`` underfull bins of a group are opened again and their pieces dealt anew, several groups
into one, until one group is left: a table of n pieces takes log n rounds over quickly shrinking tables, and the whole
result wastes little more than one group's packing.

Defined results: a null text is an empty one and gives one piece, the end id alone.  Repeated rows and ids give pieces
of their own.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandcast.llm.common import materialize, text_or_empty

GROUP = 4_000                   # pieces in a group, on average
LEFT = 24                       # underfull bins of a group that are opened again
TEXTS = 256                     # texts encoded at a time
TEXT_BYTES = 4 << 20            # or as many as hold this many characters

CACHED = 800_000                # pretokens whose ids a worker remembers, about 200 bytes each
#: Fixed value: characters whose class (letter, number, space, other) every Unicode version since 5.0 agrees on.
SETTLED = r"\t\n\x0b\x0c\r\x20-\x7E\xA1-\u024F\u0400-\u0481\u2010-\u2027\u3041-\u3096\u30A1-\u30FA\u4E00-\u9FA5\uAC00-\uD7A3"
#: ``tokencount.PATTERN`` over these characters, in classes that the standard module looks up in a table.
LETTERS = r"A-Za-z\xAA\xB5\xBA\xC0-\xD6\xD8-\xF6\xF8-\u024F\u0400-\u0481\u3041-\u3096\u30A1-\u30FA\u4E00-\u9FA5\uAC00-\uD7A3"
NUMBERS, SPACE = r"0-9\xB2\xB3\xB9\xBC-\xBE", r"\x09-\x0D\x20"
SETTLED_PATTERN = (rf"'(?:s|t|re|ve|m|ll|d)| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{LETTERS}{NUMBERS}{SPACE}]+"
                   rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
JOINED = 200                    # pretokens that go through the library as one text

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` ids: whole ones, the remainder first."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


class Encoder:
    """The library's ids of many texts: every distinct pretoken goes through the library once.

    A text with a special string, or with characters that the library's tables may class otherwise than the split
    pattern does, is encoded by the library as a whole.  Ids are held as little-endian unsigned 32-bit bytes.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"          # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        special = [re.escape(t.content) for t in self.library.get_added_tokens_decoder().values()]
        self.whole = re.compile("|".join([f"[^{SETTLED}]", *special]))
        self.split = re.compile(SETTLED_PATTERN)
        self.known: dict[str, bytes] = {}
        self.newline = self._library(["\n"])[0]

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pretokens: list[str]) -> None:
        """Remember the ids of ``pretokens``, which go through the library many at a time, a newline after each.

        A newline is a pretoken of its own beside all but white space; where the newlines do not come back one for
        one, the pretokens go through singly.
        """
        alone = [p for p in pretokens if p.isspace()]
        wordy = [p for p in pretokens if not p.isspace()]
        groups = [wordy[at:at + JOINED] for at in range(0, len(wordy), JOINED)]
        for group, ids in zip(groups, self._library(["\n".join(g) + "\n" for g in groups])):
            ends = (4 * np.flatnonzero(np.frombuffer(ids, "<u4") == np.frombuffer(self.newline, "<u4")[0])).tolist()
            if len(self.newline) == 4 and len(ends) == len(group):
                self.known.update(zip(group, (ids[a:b] for a, b in zip([0] + [e + 4 for e in ends], ends))))
            else:
                alone += group
        self.known.update(zip(alone, self._library(alone)))

    def encode_bytes(self, texts: list[str]) -> list[bytes]:
        if len(self.known) >= CACHED:
            self.known.clear()
        parts = [None if self.whole.search(t) else self.split.findall(t) for t in texts]
        rare = iter(self._library([t for t, p in zip(texts, parts) if p is None]))
        self._learn(list(set().union(*(p for p in parts if p is not None)).difference(self.known)))
        return [next(rare) if p is None else b"".join(map(self.known.__getitem__, p)) for p in parts]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [np.frombuffer(ids, "<u4").tolist() for ids in self.encode_bytes(texts)]


@functools.lru_cache(maxsize=1)
def kept_encoder(path: str) -> Encoder:
    """The encoder of this Python worker: about half of a task's distinct pretokens were met by the task before."""
    return Encoder(path)


def token_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of all pieces of all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, last = kept_encoder(tokenizer_path), np.array([end_id], dtype="<u4").tobytes()

        def pieces(doc_ids: list, texts: list[str]) -> pa.RecordBatch:
            rows = []
            for doc_id, found in zip(doc_ids, encoder.encode_bytes(texts)):
                ids = found + last
                for number, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    rows.append((doc_id, number, start, length, zlib.crc32(ids[4 * start:4 * (start + length)])))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                              names=["doc_id", "piece", "start", "length", "ids_crc32"])

        for batch in batches:
            ids, texts, size = [], [], 0
            for at in range(batch.num_rows):
                ids.append(batch.column(0)[at].as_py())
                texts.append(batch.column(1)[at].as_py())
                size += len(texts[-1])
                if len(texts) >= TEXTS or size >= TEXT_BYTES:
                    yield pieces(ids, texts)
                    ids, texts, size = [], [], 0
            if texts:
                yield pieces(ids, texts)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, PIECES)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins (lists of positions in ``lengths``) by best fit in falling length, earlier positions first."""
    bins: list[list[int]] = []
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]   # bins by the room they have
    rooms = 0                                                    # bit r is set while open_[r] holds a bin
    for at in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        need = lengths[at]
        fitting = rooms >> need
        if fitting:
            room = need + (fitting & -fitting).bit_length() - 1
            b = open_[room].pop()
            if not open_[room]:
                rooms &= ~(1 << room)
            bins[b].append(at)
        else:
            room, b = capacity, len(bins)
            bins.append([at])
        open_[room - need].append(b)
        rooms |= 1 << (room - need)
    return bins


def least_bins(lengths: np.ndarray, capacity: int) -> int:
    """A number of bins that no packing can go below: the largest of the bounds by dual feasible functions.

    For every k a length counts floor((k + 1) * length / capacity) k-ths of a bin (its own share where that is whole);
    k = 1 counts the pieces over half a sequence, k = 2 two pieces over a third as one bin, and so on.
    """
    best = -(-int(lengths.sum()) // capacity)
    for k in range(1, 64):
        scaled = (k + 1) * lengths
        # in units of 1 / (k * capacity) of a bin
        share = np.where(scaled % capacity == 0, k * lengths, scaled // capacity * capacity)
        best = max(best, -(-int(share.sum()) // (k * capacity)))
    return best


class Search:
    """Trades between underfull bins: one over, one for one, two for one.

    The emptiest bin gives; of all trades with bins at least as full the one that raises the sum of squared fills most
    is made.  A giver holds at most about sqrt(2 * capacity) different lengths, so its pairs are few.
    """

    def __init__(self, bins: list[list[int]], lengths: list[int], capacity: int):
        self.capacity = capacity
        self.length = np.array(lengths, dtype=np.int64)
        self.bin = np.empty(len(lengths), dtype=np.int64)
        for b, pieces in enumerate(bins):
            self.bin[pieces] = b
        self.fill = np.bincount(self.bin, weights=self.length, minlength=len(bins)).astype(np.int64)

    def trade(self, giver: int) -> tuple[list[int], int | None, int] | None:
        """The best trade of a bin: (its pieces that go over, the piece that comes back, the taker)."""
        room = self.capacity - self.fill
        takers = (room > 0) & (self.fill >= self.fill[giver])
        takers[giver] = False
        bins, theirs = np.flatnonzero(takers), np.flatnonzero(takers[self.bin])
        if not len(bins):
            return None
        # what may come back, nothing included, and the bin it comes from
        back = np.concatenate([np.zeros(len(bins), np.int64), self.length[theirs]])
        taker = np.concatenate([bins, self.bin[theirs]])
        ahead, free = self.fill[taker] - self.fill[giver], room[taker]
        mine = np.flatnonzero(self.bin == giver)
        mine = mine[np.unique(self.length[mine], return_index=True)[1]]
        overs = [[int(i)] for i in mine] + self._pairs(giver)
        best, found = 0, None
        for over in overs:
            tokens = int(self.length[over].sum()) - back
            gain = np.where((tokens > 0) & (tokens <= free), tokens * (ahead + tokens), 0)
            if len(over) == 2:
                gain[:len(bins)] = 0                            # two pieces over without one back are two moves
            at = int(gain.argmax())
            if gain[at] > best:
                best = int(gain[at])
                found = over, (None if at < len(bins) else int(theirs[at - len(bins)])), int(taker[at])
        return found

    def _pairs(self, giver: int) -> list[list[int]]:
        mine = np.flatnonzero(self.bin == giver)
        seen: dict[tuple[int, int], list[int]] = {}
        by_length: dict[int, list[int]] = {}
        for i in mine.tolist():
            by_length.setdefault(int(self.length[i]), []).append(i)
        kinds = sorted(by_length)
        for n, x in enumerate(kinds):
            if len(by_length[x]) > 1:
                seen[x, x] = by_length[x][:2]
            for y in kinds[:n]:
                seen[x, y] = [by_length[x][0], by_length[y][0]]
        return list(seen.values())

    def apply(self, giver: int, over: list[int], back: int | None, taker: int) -> None:
        self.bin[over] = taker
        tokens = int(self.length[over].sum())
        if back is not None:
            self.bin[back] = giver
            tokens -= int(self.length[back])
        self.fill[giver] -= tokens
        self.fill[taker] += tokens

    def run(self) -> list[list[int]]:
        """Passes over the underfull bins, emptiest first, until one empties no bin or fewer bins are impossible."""
        least = least_bins(self.length, self.capacity)
        emptied = True
        while emptied:
            emptied = False
            for giver in np.argsort(self.fill, kind="stable").tolist():
                if np.count_nonzero(self.fill) <= least:
                    break
                while 0 < self.fill[giver] < self.capacity and (found := self.trade(giver)):
                    self.apply(giver, *found)
                    emptied |= not self.fill[giver]
            if np.count_nonzero(self.fill) <= least:
                break
        order = np.lexsort((np.arange(len(self.bin)), self.bin))
        parts = np.split(order, np.flatnonzero(np.diff(self.bin[order])) + 1)
        return [p.tolist() for p in parts if len(p)]


def pack(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of at most ``capacity``: best fit, then trades between the underfull bins."""
    return Search(best_fit(lengths, capacity), lengths, capacity).run()


def _pack_group(capacity: int, left: int):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("length", "descending"), ("row", "ascending")])
        lengths, group = rows.column("length").to_pylist(), rows.column("grp")[0].as_py()
        bins = pack(lengths, capacity)
        fills = [sum(lengths[i] for i in b) for b in bins]
        emptiest = sorted((b for b in range(len(bins)) if fills[b] < capacity), key=lambda b: (fills[b], b))[:left]
        number, offset, opened = (np.zeros(len(lengths), dtype=np.int64) for _ in range(3))
        for n, b in enumerate(bins):
            at = 0
            for i in b:
                number[i], offset[i] = n, at
                at += lengths[i]
        for b in emptiest:
            opened[bins[b]] = 1
        return rows.append_column("sequence", pa.array((group << 32) + number)).append_column("offset", pa.array(offset)) \
            .append_column("opened", pa.array(opened == 1))
    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = 1024, group: int = GROUP,
                   left: int = LEFT) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece."""
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    located = token_pieces(docs, tokenizer_path, end_id, capacity).withColumn("row", F.monotonically_increasing_id())
    pieces = materialize(located, "pieces")
    done = [pieces.where(F.col("length") == capacity)
            .select(*columns, (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    rest = pieces.where(F.col("length") < capacity)
    n, number = rest.count(), 0
    schema = PIECES + ", row long, grp long, sequence long, offset long, opened boolean"
    while n:
        groups = -(-n // group)
        dealt = rest.withColumn("grp", F.pmod(F.xxhash64("row", F.lit(number)), F.lit(groups)))
        packed = materialize(dealt.groupBy("grp").applyInArrow(_pack_group(capacity, left), schema), "packed")
        last = groups == 1
        final = packed if last else packed.where("NOT opened")
        # rounds keep their numbers apart in the bits above the group
        done.append(final.select(*columns, (F.col("sequence") + F.lit(number << 56)).alias("sequence_id"), "offset"))
        if last:
            break
        rest = packed.where("opened").select(*columns, "row")
        n, number = rest.count(), number + 1
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out
