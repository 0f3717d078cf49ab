"""Exact duplicates against a history, by minimal perfect hash.

*Index.*  The distinct digests of the historical documents are dealt to buckets by their first bits (digests are
uniform, so buckets are of even, bounded size whatever the copies do).  Each bucket gets a minimal perfect hash:
keys fall into small cells, and for every cell, largest first, the smallest pilot is kept that sends its keys to
free slots of exactly as many slots as keys.  A slot row holds the full digest and the locator of the winner so far.

*Lookup.*  Incoming documents are grouped by digest (combined before the shuffle), sent to the one slot their hash
names, and compared byte by byte with the digest there: equal ones are repeats of the historical document, the
others are no members and group among themselves.

The winner of a group has the most code points in the original text, then the smallest doc_id (null ids last).
Texts are equal when they agree after deleting every ASCII white-space character.

Defined results: null texts count as empty, and all empty texts are equal.  Rows that repeat doc_id and text are
rows of the same group; all of them carry ``kept`` if that doc_id stays (``keep_winners`` returns it once).  An
empty history or an empty batch is allowed.  Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandcast.llm.common import SPACES, materialize, packed, split_rows, text_or_empty, unpacked

PRIME = 2147483647
KEYS_PER_BUCKET = 4096
KEYS_PER_CELL = 4

_WINNER = "struct<shorter: long, no_id: boolean, doc_id: long>"


def normalised() -> Column:
    return F.translate(text_or_empty(), SPACES, "")


def digest_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, winner`` of every row; the smallest ``winner`` of a group stays."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(F.sha2(F.encode(normalised(), "UTF-8"), 256)).alias("digest"),
        F.struct((-F.length(text_or_empty())).cast("long").alias("shorter"), F.col("doc_id").isNull().alias("no_id"),
                 F.col("doc_id").cast("long").alias("doc_id")).alias("winner"))


def _group(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.min("winner").alias("winner"), F.count("*").alias("n"))


def _bits(first: int, digits: int) -> Column:
    return F.conv(F.substring(F.hex("digest"), first, digits), 16, 10).cast("long")


def _bucket(buckets: int) -> Column:
    return F.pmod(_bits(1, 12), F.lit(buckets)).cast("int")


def with_hashes(df: DataFrame, buckets: int) -> DataFrame:
    """The bucket and the two hashes below 2^31 - 1 that pilots combine, all from different digest bits."""
    return (df.withColumn("bucket", _bucket(buckets))
            .withColumn("h1", F.pmod(_bits(13, 12), F.lit(PRIME)))
            .withColumn("h2", F.pmod(_bits(25, 12), F.lit(PRIME - 1)) + 1)
            .withColumn("h3", _bits(37, 12)))


def slot_of(h1, h2, pilot, size):
    """The slot of a key under a pilot below PRIME; the same formula in numpy and in Spark columns.

    The sum alone steps evenly: where its step has a factor in common with ``size``, a key misses some slots for
    millions of pilots.  The fifth power permutes the values below PRIME (5 does not divide PRIME - 1), so the order
    is broken up and a key still meets every slot.  All products stay below 2^63.
    """
    at = (h1 + pilot * h2) % PRIME
    square = at * at % PRIME
    return square * square % PRIME * at % PRIME % size


def find_pilots(h1: np.ndarray, h2: np.ndarray, cell: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Pilots of all cells and the slot of every key, for one bucket."""
    size = len(h1)
    pilots, slots, free = np.zeros(cells, np.int64), np.full(size, -1, np.int64), np.ones(size, bool)
    order = np.argsort(cell, kind="stable")
    starts = np.searchsorted(cell[order], np.arange(cells + 1))
    for c in np.argsort(-np.diff(starts), kind="stable"):
        keys = order[starts[c]:starts[c + 1]]
        if not len(keys):
            break
        a, b = h1[keys], h2[keys]
        if len(set(zip(a.tolist(), b.tolist()))) < len(keys):
            raise RuntimeError("two digests of a cell agree in both hashes")
        step, begin = 64, 0
        while True:
            tried = np.arange(begin, begin + step)[:, None]
            at = slot_of(a, b, tried, size)
            fits = free[at].all(axis=1)
            if len(keys) > 1:
                ordered = np.sort(at, axis=1)
                fits &= (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
            if fits.any():
                k = int(fits.argmax())
                pilots[c], slots[keys] = begin + k, at[k]
                free[at[k]] = False
                break
            begin, step = begin + step, min(step * 4, 16384)
            if begin >= PRIME:
                raise RuntimeError("no pilot found: all have been tried")
    return pilots, slots


@dataclass
class DigestIndex:
    """A written index: pilots per bucket, and slot rows with full digests and winners."""

    buckets: int
    pilots: DataFrame          # bucket, size, pilots
    slots: DataFrame           # bucket, slot, digest, winner, n

    @classmethod
    def build(cls, history: DataFrame) -> "DigestIndex":
        """Index the rows of ``digest_rows`` of the historical documents."""
        groups = materialize(_group(history), "digest-groups")
        buckets = max(1, -(-groups.count() // KEYS_PER_BUCKET))

        def place(frames: Iterator[pd.DataFrame]) -> pd.DataFrame:
            f = frames
            cells = max(1, len(f) // KEYS_PER_CELL)
            cell = f["h3"].to_numpy() % cells
            pilots, slots = find_pilots(f["h1"].to_numpy(), f["h2"].to_numpy(), cell, cells)
            return pd.DataFrame({"bucket": f["bucket"], "digest": f["digest"], "slot": slots,
                                 "pilots": [pilots.tolist()] + [None] * (len(f) - 1), "size": len(f)})

        keys = with_hashes(groups.select("digest"), buckets).select("bucket", "digest", "h1", "h2", "h3")
        placed = materialize(keys.groupBy("bucket").applyInPandas(
            place, "bucket int, digest binary, slot long, pilots array<long>, size long"), "digest-slots")
        pilots = placed.where("pilots is not null").select("bucket", "size", "pilots")
        slots = placed.select("bucket", "slot", "digest").join(groups, "digest")
        return cls(buckets, pilots, slots)

    def lookup(self, batch: DataFrame) -> DataFrame:
        """Groups of the incoming ``digest_rows``: ``digest, winner, n, bucket, slot``; slot null: no member."""
        groups = with_hashes(_group(batch), self.buckets)
        cells = F.greatest(F.lit(1), F.floor(F.col("size") / KEYS_PER_CELL)).cast("long")
        pilot = F.get("pilots", (F.col("h3") % cells).cast("int"))
        located = (groups.join(self.pilots, "bucket", "left")
                   .select("digest", "winner", "n", "bucket",
                           slot_of(F.col("h1"), F.col("h2"), pilot, F.col("size")).alias("slot")))
        held = self.slots.select("bucket", "slot", F.col("digest").alias("held"))
        return (located.join(held, ["bucket", "slot"], "left")
                .withColumn("slot", F.when(F.col("held") == F.col("digest"), F.col("slot"))).drop("held"))


def deduplicate(history: DataFrame, batch: DataFrame) -> DataFrame:
    """Every row of both tables with its group.

    ``doc_id, keep_id, group_size, kept, text_sha256``, and ``repeat``: whether the group has a historical row.
    """
    return decide(digest_rows(history).withColumn("old", F.lit(True))
                  .unionByName(digest_rows(batch).withColumn("old", F.lit(False))))


def deduplicate_by_age(docs: DataFrame) -> DataFrame:
    """``deduplicate`` of the two halves that ``split_by_age`` makes, from one scan of the texts."""
    return decide(digest_rows(docs).withColumn("old", is_old()))


def decide(rows: DataFrame) -> DataFrame:
    """The groups of ``digest_rows`` with a flag ``old``: index the old rows, look the others up, merge the winners."""
    rows = materialize(rows, "digests")
    past, new = rows.where("old"), rows.where("not old")
    index = DigestIndex.build(past)
    found = materialize(index.lookup(new), "digest-lookup")
    repeats = found.where("slot is not null").select("bucket", "slot", F.col("winner").alias("__w"),
                                                     F.col("n").alias("__n"))
    old_groups = index.slots.join(repeats, ["bucket", "slot"], "left").select(
        "digest", F.least("winner", "__w").alias("winner"), (F.col("n") + F.coalesce("__n", F.lit(0))).alias("n"),
        F.lit(True).alias("repeat"))
    new_groups = found.where("slot is null").select("digest", "winner", "n", F.lit(False).alias("repeat"))
    groups = old_groups.unionByName(new_groups)
    return rows.select("doc_id", "digest").join(groups, "digest").select(
        "doc_id", F.col("winner.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("winner.doc_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "repeat")


def split_by_age(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """History and batch of a table that has no time column: by a hash of doc_id, half and half."""
    return docs.where(is_old()), docs.where(~is_old())


def is_old() -> Column:
    return F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(2)) == 0


def keep_winners(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """The documents that stay, with all columns of ``docs``; rows that repeat doc_id and text once."""
    decided = materialize(decided.select("doc_id", "kept", "text_sha256"), "exact-decided")
    stay = decided.where("kept").groupBy("doc_id", "text_sha256").agg(F.count("*").alias("__rows"))
    stay = stay.select(F.col("doc_id").alias("__id"), F.unhex("text_sha256").alias("__held"), "__rows")
    special = decided.where("not kept").select("doc_id").unionByName(
        stay.where("__rows > 1").select(F.col("__id").alias("doc_id")))
    maybe, sure = split_rows(packed(docs, F.col("doc_id").cast("long").alias("__doc_id"), "text"), "__doc_id", special)
    keyed = maybe.withColumn("__digest", F.unhex(F.sha2(F.encode(normalised(), "UTF-8"), 256)))
    joined = keyed.join(stay, (keyed["__digest"] == stay["__held"])
                        & keyed["__doc_id"].eqNullSafe(stay["__id"])).drop("__id", "__held")
    once = joined.where("__rows = 1")
    again = joined.where("__rows > 1").dropDuplicates(["__doc_id", "__digest"])
    return unpacked(sure).unionByName(unpacked(once.unionByName(again)))


#: The same rule in DuckDB.
ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM g
"""
