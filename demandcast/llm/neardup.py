"""Near duplicates on word shingles: HyperMinHash candidates, confirmed on full shingle sets.

1. *Sets.*  Texts are lower-cased in A-Z and cut at ASCII white space; a document's set holds the 64-bit hashes of
   its distinct shingles (a shorter document: its whole word sequence as one).  Documents with equal sets are one
   class (a 128-bit digest); from here on classes are compared, so copies cost nothing.
2. *HyperMinHash.*  The hash range is cut into ``REGISTERS`` equal buckets.  A register keeps the least hash of its
   bucket as a leading-zero count and ``MANTISSA`` further bits; empty registers borrow from a filled one that a
   fixed hash chain names, so a small set's registers are independent draws from it.  Bands of ``ROWS`` registers are
   the candidate keys (of 48 bands of 7 independent registers, a pair at similarity 0.8 shares none with
   probability 1e-5, one at 0.85 with 1e-8).
3. *Links.*  In every bucket the classes are first compared with one leader.  Where a bucket still holds more
   than one component after that, each class outside its largest component is compared with all others of the
   bucket, in tiles of bounded size.  In a tile, pairs of large sets (``FEW`` shingles or more) whose
   collision-corrected Jaccard estimate lies ``SLACK`` standard errors below the threshold are left out, those already
   connected are skipped, and the rest are confirmed on the full sets by 100 * intersection >= percent * union.
   Smaller sets fill too few registers for that error and are never estimated.
4. *Components.*  Star steps over the confirmed links (``components``); a component is named by its smallest doc_id.

Joins whose sides both grow with the corpus are shuffle joins at every size (``merge``), so the plan that is tested
small is the plan that runs large.

No bucket, class or component is gathered in one task: leaders' members and tiles are dealt in bounded pieces, and
nothing is capped.

Defined results: documents without words (null and empty texts) have 0 shingles, link with nothing and are kept;
null doc_ids are classed like others but never name a component unless alone.  Rows that repeat doc_id and text are
equal documents and both carry ``kept``.  Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from demandcast.llm.common import likely_rows, map_rows, materialize, packed, split_rows, unpacked
from demandcast.llm.components import connected_components

REGISTERS = 336
ROWS = 7                       # registers in a band
BANDS = REGISTERS // ROWS
MANTISSA = 10
EMPTY = 0xFFFF
SLACK = 5.0                    # standard errors of the estimate below the threshold that are still confirmed
FEW = 4 * REGISTERS            # pairs with a set smaller than this are confirmed without an estimate
HOME_ROUNDS = 2                # rounds that gather the neighbourhoods of tiles
TILE = 512                     # classes on each side of a tile
WORD_CACHE = 200_000

_U64 = np.uint64
_MASK = (1 << 64) - 1
_STEP = (1 << 64) // REGISTERS
_EDGES = np.array([i * _STEP for i in range(1, REGISTERS)], dtype=_U64)
_STARTS = np.array([i * _STEP for i in range(REGISTERS)], dtype=_U64)
_ZEROS_OF_STEP = 64 - _STEP.bit_length()


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: uniform bits from any combination of word hashes."""
    x = x ^ (x >> _U64(31))
    x = x * _U64(0x9E3779B97F4A7C15)
    x = x ^ (x >> _U64(29))
    x = x * _U64(0xD6E8FEB86659FD93)
    return x ^ (x >> _U64(32))


#: Which registers an empty register asks, in order; the same for every document.
_CHAIN = np.stack([_mix(np.arange(REGISTERS, dtype=_U64) + _U64((0xA5A5_0001 * (k + 1)) & _MASK))
                   % _U64(REGISTERS) for k in range(64)]).astype(np.int64)
#: How registers (rows) rank the buckets when their chain names no filled one: the same for every document.
_RANK = _mix(np.arange(REGISTERS * REGISTERS, dtype=_U64) + _U64(0x5A5A_0001_0000)).reshape(REGISTERS, REGISTERS)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: str | None, words: int, hashes: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a whole text."""
    tokens = (text or "").encode("utf-8").lower().split()   # bytes: only A-Z lower, only ASCII white space
    if not tokens:
        return np.empty(0, _U64)
    h = np.fromiter(map(hashes.__getitem__, tokens), dtype=_U64, count=len(tokens))
    n = max(1, len(h) - words + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(n, _U64)
        for k in range(min(words, len(h))):
            total = total * _U64(0xC2B2AE3D27D4EB4F) + h[k:k + n]
        return np.unique(_mix(total + _U64(len(tokens) if len(h) < words else words)))


def registers(hashes: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of a sorted set: leading zeros and mantissa of every bucket's least hash."""
    out = np.full(REGISTERS, EMPTY, np.uint16)
    if not len(hashes):
        return out
    at = np.concatenate([[0], np.searchsorted(hashes, _EDGES)])
    filled = np.append(at[1:], len(hashes)) > at
    rest = hashes[at[filled]] - _STARTS[filled]
    value = np.maximum(rest, _U64(1))
    bits = np.frexp(value.astype(np.float64))[1].astype(np.int64)         # bit length
    bits -= (value >> (bits - 1).astype(_U64)) == 0                       # the conversion may round up
    zeros = 64 - _ZEROS_OF_STEP - bits
    head = np.where(bits > MANTISSA, value >> np.maximum(bits - 1 - MANTISSA, 0).astype(_U64),
                    value << np.maximum(MANTISSA + 1 - bits, 0).astype(_U64))
    out[filled] = (np.minimum(zeros, 62) << MANTISSA).astype(np.uint16) \
        | (head & _U64((1 << MANTISSA) - 1)).astype(np.uint16)
    empty = np.flatnonzero(~filled)
    for k in range(len(_CHAIN)):
        if not len(empty):
            break
        ask = _CHAIN[k, empty]
        found = filled[ask]
        out[empty[found]] = out[ask[found]]
        empty = empty[~found]
    if len(empty):                                    # very small sets: the filled bucket that ranks first
        order = np.flatnonzero(filled)
        out[empty] = out[order[_RANK[np.ix_(empty, order)].argmin(axis=1)]]
    return out


#: Chance that two different least hashes look alike in a register: same exponent, same mantissa.
COLLISION = 2.0 ** -MANTISSA / 3


def estimate(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard estimates of a register row against register rows."""
    alike = (many == one).mean(axis=1)
    return np.clip((alike - COLLISION) / (1 - COLLISION), 0, 1)


def sketch_documents(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, n_shingles, digest, registers`` of every row; digest null for documents without words."""
    def make() -> Callable[..., tuple]:
        hashes = _WordHashes()

        def row(doc_id, text):
            s = shingle_set(text, words, hashes)
            if not len(s):
                return doc_id, 0, None, None
            return doc_id, len(s), xxhash.xxh3_128_digest(s.tobytes()), registers(s).tobytes()
        return row

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_rows(rows, ["doc_id", "text"], "doc_id long, n_shingles long, digest binary, registers binary", make)


def band_rows(classes: DataFrame) -> DataFrame:
    """(class, key) for every band of every class."""
    width = 2 * ROWS
    return (classes.select("class", "registers", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band"))
            .select("class", F.xxhash64("band", F.substring("registers", F.col("band") * width + 1, F.lit(width)))
                    .alias("key")))


def shared_keys(keys: DataFrame) -> DataFrame:
    """Keys that several classes have, and the least of these classes."""
    return (keys.groupBy("key").agg(F.min("class").alias("leader"), F.max("class").alias("last"))
            .where("leader <> last").select("key", "leader"))


def candidate_buckets(classes: DataFrame) -> DataFrame:
    """(key, class, leader) of every band bucket that several classes share."""
    keys = band_rows(classes)
    shared = materialize(shared_keys(keys), "lsh-shared")
    return likely_rows(keys, "key", shared.select("key")).join(shared, "key")


def _digests(docs: DataFrame, words: int) -> DataFrame:
    """``digest, text`` of every row of ``docs`` (text) that has words."""
    def make() -> Callable[..., tuple]:
        hashes = _WordHashes()

        def row(text):
            s = shingle_set(text, words, hashes)
            return (xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None), text
        return row

    return map_rows(docs, ["text"], "digest binary, text string", make).where("digest is not null")


def _class_texts(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(class, wants, text): one text for each of the wanted classes (class, doc_id, digest), or a few.

    A class is found by its doc_id; where that is null or names several wanted classes, by its digest, as every
    text of such an id would meet every class of it.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("__id"), F.col("text").cast("string").alias("text"))
    w = wanted.select("class", "doc_id", F.col("digest").alias("wants"))
    unclear = materialize(w.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null")
                          .select(F.col("doc_id").alias("__unclear")), "unclear-ids")
    clear = not unclear.head(1)
    by_id = w if clear else w.join(unclear, F.col("doc_id") == F.col("__unclear"), "left_anti").where(
        "doc_id is not null")
    rows = (likely_rows(texts, "__id", by_id.select("doc_id")).join(by_id.hint("merge"), F.col("__id") == by_id.doc_id)
            .select("class", "wants", "text"))
    if clear:
        return rows
    rest = w.join(unclear, F.col("doc_id").eqNullSafe(F.col("__unclear")), "left_semi").select("class", "wants")
    held = likely_rows(texts, "__id", unclear).join(unclear, F.col("__id").eqNullSafe(F.col("__unclear")), "left_semi")
    found = likely_rows(_digests(held, words), "digest", rest.select("wants")).groupBy("digest") \
        .agg(F.min("text").alias("text"))                           # copies are combined before the shuffle
    return rows.unionByName(found.join(rest, F.col("digest") == F.col("wants")).select("class", "wants", "text"))


def class_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """Registers and full sets of ``wanted`` classes (class, doc_id, digest), from one of the documents of each."""
    rows = _class_texts(docs, wanted, words)

    def make() -> Callable[..., tuple]:
        hashes = _WordHashes()

        def row(cls, wants, text):
            s = shingle_set(text, words, hashes)
            if not len(s) or xxhash.xxh3_128_digest(s.tobytes()) != wants:
                return cls, None, None
            return cls, registers(s).tobytes(), s.tobytes()
        return row

    sets = map_rows(rows, ["class", "wants", "text"], "class long, registers binary, shingles binary", make)
    found = materialize(sets.where("shingles is not null"), "candidate-sets")
    one = found.agg(F.count("*").alias("n"), F.countDistinct("class").alias("d")).first()
    return found if one.n == one.d else materialize(found.dropDuplicates(["class"]), "candidate-sets")   # repeated ids


class _Forest:
    """Union-find over the classes of one tile."""

    def __init__(self):
        self.up: dict = {}

    def root(self, x):
        while (y := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(y, y)
        return x


def overlaps(x: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Exact sizes of the intersections of one sorted set with several, in one search."""
    joined = np.concatenate(others)
    at = np.searchsorted(x, joined)
    at[at == len(x)] = 0
    starts = np.concatenate([[0], np.cumsum([len(o) for o in others])[:-1]])
    return np.add.reduceat((x[at] == joined).astype(np.int64), starts)


class _SmallSets:
    """The small sets of one tile, their shingles numbered, so that an intersection is a look-up and not a search."""

    def __init__(self, sets: dict, most: float):
        self.sets = {c: s for c, s in sets.items() if len(s) <= most}
        if self.sets:
            known, number = np.unique(np.concatenate(list(self.sets.values())), return_inverse=True)
            ends = np.cumsum([len(s) for s in self.sets.values()])
            self.sets = dict(zip(self.sets, np.split(number.astype(np.int32), ends[:-1])))
            self.hit = np.zeros(len(known), np.uint8)

    def overlaps(self, x: int, others: list[int]) -> np.ndarray:
        """Exact sizes of the intersections of one class's set with those of several."""
        sets = [self.sets[o] for o in others]
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
        self.hit[self.sets[x]] = 1
        same = np.add.reduceat(self.hit[np.concatenate(sets)], starts, dtype=np.int64)
        self.hit[self.sets[x]] = 0
        return same


def tile_links(left: list[int], right: list[int], parts: dict, regs: dict, sets: dict, percent: int) -> list[tuple]:
    """Confirmed links that connect the components found in a tile, left against right."""
    forest = _Forest()
    share = percent / 100.0
    floor = share - SLACK * np.sqrt(share * (1 - share) / REGISTERS)
    table = np.stack([regs[r] for r in right])
    size = np.array([len(sets[r]) for r in right])
    few = _SmallSets(sets, FEW * 100 / percent)       # whatever may link with a set below FEW
    links = []
    for a in left:
        n, root = len(sets[a]), forest.root(parts[a])
        fits = np.flatnonzero(100 * np.minimum(size, n) >= percent * np.maximum(size, n))
        small = np.minimum(size[fits], n) < FEW
        if not small.all():
            small[~small] = estimate(regs[a], table[fits[~small]]) >= floor
            fits = fits[small]
        fits = [j for j in fits if right[j] != a and forest.root(parts[right[j]]) != root]
        if not fits:
            continue
        if a in few.sets and size[fits].max() <= FEW * 100 / percent:
            common = few.overlaps(a, [right[j] for j in fits])
        else:
            common = overlaps(sets[a], [sets[right[j]] for j in fits])
        for j, same in zip(fits, common):
            if 100 * same >= percent * (n + size[j] - same):
                ra, rb = forest.root(parts[a]), forest.root(parts[right[j]])
                if ra != rb:
                    links.append((a, right[j]))
                    forest.up[ra] = rb
    return links


def confirm(tiles: DataFrame, payload: DataFrame, percent: int) -> DataFrame:
    """Links found in ``tiles`` (tile, side, class, part); ``payload`` has the registers and sets of classes."""
    rows = tiles.join(payload.hint("merge"), "class").select("tile", "side", "class", "part", "registers", "shingles")

    def run(group: pa.Table) -> pa.Table:
        get = lambda name: group.column(name).to_pylist()
        classes, sides = get("class"), get("side")
        parts = dict(zip(classes, get("part")))
        regs = {c: np.frombuffer(r, np.uint16) for c, r in zip(classes, get("registers"))}
        sets = {c: np.frombuffer(s, _U64) for c, s in zip(classes, get("shingles"))}
        left = sorted({c for c, s in zip(classes, sides) if s == 0})
        right = sorted({c for c, s in zip(classes, sides) if s == 1})
        found = tile_links(left, right, parts, regs, sets, percent) if left and right else []
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()),
                         "b": pa.array([b for _, b in found], pa.int64())})

    return rows.groupBy("tile").applyInArrow(run, "a long, b long")


def leader_tiles(pairs: DataFrame) -> DataFrame:
    """Tiles of one leader against at most about TILE of its members, from (leader, class) pairs."""
    size = pairs.groupBy("leader").agg(F.ceil(F.count("*") / TILE).alias("pieces"))
    dealt = pairs.join(size, "leader").withColumn("piece", F.pmod(F.xxhash64("class"), F.col("pieces")))
    tile = F.xxhash64("leader", "piece").alias("tile")
    members = dealt.select(tile, F.lit(1).alias("side"), "class")
    heads = size.select("leader", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).alias("piece")) \
        .select(tile, F.lit(0).alias("side"), F.col("leader").alias("class"))
    return members.unionByName(heads).withColumn("part", F.col("class"))


def rest_tiles(buckets: DataFrame) -> DataFrame:
    """Tiles for buckets (key, class, part) that still hold several components.

    Every class outside a bucket's largest component meets all other classes of the bucket.  Classes of
    one neighbourhood are put together, in pieces of TILE, so a partner is sent once per piece, not per class.
    """
    sized = buckets.groupBy("key", "part").agg(F.count("*").alias("n"))
    largest = sized.groupBy("key").agg(F.max(F.struct("n", "part")).alias("m"), F.count("*").alias("parts"))
    open_ = largest.where("parts > 1").select("key", F.col("m.part").alias("main"))
    held = materialize(buckets.join(open_, "key"), "lsh-open")
    # neighbourhoods: a few rounds of the least label over shared buckets (only the packing depends on them)
    home = held.select("class", F.col("class").alias("home")).distinct()
    for _ in range(HOME_ROUNDS):
        least = held.select("key", "class").join(home, "class").groupBy("key").agg(F.min("home").alias("home"))
        home = materialize(held.select("key", "class").join(least, "key").groupBy("class")
                           .agg(F.min("home").alias("home")), "lsh-homes")
    left = held.where("part <> main").select("class", "part").distinct().join(home, "class")
    pieces = left.groupBy("home").agg(F.ceil(F.count("*") / TILE).alias("lefts"))
    left = materialize(left.join(pieces, "home").withColumn("l", F.pmod(F.xxhash64("class"), F.col("lefts"))),
                       "lsh-left")
    # partners of a left piece: everything in the buckets of its classes
    homes = held.join(left.select("class", "home", "l"), "class").select("key", "home", "l").distinct()
    right = held.select("key", "class", "part").join(homes, "key").select("home", "l", "class", "part").distinct()
    counts = right.groupBy("home", "l").agg(F.ceil(F.count("*") / TILE).alias("rights"))
    right = right.join(counts, ["home", "l"]).withColumn("r", F.pmod(F.xxhash64("class"), F.col("rights")))
    tile = F.xxhash64("home", "l", "r").alias("tile")
    every = left.join(counts, ["home", "l"]).withColumn(
        "r", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rights") - 1)))
    return (every.select(tile, F.lit(0).alias("side"), "class", "part")
            .unionByName(right.select(tile, F.lit(1).alias("side"), "class", "part")))


def _components(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``doc_id, n_shingles, digest, component, component_id`` for every row; no component without words."""
    sketches = materialize(sketch_documents(docs, words).withColumn("row", F.monotonically_increasing_id()),
                           "sketches")
    named = materialize(sketches.where("digest is not null").groupBy("digest")
                        .agg(F.min("row").alias("class"), F.min("doc_id").alias("doc_id")), "classes")
    one = named.select(F.col("class").alias("row"), "class")
    classes = materialize(sketches.select("row", "registers").join(one.hint("merge"), "row")
                          .select("class", "registers"), "class-registers")

    buckets = materialize(candidate_buckets(classes), "lsh-buckets")
    wanted = materialize(named.join(buckets.select("class").distinct(), "class"), "candidates")
    payload = class_sets(docs, wanted, words)

    pairs = materialize(buckets.where("class <> leader").select("leader", "class").distinct(), "lsh-pairs")
    links = materialize(confirm(leader_tiles(pairs), payload, percent), "links")
    parts = connected_components(links)
    labelled = buckets.select("key", "class").join(parts.withColumnRenamed("node", "class"), "class", "left") \
        .select("key", "class", F.coalesce("component", "class").alias("part"))
    rest = materialize(confirm(rest_tiles(labelled), payload, percent), "links-rest")
    # a link joins two components whole: what the first pass connected stays connected
    final = connected_components(links.unionByName(rest)) if rest.head(1) else parts

    member = named.select("digest", "class", "doc_id").join(
        final.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "component", F.coalesce("component", "class"))
    least = member.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_digest = member.join(least, "component").select("digest", "component", "component_id")
    rows = sketches.select("doc_id", "n_shingles", "digest")
    alone = rows.where("digest is null").withColumn("component", F.lit(None).cast("long")) \
        .withColumn("component_id", F.col("doc_id"))
    return rows.where("digest is not null").join(by_digest, "digest").unionByName(alone) \
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (doc_id, text)."""
    return _components(docs, words, percent).select("doc_id", "n_shingles", "component_id", "kept")


def keep_first(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group stays, with all columns of ``docs``: the one with the smallest doc_id.

    Rows whose doc_id is null or repeated are told apart by their digest: of a group without ids the row with the
    smallest digest stays, rows that repeat doc_id and set count once, rows without words once per doc_id and text.
    """
    found = materialize(_components(docs, words, percent).select("doc_id", "digest", "component", "kept"),
                        "near-decided")
    gone = found.where("not kept").select(F.col("doc_id").alias("__id"))
    unclear = materialize(found.groupBy(F.col("doc_id").alias("__id")).agg(F.count("*").alias("n"))
                          .where("n > 1 or __id is null").select("__id"), "near-unclear")
    rows = packed(docs, F.col("doc_id").cast("long").alias("__doc_id"), F.col("text").cast("string").alias("text"))
    same_id = F.col("__doc_id").eqNullSafe(F.col("__id"))
    if not unclear.head(1):
        maybe, sure = split_rows(rows, "__doc_id", gone)
        return unpacked(sure.unionByName(maybe.join(gone, same_id, "left_anti")))
    maybe, sure = split_rows(rows, "__doc_id", gone.unionByName(unclear))
    plain = maybe.join(gone.unionByName(unclear), same_id, "left_anti")
    told = _with_digests(maybe.join(unclear, same_id, "left_semi"), words)
    first = found.where("component is not null").groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("lost"), "doc_id", "digest")).alias("w")) \
        .select(F.col("w.doc_id").alias("__id"), F.col("w.digest").alias("__wins"))
    stays = told.join(first, same_id & (F.col("__digest") == F.col("__wins"))).groupBy("__doc_id", "__digest") \
        .agg(F.min_by("__doc", "text").alias("__doc"))
    silent = told.where("__digest is null").groupBy("__doc_id", "text").agg(F.first("__doc").alias("__doc"))
    return unpacked(sure.select("__doc").unionByName(plain.select("__doc")).unionByName(stays.select("__doc"))
                    .unionByName(silent.select("__doc")))


def _with_digests(rows: DataFrame, words: int) -> DataFrame:
    """``rows`` (__doc, __doc_id, text) with the digest of their shingle set."""
    def make() -> Callable[..., tuple]:
        hashes = _WordHashes()

        def row(doc, doc_id, text):
            s = shingle_set(text, words, hashes)
            return doc, doc_id, text, (xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
        return row

    schema = StructType().add(rows.schema["__doc"]).add("__doc_id", "long").add("text", "string")
    return map_rows(rows, ["__doc", "__doc_id", "text"], schema.add("__digest", "binary"), make)
