"""Divergence of term use between the sources of a language, by merging sorted term arrays per pair of sources.

*Counts.*  Every task counts the terms of its documents in Python dictionaries (occurrences per language, source and
term; documents per language and term) and hands on what it has whenever they reach ``ENTRIES``, so a frequent term
or a hot source is one row per task before the shuffle.  Terms in at least ``least`` documents of their language are
kept.

*Term ids.*  The kept terms of a language are dealt by hash to buckets of about ``BUCKET`` terms and numbered in
order inside their bucket, so every array below is bounded whatever the vocabulary or a source holds.  A source's
part of a bucket is two arrays sorted by term id: ids and counts.

*Pairs.*  Sources of a language are dealt to tiles of ``TILE``; one task gets the arrays of one bucket and two tiles
and merges every unordered pair in them once.  The shorter id array gallops through the longer one (a binary search
that starts from the place of the id before), which splits the pair's terms into common ones, those of one side and
those of neither; the divergence is priced for all three, in both directions, in exact integers.  Partial sums of the
buckets are added.  An array is copied once per tile of its language, not once per partner.

A price is p = 1 + floor(unit * (count + 1) / (N + V)) with N the source's (or language's) occurrences of kept terms
and V the number of kept terms; the divergence of a term is floor((p - q)**2 / q).

Defined results: null text, lang and source read as ''.  A source without kept terms has N = 0 and is still a group
and an item; a language with V = 0 has the value 0 for all its pairs.  A language with one source has no pair.  Ranks
order by value, then by the item's UTF-8 bytes.  Repeated rows count each time; doc_id is not used.  An empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandcast.llm.common import materialize

UNIT = 1_000_000_000
#: Bytes of terms: those of letters, only A-Z lowered, and of characters over 7F; every other byte becomes a space.
TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256)).lower()
ENTRIES = 300_000               # terms counted in a task before they are handed on
BUCKET = 32_768                 # kept terms in a bucket, on average
TILE = 16                       # sources in a tile
LARGE = 9_000_000_000           # counts from here on are priced with Python integers


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents of every term, partly added up by the tasks.

    A row with a null term says that the group occurs.
    """
    names = ["lang", "source", "term", "n", "docs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0

        def handed_on() -> Iterator[pa.RecordBatch]:
            for (lang, source), (count, within) in groups.items():
                size = len(count) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * size), pa.array([source] * size),
                     pa.array([None, *count], pa.binary()).cast(pa.string()),
                     pa.array([0, *count.values()], pa.int64()), pa.array([0, *map(within.__getitem__, count)], pa.int64())],
                    names=names)
            groups.clear()

        for batch in batches:
            texts = batch.column(0).cast(pa.binary())
            for at, group in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                words = texts[at].as_py().translate(TERM_BYTES).split()
                if group not in groups:
                    groups[group] = Counter(), Counter()
                count, within = groups[group]
                before = len(count)
                count.update(words)
                within.update(set(words))
                held += len(count) - before
                if held >= ENTRIES:
                    yield from handed_on()
                    held = 0
        yield from handed_on()

    part = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    return part.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def price(count: Column, n: Column, terms: Column) -> Column:
    whole = (F.lit(UNIT).cast("decimal(12,0)") * (count + 1).cast("decimal(20,0)")).cast("decimal(38,0)")
    share = F.call_function("div", whole, (n + terms).cast("decimal(20,0)"))
    return (share + 1).cast("long")


def diverge(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def prices(count: np.ndarray, n: int, terms: int) -> np.ndarray:
    """The same price for an array of counts."""
    if len(count) and int(count.max()) >= LARGE:
        return np.array([1 + UNIT * (int(c) + 1) // (n + terms) for c in count], dtype=np.int64)
    return 1 + UNIT * (count + 1) // (n + terms)


def _sum(p: np.ndarray, q: np.ndarray) -> int:
    """Exact sum of floor((p - q)**2 / q); a bucket's prices add up to little over UNIT, so no step leaves a long."""
    return int(((p - q) * (p - q) // q).sum())


def gallop(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in both sorted arrays of their common ids.

    ``searchsorted`` looks up sorted keys each from the place of the one before.
    """
    at = np.searchsorted(long, short)
    at[at == len(long)] = 0
    same = long[at] == short if len(long) else np.zeros(len(short), dtype=bool)
    return np.flatnonzero(same), at[same]


def pair_sums(a: tuple, b: tuple, terms: int) -> tuple[int, int, int]:
    """Both directions' divergence over the terms that a or b holds in a bucket, and the number of those terms.

    A side is (ids, counts, N); ``terms`` is V of the language.
    """
    if len(a[0]) > len(b[0]):
        back, forth, union = pair_sums(b, a, terms)
        return forth, back, union
    in_a, in_b = gallop(a[0], b[0])
    pa_, pb = prices(a[1], a[2], terms), prices(b[1], b[2], terms)
    a0, b0 = (1 + UNIT // (side[2] + terms) for side in (a, b))
    only_a, only_b = np.delete(pa_, in_a), np.delete(pb, in_b)
    forth = _sum(pa_[in_a], pb[in_b]) + _sum(only_a, np.int64(b0)) + _sum(np.full(len(only_b), a0), only_b)
    back = _sum(pb[in_b], pa_[in_a]) + _sum(only_b, np.int64(a0)) + _sum(np.full(len(only_a), b0), only_a)
    return forth, back, len(pa_) + len(only_b)


def _merge_tiles(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """All unordered pairs of one bucket whose sources lie in the two tiles of the key."""
    lang, _, left, right = (k.as_py() for k in key)
    sides: dict[int, list] = {left: [], right: []}
    for r in rows.sort_by("source").to_pylist():
        sides[r["tile"]].append((r["source"], (np.array(r["ids"], np.int32), np.array(r["counts"], np.int64), r["total"]),
                                 r["terms"]))
    out = []
    for i, (name, a, terms) in enumerate(sides[left]):
        for other, b, _ in (sides[left][i + 1:] if left == right else sides[right]):
            forth, back, union = pair_sums(a, b, terms) if terms else (0, 0, 0)
            out += [(lang, name, other, forth, union), (lang, other, name, back, union)]
    return pa.Table.from_pylist([dict(zip(("lang", "source", "item", "part_sum", "part_terms"), r)) for r in out],
                                schema=pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()),
                                                  ("part_sum", pa.int64()), ("part_terms", pa.int64())]))


def audit(docs: DataFrame, least: int = 3, top: int = 200, bucket: int = BUCKET, tile: int = TILE) -> DataFrame:
    """``lang, source, part, item, value, rank`` of every group: its pairs, and its ``top`` terms above the language."""
    counted = materialize(term_counts(docs).groupBy("lang", "source", "term")
                          .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "terms")
    vocabulary = materialize(
        counted.where("term IS NOT NULL").groupBy("lang", "term")
        .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least).drop("docs"), "vocabulary")
    languages = vocabulary.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count("*").alias("terms"))
    numbered = (vocabulary.join(languages, "lang")
                .withColumn("buckets", F.ceil(F.col("terms") / bucket).cast("long"))
                .withColumn("bucket", F.pmod(F.xxhash64("term"), F.col("buckets")))
                .withColumn("id", F.row_number().over(Window.partitionBy("lang", "bucket").orderBy("term")) - 1)
                .drop("buckets"))
    kept = materialize(counted.where("term IS NOT NULL").select("lang", "source", "term", "n")
                       .join(numbered, ["lang", "term"]), "kept-terms")
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    in_lang = Window.partitionBy("lang")
    groups = materialize(
        counted.where("term IS NULL").select("lang", "source").join(sizes, ["lang", "source"], "left")
        .join(languages.select("lang", "terms"), "lang", "left").na.fill(0, ["total", "terms"])
        .withColumn("buckets", F.greatest(F.ceil(F.col("terms") / bucket), F.lit(1)).cast("long"))
        .withColumn("tile", F.floor((F.row_number().over(in_lang.orderBy("source")) - 1) / tile).cast("int"))
        .withColumn("tiles", F.floor((F.count("*").over(in_lang) - 1) / tile).cast("int") + 1), "groups")
    out = _pairs(kept, groups).unionByName(_terms(kept, groups, top))
    return out.select("lang", "source", "part", "item", "value", "rank")


def _pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    # every group stands in all buckets of its language, so that terms of one side are priced against it
    rows = kept.select("lang", "source", "bucket", F.struct("id", "n").alias("entry")).unionByName(
        groups.select("lang", "source", F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1)).alias("bucket"),
                      F.lit(None).cast("struct<id:int,n:bigint>").alias("entry")))
    arrays = (rows.groupBy("lang", "source", "bucket").agg(F.sort_array(F.collect_list("entry")).alias("entries"))
              .select("lang", "source", "bucket", F.col("entries.id").alias("ids"), F.col("entries.n").alias("counts"))
              .join(groups.drop("buckets"), ["lang", "source"]))
    dealt = (arrays.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
             .withColumn("left", F.least("tile", "other")).withColumn("right", F.greatest("tile", "other"))
             .select("lang", "bucket", "left", "right", "tile", "source", "total", "terms", "ids", "counts"))
    merged = (dealt.groupBy("lang", "bucket", "left", "right")
              .applyInArrow(_merge_tiles, "lang string, source string, item string, part_sum long, part_terms long")
              .groupBy("lang", "source", "item").agg(F.sum(F.col("part_sum").cast("decimal(38,0)")).alias("held"),
                                                     F.sum("part_terms").alias("held_terms")))
    return _ranked(_with_absent(merged, groups), "pair")


def _with_absent(merged: DataFrame, groups: DataFrame) -> DataFrame:
    """Adds the terms that neither source holds, all at one price each."""
    own = groups.select("lang", "source", "terms", F.col("total").alias("n_own"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("total").alias("n_other"))
    p = price(F.lit(0).cast("long"), F.col("n_own"), F.col("terms"))
    q = price(F.lit(0).cast("long"), F.col("n_other"), F.col("terms"))
    absent = (F.col("terms") - F.col("held_terms")).cast("decimal(20,0)") * diverge(p, q).cast("decimal(18,0)")
    value = F.when(F.col("terms") > 0, F.col("held") + absent).otherwise(0).cast("long")
    return merged.join(own, ["lang", "source"]).join(other, ["lang", "item"]).select(
        "lang", "source", "item", value.alias("value"))


def _terms(kept: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    p = price(F.col("n"), F.col("total"), F.col("terms"))
    q = price(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    rows = (kept.join(groups.select("lang", "source", "total"), ["lang", "source"])
            .select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
            .select("lang", "source", "item", diverge(F.col("p"), F.col("q")).alias("value")))
    return _ranked(rows, "term").where(F.col("rank") <= top)


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("part", F.lit(part)).withColumn("rank", F.row_number().over(order))


ORACLE_SQL = r"""WITH docs AS (SELECT row_number() OVER () AS r, COALESCE(lang, '') AS lang, COALESCE(source, '') AS source,
  translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
grp AS (SELECT DISTINCT lang, source FROM docs),
words AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
vocab AS (SELECT lang, term, COUNT(*) AS lang_n FROM words GROUP BY lang, term HAVING COUNT(DISTINCT r) >= 3),
langs AS (SELECT lang, SUM(lang_n) AS total, COUNT(*) AS v FROM vocab GROUP BY lang),
cnt AS (SELECT lang, source, term, COUNT(*) AS n FROM words SEMI JOIN vocab USING (lang, term) GROUP BY lang, source, term),
tot AS (SELECT lang, source, COALESCE(SUM(n), 0) AS total FROM grp LEFT JOIN cnt USING (lang, source) GROUP BY lang, source),
p AS (SELECT lang, source, term, COALESCE(n, 0) AS n, lang_n,
    CAST(1 + CAST(1000000000 AS HUGEINT) * (COALESCE(n, 0) + 1) // (tot.total + v) AS HUGEINT) AS p,
    CAST(1 + CAST(1000000000 AS HUGEINT) * (lang_n + 1) // (langs.total + v) AS HUGEINT) AS q
  FROM tot JOIN vocab USING (lang) JOIN langs USING (lang) LEFT JOIN cnt USING (lang, source, term)),
pairs AS (SELECT a.lang, a.source, b.source AS item, COALESCE(SUM(f), 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS other, (x.p - y.p) * (x.p - y.p) // y.p AS f
             FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source) t
    ON t.lang = a.lang AND t.source = a.source AND t.other = b.source
  GROUP BY a.lang, a.source, b.source),
terms AS (SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
    CAST(ROW_NUMBER() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT *, 'pair' AS part FROM pairs UNION ALL SELECT *, 'term' AS part FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200"""
