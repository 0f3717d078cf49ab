"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

*Targets.*  Sources, by code point and null last, weigh 1, 2, 3 in turn and share the words of the whole table by
weight; none may get more than ``MOST_EPOCHS`` times its own words, and what a capped source leaves is shared again
by weight.  Sources sorted by cap over weight make this a prefix: all before some source are capped, the level
of the rest is (words - caps before) / (weights left).

*Selection.*  A source first takes all its documents for as many complete epochs as fit its target; the rest of the
budget goes to a weighted sample without replacement.  Every document draws ``u`` from its doc_id and a seed; the
key ``u ** (1 / weight)`` (an exponential clock scaled by the quality weight) orders the source, best key first, and
documents are taken while the middle of the document lies inside the budget, so a source misses its target by half
a document at most.

*Scale.*  No source is ever sorted in one task: keys fall into about sqrt(n) ranges per source; words per range
give the range in which the budget ends; documents of ranges before it are taken, behind it not, and only that one
range (about sqrt(n) documents) is put in order.

Quality weight: 1 to 5, falling with the share of markup-like symbols in the text.

Defined results: null texts have no words; sources without words have target 0 and take nothing; documents without
words take 0.  Rows that repeat a doc_id have equal keys and are ordered by size.  Reruns agree whatever the
partitioning.  An empty table gives an empty result.  Other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandcast.llm.common import materialize, packed, text_or_empty, unpacked, word_count

MOST_EPOCHS = 3
SEED = "mix-1"
SYMBOLS = "#$%&*|!"        # marks of boilerplate and tables that the quality weight counts


def quality_weight() -> Column:
    """1 (all symbols) to 5 (none): integers until the last division, so any engine agrees."""
    text = text_or_empty()
    chars = F.length(text)
    plain = F.length(F.translate(text, SYMBOLS, ""))
    return F.when(chars == 0, F.lit(1.0)).otherwise(1.0 + 4.0 * plain / chars)


def uniform(seed: str) -> Column:
    """A draw in (0, 1) from doc_id: 52 bits of a hash that SQL engines share."""
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit("/" + seed))
    bits = F.conv(F.substring(F.md5(F.encode(name, "UTF-8")), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / float(1 << 52)


def measured(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """``docs`` with the source, words and key of every row in columns of their own."""
    return docs.withColumns({"__source": F.col("source").cast("string"), "__size": word_count(text_or_empty()),
                             "__key": F.pow(uniform(seed), 1.0 / quality_weight())})


def source_targets(rows: DataFrame) -> DataFrame:
    """One row per source: its words, rows, target, complete epochs, budget of the fractional part and ranges.

    The windows run over the list of sources, which is metadata (one row per source), not over documents.
    """
    sources = rows.groupBy(F.col("__source").alias("source")).agg(F.sum("__size").alias("source_size"),
                                                                  F.count("*").alias("n"))
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    weighed = sources.withColumn("weight", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("double"))
    weighed = weighed.withColumn("cap", F.col("source_size") * MOST_EPOCHS)
    all_ = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.encode("source", "UTF-8")) \
        .rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.sum("source_size").over(all_) - F.coalesce(F.sum("cap").over(fill), F.lit(0)))
             / (F.sum("weight").over(all_) - F.coalesce(F.sum("weight").over(fill), F.lit(0.0))))
    # the level rises while capped sources are taken out and falls once a free one is: its peak is the shared one
    levels = weighed.withColumn("level", level).withColumn("shared", F.max("level").over(all_))
    target = F.least(F.col("cap").cast("double"), F.col("shared") * F.col("weight"))
    return (levels.withColumn("target", target)
            .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                        .otherwise(0).cast("long"))
            .withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
            .withColumn("ranges", F.ceil(F.sqrt("n")).cast("long"))
            .select("source", "source_size", "target", "epochs", "budget", "ranges"))


def _placed(rows: DataFrame, targets: DataFrame) -> DataFrame:
    t = targets.select(F.col("source").alias("__name"), *[F.col(c).alias(f"__{c}") for c in targets.columns[1:]])
    return (rows.join(t, rows["__source"].eqNullSafe(t["__name"])).drop("__name")
            .withColumn("__range", F.floor((1.0 - F.col("__key")) * F.col("__ranges"))))


def plan(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The targets of the sources, and the range of each in which its budget ends, from ``measured`` rows."""
    targets = materialize(source_targets(rows), "mix-targets")
    words = materialize(_placed(rows, targets).groupBy("__source", "__budget", "__range")
                        .agg(F.sum("__size").alias("words")), "mix-ranges")
    ahead = Window.partitionBy("__source").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    ends = (words.withColumn("before", F.coalesce(F.sum("words").over(ahead), F.lit(0)))
            .where("before <= __budget and before + words >= __budget and words > 0")
            .groupBy(F.col("__source").alias("__name")).agg(F.min(F.struct("__range", "before")).alias("end"))
            .select("__name", F.col("end.__range").alias("__last"), F.col("end.before").alias("__before")))
    return targets, materialize(ends, "mix-ends")


def select_copies(rows: DataFrame, targets: DataFrame, ends: DataFrame) -> DataFrame:
    """``measured`` rows with ``__copies``: how often each document is taken.  Only the ends' ranges are sorted."""
    located = _placed(rows, targets)
    located = located.join(ends, located["__source"].eqNullSafe(ends["__name"]), "left").drop("__name")
    inside = F.coalesce(F.col("__range") < F.col("__last"), F.lit(False))
    far = located.where("__last is null or __range <> __last").withColumn(
        "__copies", F.col("__epochs") + inside.cast("long"))
    order = Window.partitionBy("__source").orderBy(F.desc("__key"), "doc_id", "__size")
    upto = F.col("__before") + F.sum("__size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    near = located.where("__range = __last").withColumn(
        "__copies", F.col("__epochs") + (upto - F.col("__size") / 2.0 <= F.col("__budget")).cast("long"))
    return far.unionByName(near)


def mix(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row of ``docs`` (doc_id, text, source)."""
    rows = materialize(measured(docs, seed).select("doc_id", "__source", "__size", "__key"), "mix-rows")
    return select_copies(rows, *plan(rows)).select(
        "doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"), (F.col("__copies") * F.col("__size")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of ``docs``.

    Documents without words add nothing to a source and are passed on once.
    """
    own = measured(packed(docs, "doc_id", "text", "source"), seed)
    rows = materialize(own.select("__source", "__size", "__key"), "mix-rows")
    chosen = select_copies(own, *plan(rows))
    times = F.when(F.col("__size") == 0, F.lit(1)).otherwise(F.col("__copies")).cast("int")
    return unpacked(chosen.where(times > 0).withColumn("__copy", F.explode(F.sequence(F.lit(1), times))))


#: The same rule in DuckDB: windows over whole sources in place of ranges.
ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t FROM documents
), m AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         pow((CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || '/mix-1'), 1, 13) AS BIGINT)
               AS DOUBLE) + 0.5) / 4503599627370496.0,
             1.0 / CASE WHEN length(t) = 0 THEN 1.0
                        ELSE 1.0 + 4.0 * CAST(length(translate(t, '#$%&*|!', '')) AS DOUBLE) / length(t) END) AS key
  FROM d
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(sum(size) * 3 AS BIGINT) AS cap,
         CAST((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1 AS DOUBLE) AS weight
  FROM m GROUP BY source
), l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER w, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0.0)) AS level
  FROM s WINDOW w AS (ORDER BY cap / weight, source IS NULL, encode(source)
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), g AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), max(level) OVER () * weight) AS target FROM l
), e AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM g
), p AS (
  SELECT m.doc_id, m.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS budget,
         sum(m.size) OVER (PARTITION BY m.source ORDER BY m.key DESC, m.doc_id, m.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM m JOIN e ON m.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (epochs + CASE WHEN upto - size / 2.0 <= budget THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM p
"""
