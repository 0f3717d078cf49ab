"""K-d tree sharding by bytes, with DataFrame operations only.

Every document is a point of metadata (size, language, source, characters) weighted by its bytes.  The tree
starts with all documents and all shards; a node with ``k`` shards is split along its widest dimension (extent
relative to the whole table's) at the distributed weighted quantile that gives each side bytes in proportion to
its shards, until every leaf is one shard of the target bytes.

The quantile is found by histogram: one aggregation per pass counts bytes in ``BINS`` bins of every open node at
once (combined before the shuffle; the driver sees at most ``nodes x BINS`` rows), then the bin that holds the
target is split again.  Documents that tie in the dimension are separated by a hash of doc_id and text, so a
source or a group of copies may hold any share of the rows.  The result is a nested CASE expression over the
metadata; no row is moved to find it.

Defined results: null texts have no bytes; null languages and sources come first in their dimension; rows that
agree in doc_id and text are the same point and stay in one shard; an empty table gives an empty result; with
fewer distinct points than shards some shards stay empty.  Other columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandcast.llm.common import materialize, packed, text_or_empty

ROW_OVERHEAD = 8
BINS = 256
DIMENSIONS = ("__size", "__lang", "__source", "__chars")
TIE = "__tie"
SLOT_BLOCK_BITS = 16      # rows that are numbered in one task: 2 ** 16 at most


def _string_code(name: str) -> Column:
    """A long that orders strings by their first seven bytes; null before all."""
    head = F.rpad(F.hex(F.substring(F.encode(F.col(name).cast("string"), "UTF-8"), 1, 7)), 14, "0")
    return F.coalesce(F.conv(head, 16, 10).cast("long"), F.lit(-1).cast("long"))


def point_columns(docs: DataFrame) -> dict[str, Column]:
    """Bytes, checksum and split keys of a document."""
    text = text_or_empty()
    size = F.octet_length(text).cast("long") + ROW_OVERHEAD
    crc = F.crc32(F.encode(text, "UTF-8")).cast("long")
    code = lambda name: _string_code(name) if name in docs.columns else F.lit(-1).cast("long")
    return {"size": size, "text_crc32": crc, "__size": size, "__lang": code("lang"), "__source": code("source"),
            "__chars": F.length(text).cast("long"), TIE: F.shiftrightunsigned(F.xxhash64("doc_id", crc, size), 2)}


def points(docs: DataFrame) -> DataFrame:
    """Metadata points of ``docs``: no text."""
    return docs.select("doc_id", *[c.alias(name) for name, c in point_columns(docs).items()])


@dataclass
class Node:
    """A region of the tree: ``shards`` leaves from number ``first`` on."""

    first: int
    shards: int
    axis: str | None = None
    at: int = 0                   # rows with axis < at, or axis = at and tie <= tie_at, go left
    tie_at: int = -1
    sides: "tuple[Node, Node] | None" = None
    search: "Search | None" = field(default=None, repr=False)

    def leaves(self) -> "list[Node]":
        return [self] if self.sides is None else [x for s in self.sides for x in s.leaves()]

    def number(self) -> Column:
        """The first shard of the leaf that a row falls into."""
        if self.sides is None:
            return F.lit(self.first)
        left, right = self.sides
        goes_left = (F.col(self.axis) < self.at) | ((F.col(self.axis) == self.at) & (F.col(TIE) <= self.tie_at))
        return F.when(goes_left, left.number()).otherwise(right.number())


@dataclass
class Search:
    """The weighted quantile of one node: bytes wanted on the left, bytes known to lie left of the bracket."""

    axis: str
    low: int
    high: int
    wanted: float
    before: int = 0
    fixed: int | None = None      # the axis value, once the search goes on among its ties

    @property
    def width(self) -> int:
        return -(-(self.high - self.low + 1) // BINS)

    def row(self, node: int) -> str:
        """The search as a row of SQL VALUES: which key, its bracket and bin width, and the axis value it is tied to."""
        on_axis = DIMENSIONS.index(self.axis)
        key = on_axis if self.fixed is None else len(DIMENSIONS)
        fixed = "null" if self.fixed is None else self.fixed
        return f"({node}, {key}, {on_axis}, {self.low}L, {self.high}L, {self.width}L, CAST({fixed} AS BIGINT))"


def _bins(table: DataFrame, root: Node, searching: list[Node]) -> DataFrame:
    """Bytes, least and greatest key in every bin of every node that is searched."""
    plans = table.sparkSession.sql(
        "SELECT * FROM VALUES " + ", ".join(n.search.row(n.first) for n in searching)
        + " AS t(__node, __which, __axis, __low, __high, __width, __fixed)")        # a literal of one row per node
    pick = lambda which: F.get(F.array(*DIMENSIONS, TIE), F.col(which))
    return (table.withColumn("__node", root.number()).join(F.broadcast(plans), "__node")
            .where("__fixed is null or __fixed = get(array({}), __axis)".format(", ".join(DIMENSIONS)))
            .withColumn("__key", pick("__which")).where("__key between __low and __high")
            .groupBy("__node", F.floor((F.col("__key") - F.col("__low")) / F.col("__width")).alias("__bin"))
            .agg(F.sum("size").alias("bytes"), F.min("__key").alias("lo"), F.max("__key").alias("hi")))


def _extents(table: DataFrame, root: Node, leaves: list[Node]) -> dict[int, dict]:
    sums = [F.sum("size").alias("bytes")]
    for d in (*DIMENSIONS, TIE):
        sums += [F.min(d).alias(f"lo{d}"), F.max(d).alias(f"hi{d}")]
    open_ = [n.first for n in leaves]
    rows = table.withColumn("__node", root.number()).where(F.col("__node").isin(open_)).groupBy("__node").agg(*sums)
    return {r["__node"]: r.asDict() for r in rows.collect()}           # one row per open node


def _start(node: Node, x: dict, whole: dict) -> None:
    """Choose the widest dimension of the node and open the search on it."""
    def extent(d: str) -> float:
        return (x[f"hi{d}"] - x[f"lo{d}"]) / max(1, whole[f"hi{d}"] - whole[f"lo{d}"])

    axis = max(DIMENSIONS, key=extent)
    left = node.shards // 2
    node.axis = axis
    node.search = Search(axis, x[f"lo{axis}"], x[f"hi{axis}"], x["bytes"] * left / node.shards)


def _narrow(node: Node, bins: list, tolerance: float) -> None:
    """One pass: pick the bin that holds the target; cut there, or look into it."""
    s = node.search
    for i, b in enumerate(bins):
        if s.before + b["bytes"] >= s.wanted or i == len(bins) - 1:
            break
        s.before += b["bytes"]
    single = b["lo"] == b["hi"]
    if single and s.fixed is None and b["bytes"] > tolerance:          # ties: go on among them
        s.fixed, s.low, s.high = b["lo"], 0, (1 << 62) - 1
        return
    if not single and b["bytes"] > tolerance:
        s.low, s.high = b["lo"], b["hi"]
        return
    takes = s.wanted - s.before > b["bytes"] / 2                       # the nearer edge of the bin
    cut = b["hi"] if takes else b["lo"] - 1
    if s.fixed is None:
        node.at, node.tie_at = cut, (1 << 62)
    else:
        node.at, node.tie_at = s.fixed, cut
    node.search = None
    left = node.shards // 2
    node.sides = Node(node.first, left), Node(node.first + left, node.shards - left)


def build_tree(table: DataFrame, shards: int, slack: float = 0.001) -> Node:
    """The K-d tree over ``points``; splits are within ``slack`` of a shard's target bytes, or of one point."""
    root = Node(0, shards)
    whole = None
    while open_ := [n for n in root.leaves() if n.shards > 1]:
        found = _extents(table, root, open_)
        whole = whole or next(iter(found.values()), None)
        if whole is None:
            return root                                                # empty table
        tolerance = slack * whole["bytes"] / shards
        for n in open_:
            if n.first in found:
                _start(n, found[n.first], whole)
            else:                                                      # an empty region: nothing to weigh
                n.axis, left = DIMENSIONS[0], n.shards // 2
                n.sides = Node(n.first, left), Node(n.first + left, n.shards - left)
        while searching := [n for n in open_ if n.search]:
            rows = _bins(table, root, searching).collect()              # at most nodes x BINS rows
            for n in searching:
                _narrow(n, sorted((r for r in rows if r["__node"] == n.first), key=lambda r: r["__bin"]), tolerance)
    return root


def assign_shards(docs: DataFrame, shards: int = 24) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row of ``docs``."""
    table = materialize(points(docs).withColumn("__row", F.monotonically_increasing_id()), "kd-points")
    tree = build_tree(table, shards)
    placed = table.select("doc_id", "size", "text_crc32", tree.number().alias("shard"), "__row",
                          F.shiftright("__row", SLOT_BLOCK_BITS).alias("__block"))
    # slots: rows are numbered inside blocks of bounded size; the blocks' counts give each block its offset
    counts = placed.groupBy("shard", "__block").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("shard").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "__block", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("__offset"))
    inside = F.row_number().over(Window.partitionBy("shard", "__block").orderBy("__row"))
    return (placed.withColumn("__inside", inside).join(offsets, ["shard", "__block"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("__offset") + F.col("__inside") - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))


def write_shards(docs: DataFrame, path: str, shards: int = 24) -> None:
    """Write whole documents (a struct ``document``) as Parquet, one folder per shard (``shard=N``), in one map pass."""
    tree = build_tree(materialize(points(docs), "kd-points"), shards)
    own = packed(docs, "doc_id", "text", *[c for c in ("lang", "source") if c in docs.columns])
    keyed = own.select("__doc", *[c.alias(name) for name, c in point_columns(own).items()])
    placed = keyed.select(tree.number().alias("shard"), F.col("__doc").alias("document"))
    placed.write.partitionBy("shard").parquet(path)
