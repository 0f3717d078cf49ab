"""Nearest neighbours by randomly rotated one-bit codes.

*Index.*  Vectors are centred on the mean of all vectors, scaled to length one and turned by one random rotation;
the signs are packed into bits.  With x the code as a unit vector and o the turned vector, <x, o> is kept as the
correction scalar next to the distance to the centre.  Every vector is indexed.

*Search.*  For a turned unit query q, <x, q> / <x, o> estimates <o, q> without bias; its error is below
``confidence * sqrt((1 - <x,o>^2) / (<x,o>^2 (dim - 1)))`` with high probability.  A vector is reranked by its exact
distance only when its lower bound beats the k-th best distance so far, so the bounds, not a fixed count, choose.

*Scale.*  The table is cut into blocks of rows and the queries into blocks of queries (a stated set: ids divisible
by ``every``); a task works on one pair of blocks and returns k neighbours per query, which are merged by rank.  No
block, and nothing that a task or the driver holds, grows with the table.

Defined results: vectors that are null, empty, zero, hold null or non-finite components, or whose length is not the
table's commonest (the larger of equals) take no part.  Rows that repeat a vec_id are candidates each; as a query
an id counts once, with its smallest vector, and all rows of its id are its own.  Null ids take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 4096
QUERY_ROWS = 512
SPREAD = 32                # copies of a query block, so that row blocks meet it in as many tasks
CONFIDENCE = 3.0
SEED = 20


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, correction scalars <x, o> and distances to the centre."""
    residual = vectors - centre
    norm = np.linalg.norm(residual, axis=1)
    unit = residual / np.where(norm == 0, 1.0, norm)[:, None] @ turn.T
    bits = unit > 0
    overlap = np.where(bits, unit, -unit).sum(axis=1) / np.sqrt(vectors.shape[1])
    return np.packbits(bits, axis=1), np.where(norm == 0, 1.0, overlap), norm


def search_block(ids, vectors, codes, overlap, norm, query_ids, queries, centre, turn, k, confidence=CONFIDENCE):
    """k nearest rows of one block for each query: (query position, row, distance), by estimate, bound and rerank."""
    dim = vectors.shape[1]
    signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1
    error = confidence * np.sqrt(np.maximum(0, 1 - overlap ** 2) / (overlap ** 2 * max(1, dim - 1)))
    out = []
    for i, (own, query) in enumerate(zip(query_ids, queries)):
        residual = query - centre
        length = np.linalg.norm(residual)
        turned = turn @ (residual / length if length else residual)
        inner = signs @ turned.astype(np.float32) / np.sqrt(dim) / overlap
        base = norm ** 2 + length ** 2
        low = base - 2 * norm * length * np.minimum(1.0, inner + error)
        other = np.flatnonzero(ids != own)
        if not len(other):
            continue
        # rerank in order of the estimate; stop once no lower bound can beat the k-th exact distance
        order = other[np.argsort((base - 2 * norm * length * inner)[other], kind="stable")]
        best = order[:k]
        exact = squared(vectors[best], query)
        kth = np.inf if len(best) < k else exact.max()
        rest = order[k:]
        rest = rest[low[rest] <= kth * (1 + 1e-9)]
        if len(rest):
            best, exact = np.concatenate([best, rest]), np.concatenate([exact, squared(vectors[rest], query)])
        top = np.lexsort((ids[best], exact))[:k]
        out += [(i, best[t], np.sqrt(exact[t])) for t in top]
    return out


def squared(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Squared distances, summed component after component so that every engine gets the same double."""
    total = np.zeros(len(rows))
    for d in range(rows.shape[1]):
        gap = rows[:, d] - query[d]
        total += gap * gap
    return total


def usable(table: DataFrame) -> DataFrame:
    """``vec_id, v array<double>`` of the vectors that take part."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (table.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
            .where("vec_id is not null and size(v) > 0").where(fine).where(F.exists("v", lambda x: x != 0)))
    length = (rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"))
              .agg(F.max(F.struct("n", "dim")).alias("m")).select("m.dim").first())
    return rows.where(F.size("v") == (length.dim if length and length.dim else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


def search(table: DataFrame, neighbours: int = 10, every: int = 100) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the nearest rows for every id divisible by ``every``."""
    rows = usable(table)
    first = rows.select(F.size("v").alias("dim")).first()
    out = "query_id long, vec_id long, score double"
    if first is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim = first.dim
    sums = rows.agg(*[F.avg(F.col("v")[d]).alias(f"c{d}") for d in range(dim)]).first()
    centre, turn = np.array(list(sums), dtype=float), rotation(dim)

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows to blocks: ids, vectors, codes and scalars as byte strings."""
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                v = _matrix(part.column(1))
                codes, overlap, norm = encode(v, centre, turn)
                yield pa.RecordBatch.from_pydict({
                    "ids": [np.asarray(part.column(0)).tobytes()], "vectors": [v.tobytes()],
                    "codes": [codes.tobytes()], "overlap": [overlap.tobytes()], "norm": [norm.tobytes()]})

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                get = lambda name, kind=np.float64: np.frombuffer(batch.column(name)[r].as_py(), kind)
                ids, queries = get("ids", np.int64), get("q_vectors").reshape(-1, dim)
                query_ids = get("q_ids", np.int64)
                found = search_block(ids, get("vectors").reshape(-1, dim),
                                     get("codes", np.uint8).reshape(len(ids), -1), get("overlap"), get("norm"),
                                     query_ids, queries, centre, turn, neighbours)
                yield pa.RecordBatch.from_pydict({
                    "query_id": pa.array([int(query_ids[i]) for i, _, _ in found], pa.int64()),
                    "vec_id": pa.array([int(ids[j]) for _, j, _ in found], pa.int64()),
                    "score": pa.array([float(s) for _, _, s in found], pa.float64())})

    blocks = rows.mapInArrow(block, "ids binary, vectors binary, codes binary, overlap binary, norm binary")
    asked = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    n_blocks = max(1, -(-asked.count() // QUERY_ROWS))

    def gather(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        ids = np.asarray(group.column("vec_id").combine_chunks())
        v = _matrix(group.column("v").combine_chunks())
        return pa.table({"q": pa.array([key[0].as_py()], pa.int32()), "q_ids": [ids.tobytes()],
                         "q_vectors": [v.tobytes()]})

    # query blocks: hashed to blocks of about QUERY_ROWS; every row block meets each of them once, at one copy
    questions = (asked.withColumn("q", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int"))
                 .groupBy("q").applyInArrow(gather, "q int, q_ids binary, q_vectors binary"))
    questions = questions.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    met = (blocks.withColumn("copy", F.pmod(F.xxhash64("ids"), F.lit(SPREAD)).cast("int"))
           .withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).join(questions, ["q", "copy"]))
    near = met.drop("q", "copy").mapInArrow(pairs, out)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= neighbours)
            .select("query_id", "rank", "vec_id", "score"))


#: Brute force in DuckDB.
ORACLE_SQL = r"""
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), d AS (
  SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_prepend(CAST(0 AS DOUBLE), list_transform(
           list_zip(q.v, c.v), lambda x: (x[1] - x[2]) * (x[1] - x[2]))), lambda a, b: a + b)) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""
