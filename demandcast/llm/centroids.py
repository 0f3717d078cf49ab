"""Centroid clustering in exact integers, filtered by n-simplex projection.

*Projection.*  A few pivots are vectors of the table.  Their mutual distances fix a simplex; a point with known
distances to all pivots is the apex over that simplex: its coordinates follow from the distances by one triangular
solve, the last one is the altitude over the pivots' plane.  The Euclidean distance of two apexes is a lower bound
of the distance of the two points, and with one altitude turned over an upper bound.  The apex of every vector is
written beside the vector once; a round only projects its centroids.

*Round.*  Every task bounds each vector's distance to every centroid by the apexes, leaves out the centroids whose
lower bound lies above the least upper bound, and compares the others by exact integer squared distance (ties: the
smaller number).  The task adds its vectors up per centroid, so a round sends centroids x components sums, whatever
the size of the table, and the driver holds the centroids only.

Defined results: rows whose vector is null, of another length, or holds null or non-finite components take no part.
Integers beyond 2**61 either way are set to that bound and squared distances and their sums beyond 2**63 - 1 to that
value (components up to 16,000,000 never meet either).  A null vec_id hashes as ``<seed>:`` and its row is returned.
Of equal hashes the smaller vector comes first.  With fewer vectors than centroids every vector starts one; an empty
table gives an empty result.  Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandcast.llm.common import materialize

LARGEST = (1 << 63) - 1
BOUND = 1 << 61
SAFE = 1 << 27                  # up to here 64 squared differences add up within a long
PIVOTS = 16
SLACK = 1e-6                    # bounds are widened by this share of the squared distances they come from
ROWS = 4096                     # vectors compared at a time


def kept_vectors(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """``vec_id, ints``: floor(scale * x) of every component of the rows that take part."""
    x = F.col("embedding").cast("array<double>")
    whole = F.coalesce(F.size("embedding") == dims, F.lit(False)) & F.coalesce(
        F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))
    ints = F.transform(x, lambda c: F.greatest(F.least(F.floor(c * F.lit(float(scale))).cast("long"), F.lit(BOUND)),
                                               F.lit(-BOUND)))
    return vectors.where(whole).select(F.col("vec_id").cast("long").alias("vec_id"), ints.alias("ints"))


def first_by_hash(kept: DataFrame, prefix: str, n: int) -> list[list[int]]:
    """The ``n`` vectors with the smallest sha256 of ``<prefix>:<vec_id>``."""
    name = F.concat(F.lit(f"{prefix}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    return [list(r.ints) for r in kept.select(F.sha2(name, 256).alias("h"), "ints").orderBy("h", "ints").limit(n)
            .collect()]


@dataclass
class Simplex:
    """Pivots and the matrix that turns distances to them into apex coordinates."""

    points: np.ndarray          # pivots x dims
    squares: np.ndarray         # squared norms of the pivots' own coordinates (the first is the origin)
    solve: np.ndarray           # inverse of the triangular matrix of those coordinates

    @classmethod
    def over(cls, candidates: list[list[int]], pivots: int, least: float = 0.1) -> "Simplex":
        """The first ``pivots`` candidates that stand clear of the plane of those before them."""
        points, rows = [np.array(candidates[0], dtype=float)], []
        for c in candidates[1:]:
            if len(points) >= pivots:
                break
            trial = cls._of(points, rows)
            p = np.array(c, dtype=float)
            apex = trial.apexes(p[None, :])[0]
            if apex[-1] > least * np.sqrt((apex * apex).sum()) > 0:
                points.append(p)
                rows.append(apex)
        return cls._of(points, rows)

    @classmethod
    def _of(cls, points: list[np.ndarray], rows: list[np.ndarray]) -> "Simplex":
        n = len(rows)
        low = np.zeros((n, n))
        for i, r in enumerate(rows):
            low[i, :len(r)] = r
        return cls(np.array(points), (low * low).sum(1), np.linalg.inv(low) if n else low)

    def apexes(self, v: np.ndarray) -> np.ndarray:
        """Apex coordinates (one per pivot) of the rows of ``v`` from their distances to the pivots."""
        square = np.stack([((v - p) ** 2).sum(1) for p in self.points], axis=1)
        base = ((square[:, :1] - square[:, 1:] + self.squares) / 2) @ self.solve.T
        height = np.sqrt(np.maximum(square[:, 0] - (base * base).sum(1), 0.0))
        return np.concatenate([base, height[:, None]], axis=1)


def candidates(apex: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Which centroids (columns) may be nearest to which vectors (rows), by the apex bounds."""
    flat = ((apex[:, None, :-1] - centres[None, :, :-1]) ** 2).sum(2)
    a, c = apex[:, None, -1], centres[None, :, -1]
    slack = SLACK * ((apex * apex).sum(1)[:, None] + (centres * centres).sum(1)[None, :] + 1.0)
    lower, upper = flat + (a - c) ** 2 - slack, flat + (a + c) ** 2 + slack
    return lower <= upper.min(axis=1, keepdims=True)


def nearest(v: np.ndarray, apex: np.ndarray, centroids: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid and exact squared distance of every row of ``v``; also the exact comparisons made."""
    rows, cols = np.nonzero(candidates(apex, centres))
    small = max(np.abs(v).max(initial=0), np.abs(centroids).max(initial=0)) <= SAFE
    kind = np.int64 if small else object
    diff = v[rows].astype(kind) - centroids[cols].astype(kind)
    exact = (diff * diff).sum(axis=1)
    table = np.full((len(v), len(centroids)), 1 << 200 if kind is object else LARGEST, dtype=kind)
    table[rows, cols] = exact
    number = np.argmin(table, axis=1).astype(np.int32)
    best = table[np.arange(len(v)), number]
    return number, np.minimum(best, LARGEST).astype(np.int64), len(rows)


def _arrays(batch: pa.RecordBatch, width: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    for at in range(0, batch.num_rows, ROWS):
        part = batch.slice(at, ROWS)
        ints = part.column("ints").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
        apex = part.column("apex").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, width)
        yield part.column("vec_id"), ints, apex


def with_apexes(kept: DataFrame, simplex: Simplex) -> DataFrame:
    """The vectors with their apex coordinates."""
    schema = pa.schema([("vec_id", pa.int64()), ("ints", pa.list_(pa.int64())), ("apex", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            v = b.column("ints").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1).astype(float)
            apex = simplex.apexes(v)
            ends = pa.array(np.arange(len(v) + 1, dtype=np.int32) * apex.shape[1])
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("ints").cast(pa.list_(pa.int64())),
                 pa.ListArray.from_arrays(ends, pa.array(apex.ravel()))], schema=schema)

    return kept.mapInArrow(run, "vec_id long, ints array<long>, apex array<double>")


def round_sums(table: DataFrame, simplex: Simplex, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Count and component sums of the vectors nearest to each centroid."""
    centres = simplex.apexes(centroids.astype(float))
    width, dims = len(simplex.points), centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(centroids), dtype=np.int64)
        total = np.zeros((len(centroids), dims), dtype=object)
        for batch in batches:
            for _, v, apex in _arrays(batch, width):
                number, _, _ = nearest(v, apex, centroids, centres)
                count += np.bincount(number, minlength=len(centroids))
                for c in np.unique(number):
                    mine = v[number == c]
                    safe = np.abs(mine).max() <= SAFE
                    total[c] += (mine.sum(axis=0) if safe else mine.astype(object).sum(axis=0)).astype(object)
        used = np.flatnonzero(count)
        columns = [pa.array(np.repeat(used, dims + 1), pa.int32()),
                   pa.array(np.tile(np.arange(-1, dims), len(used)), pa.int32()),
                   pa.array([Decimal(int(x)) for c in used for x in (count[c], *total[c])], pa.decimal128(38, 0))]
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "at", "total"])

    partial = table.mapInArrow(run, "cluster int, at int, total decimal(38,0)")
    rows = partial.groupBy("cluster", "at").agg(F.sum("total").alias("total")).collect()      # centroids x components
    out: dict[int, tuple[int, list[int]]] = {}
    for c in {r.cluster for r in rows}:
        mine = {r["at"]: int(r["total"]) for r in rows if r.cluster == c}
        out[c] = (mine[-1], [mine[i] for i in range(dims)])
    return out


def assignments(table: DataFrame, simplex: Simplex, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance, compared``: the last column counts the exact comparisons of the row's block."""
    centres = simplex.apexes(centroids.astype(float))
    width = len(simplex.points)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, v, apex in _arrays(batch, width):
                number, square, compared = nearest(v, apex, centroids, centres)
                first = np.zeros(len(v), dtype=np.int64)
                first[0] = compared
                yield pa.RecordBatch.from_arrays([ids, pa.array(number), pa.array(square), pa.array(first)],
                                                 names=["vec_id", "cluster", "distance", "compared"])

    return table.mapInArrow(run, "vec_id long, cluster int, distance long, compared long")


def fit(table: DataFrame, simplex: Simplex, start: np.ndarray, rounds: int) -> np.ndarray:
    """Centroids after ``rounds`` rounds: the exact floor of the mean; a centroid without vectors stays."""
    centroids = start
    for _ in range(rounds):
        moved = centroids.copy()
        for c, (n, sums) in round_sums(table, simplex, centroids).items():
            moved[c] = [s // n for s in sums]
        if (moved == centroids).all():         # every later round would repeat this one
            break
        centroids = moved
    return centroids


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: str = "3",
            pivots: int = PIVOTS) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector that takes part."""
    spark = vectors.sparkSession
    kept = kept_vectors(vectors, dims, scale)
    start = first_by_hash(kept, seed, k)
    if not start:
        return kept.select("vec_id", F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in (
            "distance", "cluster_inertia", "inertia")], F.lit("").alias("centroid_sha256"))
    simplex = Simplex.over(first_by_hash(kept, f"{seed}:pivot", 4 * pivots), pivots)
    table = materialize(with_apexes(kept, simplex), "apexes")
    centroids = fit(table, simplex, np.array(start, dtype=np.int64), rounds)
    rows = materialize(assignments(table, simplex, centroids).drop("compared"), "assigned")
    sums = {r.cluster: int(r.total) for r in rows.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}             # one row per centroid
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    facts = [(c, min(s, LARGEST), min(sum(sums.values()), LARGEST), digest[c]) for c, s in sorted(sums.items())]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle_sql(k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: str = "3") -> str:
    """The same rounds written out as one common table expression each, for DuckDB."""
    parts = [f"""kept AS MATERIALIZED (SELECT vec_id, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings WHERE len(embedding) = {dims}
  AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(CAST(x AS DOUBLE))]) = {dims})""",
             "comp AS MATERIALIZED (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM kept)",
             f"""first AS (SELECT vec_id, ROW_NUMBER() OVER (ORDER BY sha256('{seed}:' || CAST(vec_id AS VARCHAR)), v) - 1 AS c
  FROM kept QUALIFY c < {k})""",
             "c0 AS MATERIALIZED (SELECT c, d, x FROM first JOIN comp USING (vec_id))"]
    for i in range(rounds + 1):
        parts.append(f"""d{i} AS (SELECT p.vec_id, m.c, SUM((p.x - m.x) * (p.x - m.x)) AS dist FROM comp p JOIN c{i} m USING (d)
  GROUP BY p.vec_id, m.c)""")
        parts.append(f"""a{i} AS MATERIALIZED (SELECT vec_id, c, dist FROM d{i}
  QUALIFY ROW_NUMBER() OVER (PARTITION BY vec_id ORDER BY dist, c) = 1)""")
        if i < rounds:
            # // truncates towards zero in DuckDB: a negative sum with a remainder goes one lower
            parts.append(f"""m{i} AS (SELECT c, d, SUM(x) AS s, COUNT(*) AS n FROM a{i} JOIN comp USING (vec_id) GROUP BY c, d)""")
            parts.append(f"""c{i + 1} AS MATERIALIZED (SELECT c, d, CAST(COALESCE(CAST(s // n AS BIGINT)
    - CASE WHEN s < 0 AND s % n <> 0 THEN 1 ELSE 0 END, x) AS BIGINT) AS x FROM c{i} LEFT JOIN m{i} USING (c, d))""")
    last = rounds
    return "WITH " + ",\n".join(parts) + f""",
h AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{last} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(dist AS BIGINT) AS distance,
  CAST(SUM(dist) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(SUM(dist) OVER () AS BIGINT) AS inertia,
  centroid_sha256 FROM a{last} JOIN h USING (c)"""


ORACLE_SQL = oracle_sql()
