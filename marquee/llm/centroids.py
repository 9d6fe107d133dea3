"""Operator 11: centroid clustering with a bisector tournament.

Vectors are integers (components times a scale, floored).  For centroids i < j
a vector is at least as near to i if (2 c_j - 2 c_i) . x <= |c_j|^2 - |c_i|^2,
so normals and thresholds of all pairs are made once a round and k - 1 sign
tests leave the nearest centroid: each test drops a loser, and zero is for the
smaller number.  Only the last distance is computed, exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .util import materialize, table

NARROW = 1 << 26  # below this all sums of 64 products fit 64 bits; larger components are Python integers
LIMB = 40  # bits in which sums of large components travel
LONG_MAX = (1 << 63) - 1
ROWS = 8192  # vectors in one array


@dataclass(frozen=True)
class Plan:
    """Centroids, components, rounds, the scale of a component, and the word that seeds the start."""

    k: int = 16
    dims: int = 64
    rounds: int = 3
    scale: int = 64
    seed: str = "1"


class Bisectors:
    """Integer normals and thresholds of all pairs i < j of centroids."""

    def __init__(self, centroids: list[list[int]]) -> None:
        self.wide = any(abs(x) >= NARROW for c in centroids for x in c)
        self.centroids = np.array(centroids, dtype=object if self.wide else np.int64)
        c, k = self.centroids, len(centroids)
        norm = (c * c).sum(axis=1)
        self.normal = np.zeros((k, k, c.shape[1]), dtype=c.dtype)
        self.threshold = np.zeros((k, k), dtype=c.dtype)
        for j in range(1, k):
            self.normal[:j, j] = 2 * (c[j] - c[:j])
            self.threshold[:j, j] = norm[j] - norm[:j]

    def nearest(self, x: np.ndarray) -> np.ndarray:
        """Number of the nearest centroid of each row: k - 1 tests a row."""
        best = np.zeros(len(x), dtype=np.int64)
        for j in range(1, len(self.centroids)):
            side = (self.normal[best, j] * x).sum(axis=1) - self.threshold[best, j]
            best[np.asarray(side > 0, dtype=bool)] = j
        return best

    def distance(self, x: np.ndarray, best: np.ndarray) -> np.ndarray:
        gap = x - self.centroids[best]
        return (gap * gap).sum(axis=1)


def floor_scaled(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of finite doubles: 64-bit integers, or Python's if one is large."""
    if not len(values) or np.abs(values).max() * scale < NARROW:
        return np.floor(values * scale).astype(np.int64)
    flat = [int(np.floor(v * scale)) if abs(v) < 1 << 60 else int(v) * scale for v in values.ravel().tolist()]
    return np.array(flat, dtype=object).reshape(values.shape)


def kept_vectors(vectors: DataFrame, vec_id: Column, vector: Column, dims: int) -> DataFrame:
    """(__op_id, __op_v): the vectors with ``dims`` components, none null or non-finite."""
    v = vector.cast("array<double>")
    rows = vectors.select(vec_id.cast("long").alias("__op_id"), v.alias("__op_v")).where(F.size("__op_v") == dims)
    # a null compares to null, which is no true
    return rows.where(F.forall("__op_v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))))


def first_centroids(kept: DataFrame, p: Plan) -> list[list[int]]:
    """The k kept vectors with the smallest hashes, in hash order; equal ids in
    the order of their components, null ids last.  k rows reach the driver."""
    rank = F.sha2(F.concat(F.lit(f"{p.seed}:"), F.col("__op_id").cast("string")), 256)
    rows = kept.select(rank.alias("r"), F.col("__op_v").alias("v")).orderBy(F.col("r").asc_nulls_last(), "v").limit(p.k).collect()
    return [[int(x) for x in floor_scaled(np.array(r.v), p.scale)] for r in rows]


def _matrices(batches: Iterator[pa.RecordBatch], p: Plan) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for b in batches:
        for i in range(0, b.num_rows, ROWS):
            part = b.slice(i, ROWS)
            yield part.column(0), floor_scaled(part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, p.dims), p.scale)


def _sums(bisectors, p: Plan):
    """A task's sums: (cluster, dim, limb, total); dim -1 has the number of vectors."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = bisectors.value
        total: dict[tuple[int, int, int], int] = {}
        for _, x in _matrices(batches, p):
            best = pairs.nearest(x)
            for c in np.unique(best).tolist():
                mine = x[best == c]
                total[c, -1, 0] = total.get((c, -1, 0), 0) + len(mine)
                for d, s in enumerate(mine.sum(axis=0).tolist()):
                    limb = 0
                    while x.dtype == object and s >> LIMB not in (0, -1):  # narrow sums fit one limb
                        total[c, d, limb] = total.get((c, d, limb), 0) + (s & ((1 << LIMB) - 1))
                        s, limb = s >> LIMB, limb + 1
                    total[c, d, limb] = total.get((c, d, limb), 0) + s
        keys = list(total)
        cols = [pa.array([k[i] for k in keys], pa.int32()) for i in range(3)]
        yield pa.RecordBatch.from_arrays([*cols, pa.array([total[k] for k in keys], pa.int64())], names=["cluster", "dim", "limb", "total"])

    return rows


def next_centroids(kept: DataFrame, centroids: list[list[int]], p: Plan) -> list[list[int]]:
    """Floors of the means of each cluster's vectors; empty clusters stay.

    Only sums leave the tasks; k x dims of them, in a few limbs, reach the driver."""
    spark = kept.sparkSession
    sent = spark.sparkContext.broadcast(Bisectors(centroids))  # k x k x dims integers
    got = kept.mapInArrow(_sums(sent, p), "cluster int, dim int, limb int, total long").groupBy("cluster", "dim", "limb").agg(F.sum("total").alias("total")).collect()
    sums: dict[tuple[int, int], int] = {}
    for r in got:
        sums[r.cluster, r.dim] = sums.get((r.cluster, r.dim), 0) + (r.total << (LIMB * r.limb))
    sent.unpersist()
    return [[sums[c, d] // sums[c, -1] for d in range(p.dims)] if (c, -1) in sums else old for c, old in enumerate(centroids)]


def _assign(bisectors, p: Plan):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = bisectors.value
        for ids, x in _matrices(batches, p):
            best = pairs.nearest(x)
            far = pairs.distance(x, best)
            far = np.minimum(far, LONG_MAX).astype(np.int64) if far.dtype == object else far
            yield pa.RecordBatch.from_arrays([ids, pa.array(best.astype(np.int32)), pa.array(far)], names=["vec_id", "cluster", "distance"])

    return rows


def cluster(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", p: Plan = Plan()) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance) of every kept vector, and the final centroids.

    Kept are vectors with exactly ``p.dims`` components, none null, infinite
    or NaN; a null vector is not kept.  Equal distances: the smaller number.
    Null or repeated vec_id: each row is a vector.  Fewer kept vectors than
    ``p.k``: as many centroids as vectors.  Empty table: no rows and no
    centroids.  Very large components are exact; a distance beyond 64 bits is
    given as the greatest long.  Extra columns are not read."""
    spark = vectors.sparkSession
    kept = kept_vectors(vectors, F.col(vec_id), F.col(vector), p.dims)
    centroids = first_centroids(kept, p)
    if not centroids:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), []
    for _ in range(p.rounds):
        centroids = next_centroids(kept, centroids, p)
    sent = spark.sparkContext.broadcast(Bisectors(centroids))
    return kept.mapInArrow(_assign(sent, p), "vec_id long, cluster int, distance long"), centroids


def with_inertia(rows: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``rows`` of ``cluster`` with cluster_inertia, inertia and centroid_sha256.

    Distances are summed exactly (decimal); sums beyond 64 bits are given as
    the greatest long.  The k sums are joined as a table of k rows."""
    spark = rows.sparkSession
    rows = materialize(rows, "clusters")
    sums = {r.cluster: int(r.s) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    every = min(LONG_MAX, sum(sums.values()))
    known = spark.createDataFrame([(c, min(LONG_MAX, s), every, sha[c]) for c, s in sums.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_inertia(*cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")))
