"""Centroid clustering with n-simplex bounds (operator 12).

Vectors become whole numbers. A few of them are pivots; a vector's exact distances to the pivots are taken once and turned
into apex coordinates: the place of its apex over the simplex that the pivots make. The apexes of two vectors are no further
apart than the vectors, and with one apex mirrored at the simplex no nearer. In every round a centroid is measured for a vector
only where its lower bound does not exceed the least upper bound; what is left is compared in whole numbers, ties to the smaller
number. Bounds carry a margin for the rounding of doubles, and pivots that add hardly any height to the simplex are left out, so
the result does not depend on the bounds.

Vectors that are null, have another number of components than ``dim``, or hold nulls, NaN or infinity are left out. Components may have a
size of up to 2^27 after scaling; beyond it the sums of squares leave 64 bits and the job fails with an error. Rows without an id
take part. Rows of one id are separate vectors; among the first centroids they come in the order of their components. With fewer than ``k``
vectors there are as many centroids. Without vectors the result is empty. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from llm.common import ship, written

CENTROIDS, ROUNDS, SCALE, DIM, PIVOTS = 8, 10, 1024, 64, 6
LARGEST = 1 << 27
_STRIPE = 1 << 14  # vectors measured at once


def sound(vec: Column) -> Column:
    """No component is null, NaN or infinite; null for a null vector."""
    return F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def whole_numbers(vec: pa.Array, scale: int, dim: int) -> np.ndarray:
    """floor(scale * x) of every component, one row per vector."""
    x = vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if x.size != len(vec) * dim:
        raise ValueError("vectors differ in length")
    found = np.floor(x.reshape(len(vec), dim) * scale)
    if found.size and np.abs(found).max() > LARGEST:
        raise ValueError(f"a component exceeds {LARGEST} after scaling")
    return found.astype(np.int64)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The exact squared distance of every row of ``x`` to one vector."""
    apart = x - c
    return np.einsum("ij,ij->i", apart, apart)


class Simplex:
    """The simplex of the pivots, in coordinates: pivot i stands at ``corners[i]``, whose entries from i on are 0."""

    def __init__(self, candidates: np.ndarray):
        self.pivots = candidates[:1]
        self.corners = np.zeros((1, 0))
        for c in candidates[1:]:
            apex = self.apexes(squared(self.pivots, c)[None, :])[0]
            widest = np.sqrt(squared(self.pivots, c).max())
            if apex[-1] > 1e-3 * max(1.0, widest):
                n = len(self.pivots)
                self.corners = np.vstack([np.hstack([self.corners, np.zeros((n, 1))]), apex[None, :]])
                self.pivots = np.vstack([self.pivots, c[None, :]])

    def apexes(self, distances: np.ndarray) -> np.ndarray:
        """Apex coordinates of vectors by their squared distances to the pivots (one row each); the last is the height."""
        d = distances.astype(np.float64)
        n = len(self.pivots)
        out = np.zeros((len(d), n))
        for i in range(1, n):
            corner = self.corners[i]
            # |apex|^2 - |apex - corner|^2 = 2 apex.corner - |corner|^2
            known = out[:, : i - 1] @ corner[: i - 1]
            out[:, i - 1] = ((d[:, 0] - d[:, i] + corner @ corner) / 2 - known) / corner[i - 1]
        out[:, n - 1] = np.sqrt(np.maximum(0.0, d[:, 0] - (out[:, : n - 1] ** 2).sum(axis=1)))
        return out

    def place(self, x: np.ndarray) -> np.ndarray:
        return self.apexes(np.stack([squared(x, p) for p in self.pivots], axis=1))


def open_pairs(apexes: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Which centroids (columns) the bounds leave open for each vector."""
    flat = (apexes[:, None, :-1] - centres[None, :, :-1]) ** 2
    flat = flat.sum(axis=2)
    low = flat + (apexes[:, None, -1] - centres[None, :, -1]) ** 2
    high = flat + (apexes[:, None, -1] + centres[None, :, -1]) ** 2
    margin = 1e-6 * (1.0 + (apexes**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1)[None, :])
    return low - margin <= (high + margin).min(axis=1, keepdims=True)


def nearest(x: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(centroid, squared distance) of every vector, and how many distances were taken."""
    held = open_pairs(apexes, centres)
    best = np.full(len(x), np.iinfo(np.int64).max)
    own = np.zeros(len(x), dtype=np.int64)
    for j, c in enumerate(centroids):
        rows = np.flatnonzero(held[:, j])
        found = squared(x[rows], c)
        less = found < best[rows]
        best[rows[less]], own[rows[less]] = found[less], j
    return own, best, int(held.sum())


def _stripes(batches, dim: int):
    for batch in batches:
        for at in range(0, len(batch), _STRIPE):
            part = batch.slice(at, _STRIPE)
            ints = np.frombuffer(b"".join(part.column("ints").to_pylist()), dtype="<i4").reshape(len(part), dim).astype(np.int64)
            yield part, ints, np.frombuffer(b"".join(part.column("apex").to_pylist()), dtype="<f8").reshape(len(part), -1)


def _placed(kept: DataFrame, simplex, scale: int, dim: int) -> DataFrame:
    """(_id, ints, apex) of the vectors: their whole numbers and apex coordinates, as bytes."""
    kind = kept.schema["_id"].dataType
    arrow = pa.schema([("_id", to_arrow_type(kind)), ("ints", pa.binary()), ("apex", pa.binary())])

    def run(batches):
        for batch in batches:
            ints = whole_numbers(batch.column(1), scale, dim)
            apexes = simplex.value.place(ints)
            columns = [batch.column(0), *[pa.array([r.tobytes() for r in rows], pa.binary()) for rows in (ints.astype("<i4"), apexes.astype("<f8"))]]
            yield pa.record_batch(columns, schema=arrow)

    return kept.mapInArrow(run, f"_id {kind.simpleString()}, ints binary, apex binary")


def _moved(placed: DataFrame, centroids: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The centroids after a round: k sums come from every task, k x dim numbers reach the driver."""
    k, dim = centroids.shape

    def run(batches):
        count, sums = np.zeros(k, dtype=np.int64), np.zeros((k, dim), dtype=np.int64)
        for _, ints, apexes in _stripes(batches, dim):
            own, _, _ = nearest(ints, apexes, centroids, centres)
            order = np.argsort(own, kind="stable")
            used, first = np.unique(own[order], return_index=True)
            count += np.bincount(own, minlength=k)
            sums[used] += np.add.reduceat(ints[order], first, axis=0)
        some = np.flatnonzero(count)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(count[some]), pa.array(list(sums[some]), pa.list_(pa.int64()))], names=["c", "n", "sums"])

    parts = placed.select("ints", "apex").mapInArrow(run, "c int, n long, sums array<long>")
    rows = parts.select("c", "n", F.posexplode("sums")).groupBy("c", "pos").agg(F.sum("n").alias("n"), F.sum("col").alias("s")).collect()
    moved = centroids.copy()
    for r in rows:
        moved[r["c"], r["pos"]] = r["s"] // r["n"]
    return moved


def cluster(
    vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, scale: int = SCALE, dim: int = DIM, pivots: int = PIVOTS,
    seed: int = 3, id_col: str = "vec_id", vec_col: str = "embedding",
) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector.

    The first centroids, ``k`` vectors by the SHA-256 of ``seed:id``, and ``pivots`` more come to the driver. Every round reads the
    stored whole numbers and apexes once. Runs jobs.
    """
    spark = vectors.sparkSession
    ship(spark)
    kept = vectors.select(F.col(id_col).alias("_id"), F.col(vec_col).cast("array<double>").alias("_vec"))
    kept = kept.where((F.size("_vec") == dim) & sound(F.col("_vec")))
    schema = f"{id_col} {vectors.schema[id_col].dataType.simpleString()}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))), 256)
    first = kept.orderBy(hashed, "_vec").limit(k + pivots).collect()  # k + pivots rows
    if not first:
        return spark.createDataFrame([], schema)
    start = whole_numbers(pa.array([r["_vec"] for r in first]), scale, dim)
    centroids = start[:k]
    simplex = Simplex(start[-pivots:])
    placed = written(_placed(kept, spark.sparkContext.broadcast(simplex), scale, dim))
    for _ in range(rounds):
        centroids = _moved(placed, centroids, simplex.place(centroids))

    centres = simplex.place(centroids)
    arrow = pa.schema([("_id", to_arrow_type(placed.schema["_id"].dataType)), ("cluster", pa.int32()), ("distance", pa.int64())])

    def assign(batches):
        for part, ints, apexes in _stripes(batches, dim):
            own, distance, _ = nearest(ints, apexes, centroids, centres)
            yield pa.record_batch([part.column("_id"), pa.array(own, pa.int32()), pa.array(distance)], schema=arrow)

    assigned = written(placed.mapInArrow(assign, f"_id {placed.schema['_id'].dataType.simpleString()}, cluster int, distance long"))
    inertia = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    names = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    total = sum(inertia.values())
    table = spark.createDataFrame([(j, inertia.get(j, 0), total, name) for j, name in enumerate(names)], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(table), "cluster").select(F.col("_id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
