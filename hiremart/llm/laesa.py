"""Operator 12: centroid clustering with a LAESA pivot table.

Vectors become exact integers.  Each vector's distances to a few fixed pivots are
computed once and written beside it.  In every round the difference of a vector's
and a centroid's distance to one pivot is a lower bound of their distance
(triangle inequality); the centroid of least bound gets its exact distance first,
and only the centroids whose bound does not exceed that get theirs, in integers.
Rounds move between executors and driver only the centroids and one sum per
cluster and component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiremart.llm.frames import keep, prepare

#: Pivots: the first initial centroids.  More bound tighter and cost a double each per vector.
PIVOTS = 12
#: Largest absolute component, so that a squared distance of 64 components fits a long.
LARGEST = 1 << 27
#: Rows searched at once in a task.
_ROWS = 4096


def integer_vectors(table: DataFrame, dims: int = 64, factor: float = 256, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, x)``: the vectors of exactly ``dims`` components, none null or non-finite,
    as ``floor(factor * component)`` (longs); the others are left out.  A component beyond
    ``LARGEST`` is an error (its squared distances would not fit a long)."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = table.where(F.coalesce((F.size(v) == dims) & ~bad, F.lit(False)))
    scaled = F.transform(v, lambda c: F.floor(F.lit(float(factor)) * c))
    large = F.exists(v, lambda c: F.abs(F.lit(float(factor)) * c) > float(LARGEST))
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), F.when(
        large, F.raise_error(F.lit(f"a component beyond {LARGEST} / {factor}"))).otherwise(scaled).alias("x"))


def initial_centroids(vectors: DataFrame, k: int, salt: str) -> list[list[int]]:
    """The ``k`` vectors of smallest sha256 of ``<salt>:<vec_id>``, ascending (ties, of repeated
    ids, by components; a null id is no candidate).  At most ``k`` rows reach the driver."""
    named = vectors.where("vec_id IS NOT NULL").withColumn(
        "h", F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256))
    return [list(r["x"]) for r in named.orderBy("h", "x").limit(k).collect()]


def _distance(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distance of each row of ``x`` to the row of ``c`` beside it, in integers."""
    d = x - c
    return np.einsum("ij,ij->i", d, d)


def _matrix(col: pa.ListArray, dims: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), dims)


def pivot_table(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``(vec_id, x, far)``: every vector with its distances to the pivots (a written table)."""
    dims = pivots.shape[1]
    schema = pa.schema([("vec_id", pa.int64()), ("x", pa.list_(pa.int64())), ("far", pa.list_(pa.float64()))])

    def run(batches):
        for b in batches:
            x = _matrix(b.column(1), dims)
            far = np.empty((len(x), len(pivots)))
            for k, p in enumerate(pivots):
                far[:, k] = np.sqrt(_distance(x, p[None, :]))
            off = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(pivots))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1).cast(pa.list_(pa.int64())),
                                              pa.ListArray.from_arrays(off, pa.array(far.ravel()))], schema=schema)

    return keep(vectors.mapInArrow(run, "vec_id long, x array<long>, far array<double>"), "pivot_table")


def nearest(x: np.ndarray, far: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of every row (ties: the smaller number) and its exact squared distance."""
    reach = np.empty((len(centroids), len(pivots)))
    for k, p in enumerate(pivots):
        reach[:, k] = np.sqrt(_distance(centroids, p[None, :]))
    bound = np.zeros((len(x), len(centroids)))
    for k in range(len(pivots)):
        np.maximum(bound, np.abs(far[:, k, None] - reach[None, :, k]), out=bound)
    # square roots are off by a few units in the last place: the bound gives way by more than that
    bound = np.maximum(bound * (1 - 2.0**-40) - 2.0**-40 * far.max(axis=1, initial=0)[:, None], 0)
    first = bound.argmin(axis=1)
    best = _distance(x, centroids[first])
    rows, others = np.nonzero(bound * bound <= best[:, None].astype(np.float64) * (1 + 2.0**-50))
    exact = np.empty(len(rows), np.int64)
    for lo in range(0, len(rows), 1 << 15):
        part = slice(lo, lo + (1 << 15))
        exact[part] = _distance(x[rows[part]], centroids[others[part]])
    order = np.lexsort((others, exact, rows))
    rows, others, exact = rows[order], others[order], exact[order]
    head = np.flatnonzero(np.diff(rows, prepend=-1))
    return others[head], exact[head]


def _batches(batches, dims: int, pivots: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    for b in batches:
        for lo in range(0, b.num_rows, _ROWS):
            part = b.slice(lo, _ROWS)
            yield part.column(0), _matrix(part.column(1), dims), _matrix(part.column(2), pivots)


def next_centroids(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """One round: the floor of every cluster's mean; an empty cluster keeps its centroid."""
    k, dims = centroids.shape
    schema = pa.schema([("cluster", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])

    def run(batches):
        n, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for _, x, far in _batches(batches, dims, len(pivots)):
            own, _ = nearest(x, far, centroids, pivots)
            order = np.argsort(own, kind="stable")
            ids, at = np.unique(own[order], return_index=True)
            sums[ids] += np.add.reduceat(x[order], at, axis=0)
            n += np.bincount(own, minlength=k)
        there = np.flatnonzero(n)
        off = pa.array(np.arange(len(there) + 1, dtype=np.int32) * dims)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(n[there]), pa.ListArray.from_arrays(
            off, pa.array(sums[there].ravel()))], schema=schema)

    parts = table.mapInArrow(run, "cluster int, n long, sums array<long>")
    # one row for each task and cluster becomes one for each cluster and component, at most
    total = (parts.select("cluster", "n", F.posexplode("sums").alias("dim", "s")).groupBy("cluster", "dim")
             .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).collect())
    new = centroids.copy()
    for r in total:
        new[r["cluster"], r["dim"]] = int(r["s"]) // r["n"]
    return new


def _sha256(centroid) -> str:
    return hashlib.sha256(",".join(str(int(c)) for c in centroid).encode()).hexdigest()


def centroid_clusters(table: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, factor: float = 256,
                      salt: str = "2", pivots: int = PIVOTS, id_col: str = "vec_id",
                      vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of every kept vector.

    Vectors that are null, of another length, or hold null or non-finite components are
    left out.  With fewer than ``k`` named vectors there are as many centroids; without
    any, no rows.  Rows with a null or repeated id are clustered like others.  Other columns
    are ignored.
    """
    spark = prepare(table.sparkSession)
    vectors = integer_vectors(table, dims, factor, id_col, vector_col)
    start = initial_centroids(vectors, k, salt)
    out = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not start:
        return spark.createDataFrame([], out)
    centroids = np.array(start, np.int64).reshape(len(start), dims)
    fixed = centroids[:pivots].copy()
    held = pivot_table(vectors, fixed)
    for _ in range(rounds):
        new = next_centroids(held, centroids, fixed)
        if np.array_equal(new, centroids):      # further rounds would repeat this one
            break
        centroids = new
    last = centroids
    schema = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])

    def run(batches):
        for ids, x, far in _batches(batches, dims, len(fixed)):
            own, d = nearest(x, far, last, fixed)
            yield pa.RecordBatch.from_arrays([ids, pa.array(own.astype(np.int32)), pa.array(d)], schema=schema)

    found = keep(held.mapInArrow(run, "vec_id long, cluster int, distance long"), "clusters")
    each = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # <= k rows
    facts = spark.createDataFrame([(c, s, _sha256(last[c])) for c, s in sorted(each.items())],
                                  "cluster int, cluster_inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", F.lit(sum(each.values())).cast("long").alias("inertia"),
        "centroid_sha256")
