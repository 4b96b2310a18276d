"""Centroid clustering in exact integers, by a tournament of bisectors.

The plane halfway between two centroids a and b tells which is nearer: with the
normal 2 (b - a) and the threshold |b|^2 - |a|^2, a vector x is nearer to b if
and only if x . normal > threshold. Normals and thresholds of all pairs are made
once a round; then centroids meet in a knock-out tournament of k - 1 such tests a
vector, where equality favours the smaller number. No distance is computed but
the winner's, at the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.llm.common import materialize, prepare
from hazeline.llm.vectors import integer_vectors, matrix

CENTROIDS, ROUNDS, SCALE, LENGTH, SEED = 8, 10, 1024, 64, 3
#: Rows whose normals are held at a time.
BLOCK = 4096


def bisectors(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normals (k, k, length) and thresholds (k, k) of each pair."""
    squares = (centroids ** 2).sum(axis=1)
    return 2 * (centroids[None, :] - centroids[:, None]), squares[None, :] - squares[:, None]


def winners(vectors: np.ndarray, normals: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """The nearest centroid of each vector, the smaller number of equally near
    ones. Neighbours in the list of those still in meet; the one before has the
    smaller number, as the list keeps its order."""
    still = [np.full(len(vectors), c, np.int64) for c in range(len(thresholds))]
    while len(still) > 1:
        won = [np.where(np.einsum("ij,ij->i", vectors, normals[a, b]) > thresholds[a, b], b, a)
               for a, b in zip(still[::2], still[1::2])]
        still = won + still[len(won) * 2:]
    return still[0]


def _assigned(batch: pa.RecordBatch, centroids: np.ndarray, planes: tuple) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows, their vectors, their centroids' numbers) for blocks of rows."""
    vectors = matrix(batch.column("v")) if batch.num_rows else np.zeros((0, centroids.shape[1]), np.int64)
    for at in range(0, len(vectors), BLOCK):
        rows = slice(at, at + BLOCK)
        yield rows, vectors[rows], winners(vectors[rows], *planes)


def _sums(centroids: np.ndarray):
    """Each task's component sums and counts by cluster."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = bisectors(centroids)
        k, length = centroids.shape
        total, n = np.zeros((k, length), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for _, vectors, cluster in _assigned(batch, centroids, planes):
                np.add.at(total, cluster, vectors)
                n += np.bincount(cluster, minlength=k)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({
            "cluster": np.repeat(used, length), "place": np.tile(np.arange(length), len(used)),
            "total": total[used].ravel(), "n": np.repeat(n[used], length)})
    return run


def start(vectors: DataFrame, k: int = CENTROIDS, seed: int = SEED) -> np.ndarray | None:
    """The vectors whose ids have the least hashes, in that order; None without
    any. At most k rows reach the driver."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.orderBy(key.asc_nulls_last(), "v").limit(k).collect()
    return np.array([r["v"] for r in first], np.int64) if first else None


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each non-empty cluster's centroid as the floor of its vectors' mean. Tasks
    send sums, Spark adds them, and a row per component reaches the driver."""
    sums = vectors.select("v").mapInArrow(_sums(centroids), "cluster long, place long, total long, n long")
    out = centroids.copy()
    for r in sums.groupBy("cluster", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        out[r["cluster"], r["place"]] = r["total"] // r["n"]
    return out


def _clusters(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = bisectors(centroids)
        for batch in batches:
            for rows, vectors, cluster in _assigned(batch, centroids, planes):
                distance = ((vectors - centroids[cluster]) ** 2).sum(axis=1)
                ids = batch.column("vec_id").slice(rows.start, len(vectors))
                yield pa.RecordBatch.from_arrays([ids, pa.array(cluster.astype(np.int32)), pa.array(distance)],
                                                 names=["vec_id", "cluster", "distance"])
    return run


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def clusters(df: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, scale: int = SCALE,
             length: int = LENGTH, seed: int = SEED) -> tuple[DataFrame, np.ndarray | None]:
    """Clusters of the vectors of df (vec_id, embedding; others are not looked
    at), and the final centroids (k, length).

    vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256: the
    squared distance to the centroid, summed over the cluster and over all.

    Rows with a vector that is null, of another length, or with a null or
    non-finite component are left out. Repeated rows count and return as often as
    they occur; a null vec_id starts a cluster only after all others, equal ids
    are ordered by vector. With fewer vectors than k there are fewer centroids. An
    empty table gives an empty table.
    """
    prepare(df.sparkSession)
    kept = materialize(integer_vectors(df, "embedding", scale, ["vec_id"]).where(F.size("v") == length), "cluster-vectors")
    centroids = start(kept, k, seed)
    kind = kept.schema["vec_id"].dataType.simpleString()
    if centroids is None:
        none = [F.lit(0).cast("int").alias("cluster"),
                *(F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia"))]
        return kept.select("vec_id", *none, F.lit("").alias("centroid_sha256")), None
    for _ in range(rounds):
        centroids = moved(kept, centroids)
    found = materialize(kept.mapInArrow(_clusters(centroids), f"vec_id {kind}, cluster int, distance long"), "clusters")
    # A row for each centroid: k bounds what reaches the driver and what is broadcast.
    sums = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    told = [(c, sums.get(c, 0), sum(sums.values()), digest(x)) for c, x in enumerate(centroids)]
    told = df.sparkSession.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(told), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"), centroids
