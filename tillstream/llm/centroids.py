"""Centroid clustering with exact integers and an incremental distance matrix.

Every vector keeps its dot product with every centroid. When centroids move, a dot product
changes by the moved components only, so a round adds ``x[d] * change[d]`` for the
components that changed, and nothing for centroids that stayed. As
``|x - c|² = |x|² - 2 x·c + |c|²``, the nearest centroid follows from the dot products and
the centroids' own norms. All numbers are integers, so nothing drifts over the rounds.

Sums per cluster are incremental too: only vectors that changed their cluster are read,
subtracted from the old sum and added to the new one. Tasks add up before the shuffle, so
the driver gets ``k * (dims + 1)`` numbers a round, whatever the number of vectors and
however uneven the clusters. Vectors and dot products are written to the shared folder
each round, which ends the lineage there; the table of the round before is then dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import dropped, written
from tillstream.llm.exact_vectors import (
    added_up,
    decimals,
    floored,
    lists,
    matrix,
    slots,
    sound,
    sums_by,
)

STATE = "vec_id long, x array<long>, norm long, dots array<long>, cluster int, was int, moved boolean, distance long"
RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def updated(dots: np.ndarray, x: np.ndarray, change: np.ndarray) -> np.ndarray:
    """Dot products after the centroids moved by ``change`` (a row each)."""
    dots = dots.copy()
    for k in range(len(change)):
        moved = np.flatnonzero(change[k])
        if len(moved):
            dots[:, k] += x[:, moved] @ change[k, moved]
    return dots


def nearest(norm: np.ndarray, dots: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid (ties: the smaller number) and its squared distance."""
    distances = norm[:, None] - 2 * dots + norms
    cluster = np.argmin(distances, axis=1)
    return cluster, distances[np.arange(len(cluster)), cluster]


def _assigned(change: np.ndarray, norms: np.ndarray):
    k, dims = change.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, was = matrix(batch.column("x"), dims), np.asarray(batch.column("cluster"))
            dots = np.asarray(batch.column("dots").flatten(), np.int64).reshape(len(x), k)
            dots, norm = updated(dots, x, change), np.asarray(batch.column("norm"))
            cluster, distance = nearest(norm, dots, norms)
            cluster = cluster.astype(np.int32)
            columns = [
                batch.column("vec_id"), batch.column("x"), batch.column("norm"), lists(dots),
                pa.array(cluster), pa.array(was), pa.array(cluster != was), pa.array(distance),
            ]
            yield pa.record_batch(columns, names=[c.split()[0] for c in STATE.split(", ")])

    return run


def _moves(k: int, dims: int):
    """What the vectors that moved add to the sums and numbers of each cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dims + 1), np.int64)
        for batch in batches:
            x = matrix(batch.column("x"), dims)
            cluster, was = np.asarray(batch.column("cluster")), np.asarray(batch.column("was"))
            had = was >= 0
            total += sums_by(cluster, x, k) - sums_by(was[had], x[had], k)
        yield slots(total)

    return run


def centroid_clusters(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    dims: int = 64,
    scale: int = 1024,
    k: int = 8,
    rounds: int = 10,
    seed: str = "3",
) -> DataFrame:
    """``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``.

    Vectors with other than ``dims`` components, a null or a non-finite one, and null vectors
    are left out. A component x becomes ``floor(scale * x)``. The first centroids are the
    ``k`` vectors with the smallest SHA-256 of ``<seed>:<id>``; fewer vectors make fewer
    centroids, no vector an empty result. Each round assigns every vector to the nearest
    centroid (ties: the smaller number) and replaces each centroid that has vectors by the
    floor of their mean; the last assignment follows the last replacement. ``distance`` is
    squared; inertia sums it over the cluster and over all.

    Rows are vectors of their own, also where ids repeat: their order among equal hashes is
    that of their components. Null ids come last as first centroids and stay in the result.
    Other columns are not read. Components so large that a squared distance might not fit
    64 bits raise ``OverflowError``.
    """
    spark = vectors.sparkSession
    ints = vectors.filter(sound(vector) & (F.size(vector) == dims)).select(
        F.col(key).cast("long").alias("vec_id"), floored(vector, scale).alias("x")
    )
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    state, path = written(
        ints.select(
            "vec_id",
            "x",
            F.aggregate("x", F.lit(0).cast("long"), lambda a, v: a + F.try_multiply(v, v)).alias("norm"),
            F.array_repeat(F.lit(0).cast("long"), k).alias("dots"),
            F.lit(-1).alias("cluster"),
        ),
        "vectors",
    )
    first = state.orderBy(name.asc_nulls_last(), "x").select("x").limit(k).collect()
    if not first:
        dropped(spark, path)
        return spark.createDataFrame([], RESULT)
    k = len(first)
    state = state.withColumn("dots", F.slice("dots", 1, k))

    centroids = np.array([r.x for r in first], np.int64)
    change, totals = centroids, np.zeros((k, dims + 1), np.int64)
    for turn in range(rounds + 1):
        norms = (centroids * centroids).sum(axis=1)
        before = path
        state, path = written(state.mapInArrow(_assigned(change, norms), STATE), "dot-products")
        dropped(spark, before)
        if turn == rounds:
            break
        moves = state.filter("moved").select("x", "cluster", "was")
        totals += added_up(moves.mapInArrow(_moves(k, dims), "slot long, amount long"), totals.shape)
        moved = centroids.copy()
        filled = totals[:, -1] > 0
        moved[filled] = totals[filled, :-1] // totals[filled, -1:]
        change, centroids = moved - centroids, moved
        if not change.any():  # all further rounds would be the same
            break

    inertia = {r.cluster: r.inertia for r in state.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    described = spark.createDataFrame(
        [
            (c, own, sum(inertia.values()), hashlib.sha256(decimals(centroids[c]).encode()).hexdigest())
            for c, own in sorted(inertia.items())
        ],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    found = state.select("vec_id", "cluster", "distance")
    return found.join(F.broadcast(described), "cluster").select(*[c.split()[0] for c in RESULT.split(", ")])
