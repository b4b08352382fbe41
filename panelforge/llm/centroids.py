"""Clustering by centroids over whole-number vectors, with scalar lookup tables.

Each component x becomes floor(64 * x). In every round a task tabulates, for each dimension, the squared
difference between each whole number that occurs there and each centroid; a vector's distances are
then sums of table rows, gathered in numpy. All numbers are whole, so sums, means and ties don't depend
on how Spark deals the rows.

A task gives one row a cluster (count and sum of each component), Spark sums them, and the driver
holds what is bounded by clusters times dimensions: the sums of a round and the centroids.

Start: the vectors with the smallest SHA-256 of `1:<vec_id>`, in that order. A centroid without vectors
stays. A tie goes to the smaller number.

Defined results: a vector that is null, of another length, or holds a null or a non-finite component is left
out; a null vec_id counts as an empty text in the hash; repeated rows count each, and equal hashes
order by the vector; with fewer vectors than clusters there are fewer clusters; components beyond 2 ** 20
count as 2 ** 20, so that every distance fits a long; an inertia that doesn't fit is null; an empty
table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import bounded_batches, staged

SCALE = 64
LARGEST = 1 << 20
DENSE = 1 << 12  # whole numbers between a dimension's least and greatest up to which they index the table themselves
SLICE = 1 << 12  # vectors whose distances are summed together


def whole(values: np.ndarray) -> np.ndarray:
    """floor(64 * x) of float64 values."""
    return np.floor(SCALE * np.clip(values, -LARGEST, LARGEST)).astype(np.int64)


def occurring(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The table's whole numbers of one dimension, and each vector's place among them."""
    least = int(column.min())
    if int(column.max()) - least < DENSE:
        return np.arange(least, int(column.max()) + 1), column - least
    return np.unique(column, return_inverse=True)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each vector's cluster and squared distance; vectors: one row each."""
    tables = [(at, (numbers[:, None] - centroids[None, :, j]) ** 2) for j in range(vectors.shape[1]) for numbers, at in [occurring(vectors[:, j])]]
    cluster, distance = np.zeros(len(vectors), np.int32), np.zeros(len(vectors), np.int64)
    for i in range(0, len(vectors), SLICE):
        total = np.zeros((min(SLICE, len(vectors) - i), len(centroids)), np.int64)
        for at, table in tables:
            total += table[at[i : i + SLICE]]
        best = total.argmin(axis=1)  # the first of equal ones
        cluster[i : i + SLICE], distance[i : i + SLICE] = best, total[np.arange(len(total)), best]
    return cluster, distance


def _matrices(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches with their whole-number vectors (column 1: lists of `dims` doubles without nulls)."""
    for batch in batches:
        if batch.num_rows:
            yield batch, whole(batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims))


def _sums(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """cluster, at, total: the sums of a task's vectors by cluster and dimension; at -1 counts them."""
    k, dims = centroids.shape
    totals, any_row = np.zeros((k, dims + 1), object), False  # numbers of any size
    for _, vectors in _matrices(batches, dims):
        cluster, _ = nearest(vectors, centroids)
        order = np.argsort(cluster, kind="stable")
        present, first = np.unique(cluster[order], return_index=True)
        totals[present, 1:] += np.add.reduceat(vectors[order], first, axis=0).astype(object)
        totals[present, 0] += np.diff(np.append(first, len(order))).astype(object)
        any_row = True
    if any_row:
        c, at = np.divmod(np.arange(k * (dims + 1)), dims + 1)
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int32)), pa.array((at - 1).astype(np.int32)), pa.array([int(x) for x in totals.ravel()], pa.int64())], names=["cluster", "at", "total"])


def _assign(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch, vectors in _matrices(batches, centroids.shape[1]):
        cluster, distance = nearest(vectors, centroids)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster), pa.array(distance)], names=["vec_id", "cluster", "distance"])


def kept_vectors(embeddings: DataFrame, dims: int) -> DataFrame:
    """vec_id and v (doubles) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    sound = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return embeddings.filter((F.size(v) == dims) & sound).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))


def starts(kept: DataFrame, clusters: int) -> np.ndarray:
    """The first centroids: a row each."""
    by = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = kept.select(by.alias("h"), "v").orderBy("h", "v").limit(clusters).collect()  # bounded by `clusters`
    return whole(np.array([r["v"] for r in rows], np.float64)) if rows else np.zeros((0, 0), np.int64)


def fit_centroids(kept: DataFrame, clusters: int, rounds: int) -> np.ndarray:
    centroids = starts(kept, clusters)
    for _ in range(rounds if len(centroids) else 0):
        sums = kept.mapInArrow(partial(_sums, centroids=centroids), "cluster int, at int, total long")
        sums = sums.groupBy("cluster", "at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()  # clusters times dimensions
        total = {(r["cluster"], r["at"]): int(r["total"]) for r in sums}
        for c in {c for c, _ in total}:
            if n := total[c, -1]:
                centroids[c] = [total[c, j] // n for j in range(centroids.shape[1])]
    return centroids


def centroid_clusters(embeddings: DataFrame, clusters: int = 16, rounds: int = 3, dims: int = 64) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector that takes part."""
    spark = embeddings.sparkSession
    bounded_batches(spark)
    kept = kept_vectors(embeddings, dims)
    centroids = fit_centroids(kept, clusters, rounds)
    if not len(centroids):
        return kept.select("vec_id", F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(x) for x in ("distance", "cluster_inertia", "inertia")], F.lit("").alias("centroid_sha256")).limit(0)
    out = staged(kept.mapInArrow(partial(_assign, centroids=centroids), "vec_id long, cluster int, distance long"), "centroids")
    inertia = {r["cluster"]: int(r["s"]) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    fits = lambda x: x if x < 1 << 63 else None
    facts = [(c, fits(inertia.get(c, 0)), fits(sum(inertia.values())), hashlib.sha256(",".join(map(str, m.tolist())).encode()).hexdigest()) for c, m in enumerate(centroids)]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return out.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # a row a cluster
