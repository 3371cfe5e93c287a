"""Exact k-means over integer vectors: Lloyd's rounds, with distances as one matrix product.

|x - c|² is |x|² - 2 x·c + |c|², whose middle term is a product of blocks in double precision. Its sums are exact while they
stay below 2^53, which a bound of the components guards; beyond it the block is reckoned in 64-bit integers, and beyond
2^63 in Python's. A round's sums and counts of each task are combined by treeAggregate, so the driver gets k of them.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onoma.llm.common import map_arrow, stash

CLUSTERS, ROUNDS, DIM, SCALE, SEED = 8, 10, 64, 1024, 3
#: Rows of a block: as many as 2^53 holds with room, whatever the batch.
BLOCK, LARGEST = 4096, 2**63 - 1


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), int64, or Python's integers where that is too narrow; x: finite."""
    with np.errstate(over="ignore"):
        y = np.floor(scale * x)
    if np.abs(y).max(initial=0.0) < 2.0**62:
        return y.astype(np.int64)
    out = np.empty(x.shape, object)
    for at, v in np.ndenumerate(x):
        num, den = float(v).as_integer_ratio()
        out[at] = scale * num // den
    return out


def size_of(x: np.ndarray) -> int:
    """The largest component by size."""
    return max(int(x.max()), -int(x.min())) if x.size else 0


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows of integers to rows of c: exact, in the fastest arithmetic that is."""
    dim, most = x.shape[1], size_of(x) + size_of(c)
    if dim * most * most < 2**53:  # every partial sum of the expansion is below it, too
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2.0 * (a @ b.T) + (b * b).sum(axis=1)[None, :]).astype(np.int64)
    kind = np.int64 if dim * most * most <= LARGEST else object
    a, b = x.astype(kind), c.astype(kind)
    return np.stack([((a - row) ** 2).sum(axis=1) for row in b], axis=1)


def sums(x: np.ndarray, cluster: np.ndarray, k: int) -> list[list[int]]:
    """Componentwise sums of each cluster's rows, in Python's integers."""
    one = cluster[None, :] == np.arange(k)[:, None]
    if len(x) * size_of(x) < 2**53:
        return [[int(v) for v in row] for row in one.astype(np.float64) @ x.astype(np.float64)]
    return [[int(v) for v in x[mine].astype(object).sum(axis=0)] if mine.any() else [0] * x.shape[1] for mine in one]


class Total(NamedTuple):
    """Of each cluster: sums, vectors, squared distances."""

    sums: list[list[int]]
    counts: list[int]
    inertia: list[int]

    def __add__(self, other: Total) -> Total:  # type: ignore[override]
        return Total([[a + b for a, b in zip(x, y, strict=True)] for x, y in zip(self.sums, other.sums, strict=True)], [a + b for a, b in zip(self.counts, other.counts, strict=True)], [a + b for a, b in zip(self.inertia, other.inertia, strict=True)])


def zero(k: int, dim: int) -> Total:
    return Total([[0] * dim for _ in range(k)], [0] * k, [0] * k)


def _blocks(batch: pa.RecordBatch, scale: int, dim: int) -> Iterator[tuple[int, np.ndarray]]:
    flat = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    for k in range(0, len(flat), BLOCK):
        yield k, integers(flat[k : k + BLOCK], scale)


def _assign(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = distances(x, centroids)
    nearest = d.argmin(axis=1)  # the first of equals
    return nearest, d[np.arange(len(d)), nearest]


def _totals(centroids: np.ndarray, scale: int):  # noqa: ANN202
    k, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = zero(k, dim)
        for b in batches:
            for _, x in _blocks(b, scale, dim):
                nearest, d = _assign(x, centroids)
                inertia = sums(d[:, None], nearest, k)
                total += Total(sums(x, nearest, k), np.bincount(nearest, minlength=k).tolist(), [row[0] for row in inertia])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(tuple(total))], pa.binary())], ["total"])

    return run


def _labelled(centroids: np.ndarray, scale: int, inertia: list[int]):  # noqa: ANN202
    whole, fits = sum(inertia), lambda v: min(int(v), LARGEST)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, x in _blocks(b, scale, centroids.shape[1]):
                nearest, d = _assign(x, centroids)
                of = nearest.tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("vec_id").slice(k, len(x)), pa.array(nearest, pa.int32()), pa.array([fits(v) for v in d.tolist()] if d.dtype == object else d, pa.int64()), pa.array([fits(inertia[i]) for i in of], pa.int64()),
                        pa.array([fits(whole)] * len(x), pa.int64()), pa.array([digests[i] for i in of], pa.string()),
                    ], ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
                )

    return run


def kept(vectors: DataFrame, dim: int = DIM) -> DataFrame:
    """(vec_id, x array<double>) of the vectors of exactly `dim` components, none of them null or non-finite."""
    x = F.col("x")
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    return rows.where((F.size(x) == dim) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """vectors: (vec_id, embedding array of numbers) -> (vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256).

    Vectors of another length than dim, null ones, and those with null or non-finite components go; each other row has a
    row of its own, whether its id is repeated, its vector is, or both. A component x counts as floor(scale * x). The first
    centroids are the vectors whose ids have the smallest SHA-256 with the seed, rows without an id last, of equal ids the
    smaller vector first; fewer vectors than clusters give as many centroids. Of equally near centroids the smaller
    number counts, and one without vectors stays. Distances and their sums are exact; what exceeds a long is the largest
    long. An empty table gives no rows, and other columns are ignored.
    """
    rows = stash(kept(vectors, dim), "vectors")
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(named.asc_nulls_last(), "x").limit(clusters).select("x").collect()
    schema = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not first:
        return rows.sparkSession.createDataFrame([], schema)
    centroids = integers(np.array([r.x for r in first], np.float64), scale)
    k = len(first)
    for n in range(rounds + 1):
        parts = map_arrow(rows, _totals(centroids, scale), "total binary").rdd
        total = parts.treeAggregate(zero(k, dim), lambda a, r: a + Total(*pickle.loads(r.total)), lambda a, b: a + b, depth=2)
        if n < rounds:
            centroids = np.array([[s // m for s in row] if m else old for row, m, old in zip(total.sums, total.counts, centroids.tolist(), strict=True)], object)
            centroids = centroids.astype(np.int64) if size_of(centroids) < 2**62 else centroids
    return map_arrow(rows, _labelled(centroids, scale, total.inertia), schema)
