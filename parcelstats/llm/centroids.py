"""Centroid clustering with exact whole-number distances and an n-simplex filter.

Distances from a vector to a few pivots fix a simplex over the pivots; its apex has one
coordinate per pivot, the last one being its height above them. For two apexes the Euclidean
distance never exceeds the distance of their vectors, and with the heights on opposite sides
it never falls below it. The apex of a vector is computed once and kept; each round compares
apexes, and only the centroids that these bounds leave over are measured in whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelstats.llm.near_vectors import matrix
from parcelstats.llm.tables import settle

#: Most pivots; they come from the first centroids, which are as many as clusters.
PIVOTS = 8
#: A pivot must rise above those before it by this share of the first distance, so that
#: the heights, by which coordinates are divided, stay well above rounding.
LEAST_RISE = 0.05
#: Rounding of a squared bound, as a share of the squared distances to the first pivot.
SLACK = 1e-6
#: Components beyond this have distances beyond 64 bits.
LARGEST = 1 << 27


def complete(vector: str, size: int) -> Column:
    """Whether a vector has ``size`` components, all of them there and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == size) & finite, F.lit(False))


def whole(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of each component."""
    scaled = np.floor(scale * vectors)
    if scaled.size and np.abs(scaled).max() >= LARGEST:
        raise ValueError("a component is too large for distances in 64 bits")
    return scaled.astype(np.int64)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``a`` to one row or to the same rows of ``b``."""
    step = a - b
    return (step * step).sum(axis=-1)


@dataclass(frozen=True)
class Simplex:
    """Pivots, and their own coordinates: row i of ``base`` is zero from place i on."""

    pivots: np.ndarray
    base: np.ndarray

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        """Coordinates of each vector, the last one its height (never negative)."""
        n = len(self.pivots)
        far = np.stack([squared(vectors, p) for p in self.pivots], axis=1).astype(np.float64)
        apex = np.zeros((len(vectors), n))
        for i in range(1, n):
            row = self.base[i]
            along = (far[:, 0] - far[:, i] + row @ row) / 2
            apex[:, i - 1] = (along - apex[:, : i - 1] @ row[: i - 1]) / row[i - 1]
        left = far[:, 0] - (apex[:, : n - 1] ** 2).sum(axis=1)
        apex[:, n - 1] = np.sqrt(np.maximum(left, 0))
        return apex


def choose_simplex(sample: np.ndarray, most: int = PIVOTS) -> Simplex:
    """Pivots out of ``sample``, each the one that rises highest above those before it."""
    found = Simplex(sample[:1], np.zeros((1, 1)))
    first_rise = None
    while len(found.pivots) < most:
        apexes = found.apexes(sample)
        highest = int(apexes[:, -1].argmax())
        rise = apexes[highest, -1]
        first_rise = rise if first_rise is None else first_rise
        if rise == 0 or rise < LEAST_RISE * first_rise:
            break
        n = len(found.pivots)
        base = np.zeros((n + 1, n + 1))
        base[:n, : found.base.shape[1]] = found.base
        base[n, :n] = apexes[highest]
        found = Simplex(np.vstack([found.pivots, sample[highest]]), base)
    return found


def nearest_centroid(
    vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, simplex: Simplex
) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, squared distance, distances measured exactly)."""
    own = simplex.apexes(centroids)
    low = np.stack([((apexes - c) ** 2).sum(axis=1) for c in own], axis=1)
    high = low + 4 * apexes[:, -1:] * own[:, -1]
    slack = SLACK * ((apexes**2).sum(axis=1)[:, None] + (own**2).sum(axis=1) + 1)
    left = low - slack <= (high + slack).min(axis=1, keepdims=True)
    row, number = np.nonzero(left)
    distance = np.full(left.shape, np.iinfo(np.int64).max)
    distance[row, number] = squared(vectors[row], centroids[number])
    best = distance.argmin(axis=1)  # the first of equal ones, so the smaller number
    return best, distance[np.arange(len(best)), best], len(row)


def _in_whole(scale: int, simplex: Simplex):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = whole(matrix(batch.column(1)), scale)
                apexes = simplex.apexes(vectors)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), _lists(vectors.astype(np.int32)), _lists(apexes)],
                    names=["id", "q", "apex"],
                )

    return run


def _lists(rows: np.ndarray) -> pa.Array:
    begins = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(begins), pa.array(rows.ravel()))


def _assigned(batch: pa.RecordBatch, centroids: np.ndarray, simplex: Simplex):
    vectors = matrix(batch.column("q")).astype(np.int64)
    best, distance, _ = nearest_centroid(vectors, matrix(batch.column("apex")), centroids, simplex)
    return vectors, best, distance


def _partial_sums(centroids: np.ndarray, simplex: Simplex):
    """Per task and centroid: how many vectors, and their sum per component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(centroids), np.int64)
        sums = np.zeros(centroids.shape, np.int64)
        for batch in batches:
            if batch.num_rows:
                vectors, best, _ = _assigned(batch, centroids, simplex)
                counts += np.bincount(best, minlength=len(centroids))
                np.add.at(sums, best, vectors)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(counts[used]), _lists(sums[used])],
            names=["cluster", "n", "total"],
        )

    return run


def _assignments(centroids: np.ndarray, simplex: Simplex):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _, best, distance = _assigned(batch, centroids, simplex)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(best.astype(np.int32)), pa.array(distance)],
                    names=["id", "cluster", "distance"],
                )

    return run


RESULT = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def cluster_vectors(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    k: int = 16,
    rounds: int = 3,
    size: int = 64,
    scale: int = 64,
    seed: str = "1",
) -> DataFrame:
    """One row per kept vector: id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Kept are vectors of exactly ``size`` components, none null or non-finite; components
    become floor(scale * x). The first centroids are the ``k`` vectors whose
    sha256 of ``<seed>:<id>`` is smallest, in that order (all, if there are fewer; ids that
    occur twice by their vectors, rows without an id last). Each round assigns every vector to
    the nearest centroid, the smaller number among equally near ones, and moves each centroid
    that has vectors to floor(sum / count) of them. ``distance`` is squared.

    Repeated rows count as often as they occur. Without any kept vector the result is empty.
    Other columns are ignored. A component of 2^27 or more after scaling is an error, since
    distances would leave 64 bits; so is a cluster whose sums do.

    What is collected is the ``k`` centroids of each round, from sums that every task adds
    up on its own; all vectors take part in all rounds, whatever their number.
    """
    kept = vectors.select(F.col(id).alias("id"), F.col(vector).alias("v")).filter(complete("v", size))
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    doubles = F.col("v").cast("array<double>")
    kept = kept.select("id", doubles.alias("v"))
    first = kept.select(name.alias("name"), "v").orderBy(F.col("name").asc_nulls_last(), "v").limit(k).collect()
    id_type = vectors.schema[id].dataType.simpleString()
    if not first:
        return vectors.sparkSession.createDataFrame([], f"`{id}` {id_type}, {RESULT}")
    centroids = whole(np.array([row["v"] for row in first], dtype=np.float64), scale)
    simplex = choose_simplex(centroids)
    placed = settle(
        kept.mapInArrow(_in_whole(scale, simplex), f"id {id_type}, q array<int>, apex array<double>")
    )
    for _ in range(rounds):
        parts = placed.mapInArrow(
            _partial_sums(centroids, simplex), "cluster int, n long, total array<long>"
        )
        sums = [F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(size)]
        centroids = centroids.copy()
        for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *sums).collect():
            centroids[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(size)]
    assigned = settle(
        placed.mapInArrow(_assignments(centroids, simplex), f"id {id_type}, cluster int, distance long")
    )
    inertia = dict(assigned.groupBy("cluster").agg(F.sum("distance")).collect())
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    per_cluster = [
        (number, own, sum(inertia.values()), digests[number]) for number, own in inertia.items()
    ]
    named = vectors.sparkSession.createDataFrame(
        per_cluster, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    # k rows at most.
    return assigned.join(F.broadcast(named), "cluster").select(
        F.col("id").alias(id), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
