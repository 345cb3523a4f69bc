"""Exact integer k-means that looks at few centroids: n-simplex projection bounds the distances to the others."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.session import materialise

DIMENSIONS = 64
CLUSTERS = 40
ROUNDS = 5
#: Components are multiplied by this and rounded down.
SCALE = 256
#: Pivots that distances are cached to; a vector has as many apex coordinates.
PIVOTS = 40
#: Larger components could make squared distances overflow.
LARGEST = 1 << 26
#: A pivot must stand this far off the ones before it, as a share of the largest squared distance.
LEAST_ALTITUDE = 1e-3
#: What rounding may do to a bound, as a share of the squared distances that it is made of.
MARGIN = 1e-5


@dataclass(frozen=True)
class Simplex:
    """Pivots, and the place of each in the space that they span, in lower triangular form.

    Of any object only its squared distances to the pivots are used. They give the apex
    that the object makes over the base simplex: its place in the pivots' space, and its
    altitude over it, which is never negative. Two objects are at least as far apart as
    their apexes, and at most as far as if the altitudes pointed in opposite directions.
    """

    pivots: np.ndarray
    base: np.ndarray

    @classmethod
    def of(cls, points: np.ndarray, most: int = PIVOTS) -> Simplex:
        """Pivots out of ``points``, each the farthest off the space of those before it."""
        distances = squared_distances(points, points).astype(np.float64)
        floor = LEAST_ALTITUDE * distances.max(initial=0.0)
        chosen, altitudes = [0], distances[0].copy()
        places = np.zeros((len(points), 0))
        while len(chosen) < most:
            far = int(altitudes.argmax())
            if altitudes[far] <= max(floor, 0.5):
                break
            inner = (distances[0] + distances[0, far] - distances[far]) / 2
            column = (inner - places @ places[far]) / np.sqrt(altitudes[far])
            places = np.column_stack([places, column])
            altitudes = np.maximum(altitudes - column**2, 0.0)
            chosen.append(far)
        return cls(points[chosen], places[chosen[1:]])

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        """For each vector its place in the pivots' space and, last, its altitude."""
        to_pivots = squared_distances(vectors, self.pivots).astype(np.float64)
        first = to_pivots[:, :1]
        own = (self.base**2).sum(axis=1)
        inner = (first + own - to_pivots[:, 1:]) / 2
        places = np.linalg.solve(self.base, inner.T).T if len(self.base) else inner
        altitude = np.sqrt(np.maximum(first[:, 0] - (places**2).sum(axis=1), 0.0))
        return np.column_stack([places, altitude])


def squared_distances(vectors: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact, from integers, one row for each of ``vectors``."""
    out = np.empty((len(vectors), len(others)), dtype=np.int64)
    for k, other in enumerate(others):
        gap = vectors - other
        out[:, k] = np.einsum("ij,ij->i", gap, gap)
    return out


def bounds(apexes: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the squared distances between two sets of apexes, rounding included."""
    sizes, other_sizes = (apexes**2).sum(axis=1)[:, None], (others**2).sum(axis=1)
    low = sizes + other_sizes - 2 * apexes @ others.T
    high = low + 4 * np.outer(apexes[:, -1], others[:, -1])
    slack = MARGIN * (sizes + other_sizes)
    return low - slack, high + slack


def nearest(
    vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, centroid_apexes: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Each vector's nearest centroid (of equal ones the first), its squared distance, and how many distances it took.

    A centroid whose lower bound is above another's upper bound can't be nearest, nor one
    whose lower bound is above the exact distance of the centroid with the least lower bound. The
    others are compared by their exact distances.
    """
    label = np.empty(len(vectors), dtype=np.int64)
    distance = np.empty(len(vectors), dtype=np.int64)
    compared = 0
    step = max(1, (1 << 20) // max(1, centroids.size))
    for start in range(0, len(vectors), step):
        some = slice(start, start + step)
        low, high = bounds(apexes[some], centroid_apexes)
        likely = vectors[some] - centroids[low.argmin(axis=1)]
        limit = np.minimum(high.min(axis=1), np.einsum("ij,ij->i", likely, likely))
        row, column = np.nonzero(low <= limit[:, None])
        gap = vectors[some][row] - centroids[column]
        exact = np.einsum("ij,ij->i", gap, gap)
        compared += len(exact)
        firsts = np.flatnonzero(np.diff(row, prepend=-1))
        least = np.minimum.reduceat(exact, firsts)
        hits = np.flatnonzero(exact == least[row])
        best = hits[np.flatnonzero(np.diff(row[hits], prepend=-1))]
        label[some], distance[some] = column[best], least
    return label, distance, compared


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), width)


def integer_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dimensions: int = DIMENSIONS, scale: int = SCALE
) -> DataFrame:
    """``vec_id, parts`` of the vectors with ``dimensions`` components, none NULL or non-finite."""
    listed = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    finite = F.forall("listed", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform("listed", lambda x: F.floor(_checked(x * F.lit(float(scale)))))
    return (
        vectors.select(F.col(id_col).alias("vec_id"), listed.alias("listed"))
        .where((F.size("listed") == dimensions) & finite)
        .select("vec_id", scaled.alias("parts"))
    )


def _checked(x):
    return F.when(F.abs(x) < LARGEST, x).otherwise(F.raise_error(F.lit("a component is too large for exact distances")).cast("double"))


def first_centroids(vectors: DataFrame, clusters: int, salt: str = "2:") -> np.ndarray:
    """The ``clusters`` vectors with the smallest SHA-256 of ``salt`` and id (none for NULL), in that order."""
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = vectors.select(digest.alias("digest"), "parts").orderBy("digest", "parts").limit(clusters).collect()
    return np.array([r["parts"] for r in rows], dtype=np.int64)


def centroid_clusters(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    pivots: int = PIVOTS,
    salt: str = "2:",
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every usable vector.

    Components become integers ``floor(scale * x)``, and all that follows is exact. Each
    round assigns every vector to the nearest centroid (ties: the smaller number) and replaces
    each centroid by the rounded-down mean of its vectors; an empty one stays. Then vectors
    are assigned once more. The digest is over the final centroid's components in decimal, joined by commas.

    Vectors of another length and those with NULL or non-finite components have no row; a
    component of 2**26 or more after scaling is an error. Repeated rows and NULL ids give a row each. With fewer
    usable vectors than ``clusters`` each starts a cluster. An empty table gives no rows.

    What the driver holds is ``clusters`` centroids, at any size of the input: tasks
    send one row of sums for each cluster, however many of the vectors are in it. The
    vectors, with their cached apexes, are written once and read in every round.
    """
    usable = materialise(integer_vectors(vectors, id_col, vector_col, dimensions, scale), "integer-vectors")
    centroids = first_centroids(usable, clusters, salt)
    schema = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    kind = usable.schema["vec_id"].dataType.simpleString()
    if not len(centroids):
        return usable.sparkSession.createDataFrame([], f"vec_id {kind}, {schema}")
    simplex = Simplex.of(centroids, pivots)
    apex_width = len(simplex.base) + 1

    def with_apexes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apexes = simplex.apexes(_matrix(batch.column("parts"), dimensions, np.int64))
            column = pa.FixedSizeListArray.from_arrays(pa.array(apexes.ravel()), apex_width).cast(pa.list_(pa.float64()))
            yield batch.append_column("apex", column)

    cached = materialise(usable.mapInArrow(with_apexes, f"vec_id {kind}, parts array<long>, apex array<double>"), "apexes")

    def assigned(batch: pa.RecordBatch, now: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        parts = _matrix(batch.column("parts"), dimensions, np.int64)
        apexes = _matrix(batch.column("apex"), apex_width, np.float64)
        label, distance, _ = nearest(parts, apexes, now, simplex.apexes(now))
        return parts, label, distance

    for _ in range(rounds):
        centroids = _moved(cached, centroids, assigned)

    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    final = centroids

    def label_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, label, distance = assigned(batch, final)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(label, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"]
            )

    labelled = materialise(cached.mapInArrow(label_rows, f"vec_id {kind}, cluster int, distance long"), "clusters")
    sums = {r["cluster"]: r["s"] for r in labelled.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    total = sum(sums.values())
    facts = [(k, s, total, digests[k]) for k, s in sums.items()]
    about = usable.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # One row for each cluster.
    return labelled.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _moved(cached: DataFrame, centroids: np.ndarray, assigned) -> np.ndarray:
    """The centroids after one round, from one row of sums for each task and cluster, added up by Spark."""
    count, width = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((count, width), dtype=np.int64), np.zeros(count, dtype=np.int64)
        for batch in batches:
            parts, label, _ = assigned(batch, centroids)
            np.add.at(total, label, parts)
            n += np.bincount(label, minlength=count)
        met = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met, pa.int32()), pa.array(n[met]), pa.array(list(total[met]), pa.list_(pa.int64()))], ["cluster", "n", "total"]
        )

    partial = cached.mapInArrow(sums, "cluster int, n long, total array<long>")
    added = partial.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.get("total", F.lit(i))).alias(f"t{i}") for i in range(width)])
    moved = centroids.copy()
    for row in added.collect():
        moved[row["cluster"]] = [row[f"t{i}"] // row["n"] for i in range(width)]
    return moved
