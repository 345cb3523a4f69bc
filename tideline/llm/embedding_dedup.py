"""Near-duplicate vectors by product quantisation over coarse inverted lists, with an exact rerank."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.components import connected_components
from tideline.session import materialise

THRESHOLD = 0.9
#: Vectors that the index is fitted on, at most; chosen by a hash of their components.
MAX_SAMPLE = 32_768
#: Lists, at most; below that, the square root of the number of distinct vectors.
MAX_LISTS = 8_192
SUBSPACES = 8
CODES = 256
#: Share of the pairs right at the threshold that the measured margin lets meet.
RECALL = 0.999
#: Pairs of each kind that a margin is measured on.
TRIALS = 4_096
#: Vectors whose likeness to all centroids is held at once.
SLICE = 1_024
#: Members and queries that one group compares, at most about.
MEMBERS, QUERIES = 512, 1024


@dataclass(frozen=True)
class Index:
    """Unit centroids of the lists, and for each subspace the codes of what is left of a vector there."""

    centroids: np.ndarray
    cuts: np.ndarray
    codebooks: list[np.ndarray]

    def likeness(self, units: np.ndarray) -> np.ndarray:
        return units @ self.centroids.T

    def probes(self, units: np.ndarray, margin: float) -> tuple[np.ndarray, list[np.ndarray]]:
        """The list of each vector, and all lists whose centroids are at most ``margin`` less like it."""
        own, probed = [], []
        for part in _slices(units):
            likeness = self.likeness(part)
            own.append(likeness.argmax(axis=1))
            probed += [np.flatnonzero(row >= row.max() - margin) for row in likeness]
        return np.concatenate(own), probed

    def encode(self, units: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The codes of each vector's residual, and how far the coded vector is from it."""
        rest = units - self.centroids[lists]
        codes = np.empty((len(units), len(self.codebooks)), dtype=np.uint8)
        error = np.zeros(len(units))
        for m, book in enumerate(self.codebooks):
            part = rest[:, self.cuts[m] : self.cuts[m + 1]]
            distance = _distances(part, book)
            codes[:, m] = distance.argmin(axis=1)
            error += np.square(part - book[codes[:, m]]).sum(axis=1)
        return codes, np.sqrt(error)

    def tables(self, units: np.ndarray, list_: int) -> list[np.ndarray]:
        """For each subspace, the squared distance of each vector's residual to each code."""
        rest = units - self.centroids[list_]
        return [_distances(rest[:, self.cuts[m] : self.cuts[m + 1]], book) for m, book in enumerate(self.codebooks)]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    found = np.square(a).sum(axis=1)[:, None] - 2 * (a @ b.T) + np.square(b).sum(axis=1)
    return np.maximum(found, 0)


def _slices(units: np.ndarray) -> list[np.ndarray]:
    return [units[start : start + SLICE] for start in range(0, len(units), SLICE)]


def _nearest(units: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.concatenate([(part @ centroids.T).argmax(axis=1) for part in _slices(units)])


def _means(points: np.ndarray, groups: np.ndarray, old: np.ndarray) -> np.ndarray:
    counts = np.bincount(groups, minlength=len(old))
    sums = np.stack([np.bincount(groups, points[:, d], minlength=len(old)) for d in range(points.shape[1])], axis=1)
    return np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], old)


def fit_index(units: np.ndarray, lists: int, rounds: int = 8) -> Index:
    """Spherical k-means for the lists, then k-means in each subspace of the residuals."""
    random = np.random.default_rng(0)
    lists = max(1, min(lists, len(units)))
    centroids = units[random.choice(len(units), lists, replace=False)]
    for _ in range(rounds):
        means = _means(units, _nearest(units, centroids), centroids)
        centroids = means / np.maximum(np.linalg.norm(means, axis=1), 1e-12)[:, None]
    rest = units - centroids[_nearest(units, centroids)]
    cuts = np.linspace(0, units.shape[1], min(SUBSPACES, units.shape[1]) + 1).astype(int)
    books = []
    for start, end in zip(cuts[:-1], cuts[1:], strict=True):
        part = rest[:, start:end]
        book = part[random.choice(len(part), min(CODES, len(part)), replace=False)]
        for _ in range(rounds):
            book = _means(part, _distances(part, book).argmin(axis=1), book)
        books.append(book)
    return Index(centroids, cuts, books)


def measured_margin(index: Index, units: np.ndarray, threshold: float, recall: float = RECALL) -> float:
    """How much less like a vector than its own centroid those of lists with near vectors are, but for ``1 - recall``.

    Partners are set right at the threshold from ``units``, which the index was not fitted on: in directions of no
    kind, towards another vector, and towards one of the same list. A pair meets where one of the two probes the
    other's list. The kind that lies widest counts.
    """
    random = np.random.default_rng(1)
    own = _nearest(units, index.centroids)
    order = np.argsort(own, kind="stable")
    beside = np.empty(len(units), dtype=np.int64)
    beside[order] = np.roll(order, 1)
    widest = 0.0
    for kind in ("any", "other", "same"):
        gaps = []
        for _ in range(0, TRIALS, SLICE):
            at = random.integers(len(units), size=SLICE)
            ours = units[at]
            if kind == "any":
                aside = random.normal(size=ours.shape)
            else:
                aside = units[random.integers(len(units), size=SLICE) if kind == "other" else beside[at]]
            aside = aside - (aside * ours).sum(axis=1, keepdims=True) * ours
            length = np.linalg.norm(aside, axis=1)
            ours, aside = ours[length > 1e-9], aside[length > 1e-9] / length[length > 1e-9, None]
            theirs = threshold * ours + np.sqrt(max(0.0, 1 - threshold**2)) * aside
            here, there = index.likeness(ours), index.likeness(theirs)
            rows = np.arange(len(ours))
            asked = here.max(axis=1) - here[rows, there.argmax(axis=1)]
            asking = there.max(axis=1) - there[rows, here.argmax(axis=1)]
            gaps.append(np.minimum(asked, asking))
        found = np.concatenate(gaps)
        if len(found):
            widest = max(widest, float(np.quantile(found, recall, method="higher")))
    # One rounding error more, as equal vectors may be worked out in other batches.
    return widest + 1e-9


def _units(column: pa.Array, dimension: int) -> np.ndarray:
    """The vectors in double precision at length 1, scaled first so that no square is lost."""
    vectors = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def is_usable(vector: Column) -> Column:
    """Whether a vector has components, all of them finite and one of them not zero."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
    margin: float | None = None,
) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Vectors link where their cosine, in double precision, is ``threshold`` or more.
    ``n_links`` counts the other vectors linked directly, ``component_id`` is the
    smallest id reachable by links, and ``kept`` marks the row that bears it. Equal vectors are one
    entry of the index, with the number of its rows.

    Every vector is coded and searched; only the index is fitted on a sample. A vector probes every list whose
    centroid is at most ``margin`` less like it than its own; without one it is measured for each index, on an eighth
    of the sample that the index is not fitted on, so that ``RECALL`` of the pairs right at the threshold meet. A probe
    compares by table look-ups, and drops a pair only if even the coding error
    leaves it too far apart; all others are compared exactly. A list or its probes that
    are many are dealt to several groups, and a group gives sums and a tree of its
    links, never its pairs.

    Vectors of each number of components have an index of their own and link among themselves. Vectors that are
    NULL, empty, zero, or hold NULL or non-finite components link with nothing. A NULL id takes part and is never a
    component id unless the row is on its own. Repeated rows are vectors of their own. An empty table gives no rows.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"))
    usable = rows.where(is_usable(F.col("vector")))
    sizes = sorted(r["d"] for r in usable.select(F.size("vector").alias("d")).distinct().collect())
    found = _alone(rows.where(~is_usable(F.col("vector"))))
    for dimension in sizes:
        found = _near(usable.where(F.size("vector") == dimension), dimension, threshold, margin).unionByName(found)
    return found


def _near(usable: DataFrame, dimension: int, threshold: float, margin: float | None) -> DataFrame:
    """``near_vectors`` of ``usable (vec_id, vector)``, which have ``dimension`` components each."""
    entries = materialise(
        usable.groupBy("vector")
        .agg(F.min("vec_id").alias("head"), F.count("*").alias("rows"))
        .withColumn("node", F.monotonically_increasing_id()),
        "vectors",
    )
    sample = entries.orderBy(F.xxhash64("vector"), "head").limit(MAX_SAMPLE).select("vector").toArrow()
    lists = min(MAX_LISTS, int(entries.count() ** 0.5))
    units = _units(sample.column("vector").combine_chunks(), dimension)
    aside = np.arange(len(units)) % 8 == 0
    index = fit_index(units[~aside] if not aside.all() else units, lists)
    if margin is None:
        margin = measured_margin(index, units[aside], threshold)

    found = _links(entries, index, dimension, threshold, margin)
    links = materialise(found, "links")
    roots = connected_components(links.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = links.groupBy("node").agg(F.sum("n").alias("n"))
    named = (
        entries.select("node", "head", "rows")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
        .join(counts, "node", "left")
    )
    smallest = named.groupBy("root").agg(F.min("head").alias("component_id"))
    labels = named.join(smallest, "root").select(
        "node", (F.coalesce("n", F.lit(0)) + F.col("rows") - 1).alias("n_links"), "component_id"
    )
    labelled = entries.select("node", "vector").join(labels, "node").drop("node")
    known = usable.join(labelled, "vector").select("vec_id", "n_links", "component_id")
    return known.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _alone(rows: DataFrame) -> DataFrame:
    return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))


def _links(entries: DataFrame, index: Index, dimension: int, threshold: float, margin: float) -> DataFrame:
    """``(node, n, root)``: for each group that finds links of a node, their number and a root they share."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = _units(batch.column("vector"), dimension)
            if not len(units):
                continue
            own, probed = index.probes(units, margin)
            codes, error = index.encode(units, own)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"),
                    batch.column("rows"),
                    batch.column("vector"),
                    pa.array(own, pa.int32()),
                    pa.array(probed, pa.list_(pa.int32())),
                    pa.array([c.tobytes() for c in codes], pa.binary()),
                    pa.array(error, pa.float64()),
                ],
                ["node", "rows", "vector", "own", "probes", "codes", "error"],
            )

    kind = entries.schema["vector"].dataType.simpleString()
    placed = materialise(
        entries.select("node", "rows", "vector").mapInArrow(
            place, f"node long, rows long, vector {kind}, own int, probes array<int>, codes binary, error double"
        ),
        "placed",
    )
    # A row for each list, so at most MAX_LISTS of them.
    blocks = placed.groupBy(F.col("own").alias("list")).agg(F.ceil(F.count("*") / MEMBERS).alias("blocks"))
    chunks = placed.select(F.explode("probes").alias("list")).groupBy("list").agg(F.ceil(F.count("*") / QUERIES).alias("chunks"))
    dealt = F.broadcast(blocks.join(chunks, "list"))
    keys = ["list", "block", "chunk"]
    members = placed.withColumnRenamed("own", "list").join(dealt, "list").select(
        "list",
        F.pmod(F.xxhash64("node"), "blocks").alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"),
        "node",
        "rows",
        "vector",
        "codes",
        "error",
        "probes",
    )
    queries = (
        placed.select("node", "rows", "vector", "own", F.explode("probes").alias("list"))
        .join(dealt, "list")
        .select(
            "list",
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
            F.pmod(F.xxhash64("node"), "chunks").alias("chunk"),
            F.col("node").alias("asking"),
            F.col("vector").alias("asked"),
            F.col("rows").alias("asking_rows"),
            F.col("own").alias("asking_list"),
        )
    )

    def compare(ours: pa.Table, theirs: pa.Table) -> pa.Table:
        if not len(ours) or not len(theirs):
            return pa.table({"node": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        return _compare(ours, theirs, index, dimension, threshold)

    return (
        members.groupBy(*keys)
        .cogroup(queries.groupBy(*keys))
        .applyInArrow(compare, "node long, n long, root long")
    )


def _compare(members: pa.Table, queries: pa.Table, index: Index, dimension: int, threshold: float) -> pa.Table:
    list_ = members.column("list")[0].as_py()
    ours = _units(members.column("vector").combine_chunks(), dimension)
    theirs = _units(queries.column("asked").combine_chunks(), dimension)
    nodes, asking = members.column("node").to_numpy(), queries.column("asking").to_numpy()
    rows, error = members.column("rows").to_numpy(), members.column("error").to_numpy()
    codes = np.frombuffer(b"".join(members.column("codes").to_pylist()), dtype=np.uint8).reshape(len(nodes), -1)
    reach = np.square(np.sqrt(max(0.0, 2 - 2 * threshold)) + error + 1e-6)
    pairs = []
    for start in range(0, len(asking), 256):
        tables = index.tables(theirs[start : start + 256], list_)
        distance = np.zeros((len(tables[0]), len(nodes)))
        for m, table in enumerate(tables):
            distance += table[:, codes[:, m]]
        q, r = np.nonzero(distance <= reach)
        q += start
        exact = np.einsum("ij,ij->i", theirs[q], ours[r]) >= threshold
        pairs.append((q[exact & (asking[q] != nodes[r])], r[exact & (asking[q] != nodes[r])]))
    q, r = (np.concatenate(x) for x in zip(*pairs, strict=True))
    # A member that does not probe the asking vector's list counts it here, as it never asks for it.
    probes = members.column("probes").combine_chunks()
    lists = len(index.centroids)
    asks = np.repeat(np.arange(len(nodes)), probes.value_lengths().to_numpy()) * lists + probes.flatten().to_numpy()
    owed = ~np.isin(r * lists + queries.column("asking_list").to_numpy()[q], asks)
    asking_rows = queries.column("asking_rows").to_numpy()
    names, at = np.unique(np.concatenate([asking[q], nodes[r]]), return_inverse=True)
    root = names[_roots(len(names), at[: len(q)], at[len(q) :])]
    n = np.bincount(at[: len(q)], rows[r], minlength=len(names))
    n += np.bincount(at[len(q) :][owed], asking_rows[q][owed], minlength=len(names))
    n = n.astype(np.int64)
    return pa.table({"node": names, "n": n, "root": root})


def _roots(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of ``size`` indices is linked to, by pairs ``a, b``."""
    root = np.arange(size)
    while True:
        new = root.copy()
        np.minimum.at(new, a, root[b])
        np.minimum.at(new, b, root[a])
        new = new[new]
        if (new == root).all():
            return root
        root = new
