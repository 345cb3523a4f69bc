from __future__ import annotations

import hashlib
import math

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tideline.llm import centroid_clusters as S
from tideline.llm.queries import ORACLES, QUERIES

SCHEMA = "vec_id long, embedding array<float>, cluster string, distance string, parts string, apex string"


def brute(rows: list[tuple], clusters: int, rounds: int, dimensions: int) -> list[tuple]:
    """The definition, vector by vector, in Python integers."""
    kept = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:clusters]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        label = [near(v)[1] for _, v in kept]
        for k in range(len(centroids)):
            own = [v for (_, v), n in zip(kept, label) if n == k]
            if own:
                centroids[k] = [sum(x) // len(own) for x in zip(*own)]
    last = [near(v) for _, v in kept]
    inertia = sum(d for d, _ in last)
    out = []
    for (i, _), (d, k) in zip(kept, last):
        digest = hashlib.sha256(",".join(map(str, centroids[k])).encode()).hexdigest()
        out.append((i, k, d, sum(x for x, n in last if n == k), inertia, digest))
    return sorted(out, key=repr)


def found(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 9), st.integers(1, 12), st.sampled_from([1, 3, 40, 10**7]))
def test_nearest_equals_all_distances(seed, width, count, spread):
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-spread, spread + 1, (60, width))
    centroids = rng.integers(-spread, spread + 1, (count, width))
    simplex = S.Simplex.of(vectors[:20], 5)
    label, distance, compared = S.nearest(vectors, simplex.apexes(vectors), centroids, simplex.apexes(centroids))
    every = S.squared_distances(vectors, centroids)
    assert label.tolist() == every.argmin(axis=1).tolist() and distance.tolist() == every.min(axis=1).tolist()
    assert len(vectors) <= compared <= every.size


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 30), st.integers(2, 12))
def test_bounds_hold(seed, width, pivots):
    rng = np.random.default_rng(seed)
    points = rng.integers(-300, 300, (40, width))
    simplex = S.Simplex.of(points, pivots)
    apexes = simplex.apexes(points)
    low, high = S.bounds(apexes, apexes)
    every = S.squared_distances(points, points)
    assert (low <= every).all() and (every <= high).all()


def test_few_distances_where_vectors_gather():
    rng = np.random.default_rng(3)
    centres = rng.integers(-256, 256, (40, 64))
    vectors = np.repeat(centres, 50, axis=0) + rng.integers(-20, 20, (2000, 64))
    simplex = S.Simplex.of(centres)
    _, _, compared = S.nearest(vectors, simplex.apexes(vectors), centres, simplex.apexes(centres))
    assert compared < 3 * len(vectors)


def test_query_against_brute_force_and_sql(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = found(QUERIES["op13_centroid_clusters"](spark, sf_dir))
    assert got == brute(rows, 40, 5, 64)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    shown = db.execute(f"SELECT vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 FROM ({ORACLES['op13_centroid_clusters']})")
    assert sorted(shown.fetchall(), key=repr) == got


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[0.5, -0.25], [0.5, -0.25], [-1.0, 2.0], [0.0, 0.0], [nan, 1.0], [inf, 1.0], [None, 1.0], [1.0], [1.0, 2.0, 3.0], [], None, [0.5, -0.25]]
    rows = [(k if k < 11 else None, v) for k, v in enumerate(vectors)] + [(2, [-1.0, 2.0]), (None, [9.0, 9.0]), (2, [3.0, 3.0])]
    df = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA)
    for clusters in (1, 3, 100):
        got = found(S.centroid_clusters(df, clusters=clusters, rounds=2, dimensions=2, pivots=3))
        assert got == brute(rows, clusters, 2, 2)
    assert S.centroid_clusters(df.limit(0)).count() == 0
    assert S.centroid_clusters(df, dimensions=64).count() == 0


def test_a_component_too_large_is_an_error(spark):
    df = spark.createDataFrame([(1, [1e20, 0.0], "a", "b", "c", "d")], SCHEMA)
    with pytest.raises(Exception, match="too large"):
        S.centroid_clusters(df, dimensions=2).collect()
