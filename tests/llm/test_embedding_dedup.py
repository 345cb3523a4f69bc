from __future__ import annotations

import numpy as np
import pytest

from tests.llm.test_simhash_dedup import smallest
from tideline.llm import embedding_dedup as S
from tideline.llm.queries import QUERIES


def slow(ids: list[int], vectors: np.ndarray, threshold: float = 0.9) -> dict:
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = units @ units.T >= threshold
    np.fill_diagonal(near, False)
    links = {i: [ids[k] for k in np.flatnonzero(row)] for i, row in zip(ids, near, strict=True)}
    roots = smallest(links)
    return {i: (len(links[i]), roots[i], roots[i] == i) for i in ids}


def found(df) -> dict:
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


def clustered(seed: int, groups: int, each: int, noise: float, dimension: int = 64) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dimension))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    spread = rng.normal(size=(groups, each, dimension)) * noise / np.sqrt(dimension)
    return (centres[:, None, :] + spread).reshape(-1, dimension).astype(np.float32)


def test_query_against_all_pairs(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    want = slow([r.vec_id for r in table], np.array([r.embedding for r in table], dtype=np.float64))
    assert found(QUERIES["op1_embedding_near_dedup"](spark, sf_dir)) == want


@pytest.mark.parametrize("noise", [0.1, 0.3, 0.45])
def test_recall_near_the_threshold(spark, noise):
    vectors = clustered(1, 150, 6, noise)
    vectors = np.concatenate([vectors, clustered(2, 1, 600, noise), vectors[:200]])
    ids = list(range(len(vectors)))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vectors, strict=True)], "vec_id long, embedding array<float>")
    want, got = slow(ids, vectors.astype(np.float64)), found(S.near_vectors(df))
    links = sum(n for n, _, _ in want.values())
    assert sum(got[i][0] for i in ids) >= 0.99 * links and all(got[i][0] <= want[i][0] for i in ids)
    assert np.mean([got[i][1] == want[i][1] for i in ids]) > 0.99


@pytest.mark.parametrize(("dimension", "most"), [(64, 0.6), (768, 0.25)])
def test_measured_margin(dimension, most):
    """Pairs at the threshold that the index never saw meet, without a look at most lists."""
    rng = np.random.default_rng(12)

    def unit(x):
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    units = unit(rng.normal(size=(6000, dimension)))
    index = S.fit_index(units[:4000], 96, 4)
    margin = S.measured_margin(index, units[4000:5000], 0.9)
    ours = units[5000:]
    aside = rng.normal(size=ours.shape)
    aside = unit(aside - (aside * ours).sum(axis=1, keepdims=True) * ours)
    theirs = 0.9 * ours + np.sqrt(1 - 0.9**2) * aside
    own, probed = index.probes(ours, margin)
    other, asked = index.probes(theirs, margin)
    met = [o in p or w in a for w, p, o, a in zip(own, probed, other, asked, strict=True)]
    assert np.mean(met) >= 0.99
    assert np.mean([len(p) for p in probed]) <= most * 96
    assert all(w in p for w, p in zip(own, probed, strict=True))


def test_recall_in_768_dimensions(spark):
    vectors = np.concatenate([clustered(13, 200, 4, 0.32, 768), clustered(14, 1, 60, 0.32, 768), clustered(15, 400, 1, 0.1, 768)])
    ids = list(range(len(vectors)))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vectors, strict=True)], "vec_id long, embedding array<float>")
    want, got = slow(ids, vectors.astype(np.float64)), found(S.near_vectors(df))
    links = sum(n for n, _, _ in want.values())
    assert links > 3000 and sum(got[i][0] for i in ids) >= 0.99 * links
    assert all(got[i][0] <= want[i][0] for i in ids)


def test_slices_give_what_the_whole_gives(monkeypatch):
    units = clustered(16, 30, 10, 0.3).astype(np.float64)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    whole = S.fit_index(units, 12)
    own, probed = whole.probes(units, 0.1)
    monkeypatch.setattr(S, "SLICE", 7)
    parts = S.fit_index(units, 12)
    assert np.allclose(parts.centroids, whole.centroids)
    again, probed_again = whole.probes(units, 0.1)
    assert (own == again).all() and all((a == b).all() for a, b in zip(probed, probed_again, strict=True))


def test_hot_lists_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(S, "MEMBERS", 20)
    monkeypatch.setattr(S, "QUERIES", 30)
    vectors = np.concatenate([clustered(5, 1, 200, 0.2), clustered(6, 40, 2, 0.1)])
    ids = list(range(len(vectors)))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vectors, strict=True)], "vec_id long, embedding array<float>")
    assert found(S.near_vectors(df)) == slow(ids, vectors.astype(np.float64))


@pytest.mark.parametrize("margin", [0.02, 0.1])
def test_both_ends_count_a_link(spark, margin):
    rng = np.random.default_rng(8)
    units = rng.normal(size=(2000, 64))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    aside = rng.normal(size=units.shape)
    aside -= (aside * units).sum(axis=1, keepdims=True) * units
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    near = 0.91 * units + np.sqrt(1 - 0.91**2) * aside
    # The first of every other pair has three rows.
    rows = [(k, n, v.tolist()) for k in range(2000) for v, n in [(units[k], 1 + k % 2 * 2), (near[k], 1)]]
    rows = [(2 * k + (j % 2), v) for j, (k, n, v) in enumerate(rows) for _ in range(n)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got: dict = {}
    for r in S.near_vectors(df, margin=margin).collect():
        got.setdefault(r.vec_id, set()).add(r.n_links)
    ends = {(got[2 * k].pop(), got[2 * k + 1].pop()) for k in range(0, 2000, 2)}
    assert ends == {(0, 0), (1, 1)}
    assert {(got[2 * k].pop(), got[2 * k + 1].pop()) for k in range(1, 2000, 2)} == {(2, 0), (3, 3)}


def test_each_number_of_components_is_searched(spark):
    tables = [clustered(9, 30, 4, 0.2), clustered(10, 20, 4, 0.2, 32), clustered(11, 10, 4, 0.2, 16)]
    rows, want = [], {}
    for start, vectors in zip((0, 1000, 2000), tables, strict=True):
        ids = list(range(start, start + len(vectors)))
        rows += [(i, v.tolist()) for i, v in zip(ids, vectors, strict=True)]
        want |= slow(ids, vectors.astype(np.float64))
    assert found(S.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))) == want
    assert all(any(want[i][0] for i in want if i // 1000 == k) for k in range(3))


def test_codes_and_errors():
    units = clustered(3, 50, 20, 0.3).astype(np.float64)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    index = S.fit_index(units, 10)
    lists = index.likeness(units).argmax(axis=1)
    codes, error = index.encode(units, lists)
    coded = index.centroids[lists] + np.concatenate([b[codes[:, m]] for m, b in enumerate(index.codebooks)], axis=1)
    assert np.allclose(np.linalg.norm(units - coded, axis=1), error)
    here = np.flatnonzero(lists == lists[0])
    tables = index.tables(units[:5], int(lists[0]))
    looked_up = sum(t[:, codes[here, m]] for m, t in enumerate(tables))
    assert np.allclose(looked_up, np.square(units[:5, None, :] - coded[here][None]).sum(axis=2))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [1.0, nan]), (6, [1.0, inf]), (7, [1.0, 2.0]),
        (7, [1.0, 2.0]), (8, [2.0, 4.0]), (9, [-1.0, -2.0]), (10, [1.0, 2.0, 3.0]), (None, [1.0, 2.1]), (11, [1e-30, 2e-30]),
        (None, None), (12, [1e30, 2e30]),
    ]
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], "vec_id long, embedding array<double>, node string, root string, n string")
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in S.near_vectors(df).collect()), key=repr)
    linked = [(7, 5, 7), (7, 5, 7), (8, 5, 7), (None, 5, 7), (11, 5, 7), (12, 5, 7)]
    alone = [(i, 0, i) for i in (1, 2, 3, 4, 5, 6, 9, 10, None)]
    assert got == sorted(linked + alone, key=repr)
    assert S.near_vectors(df.where("false")).count() == 0
    assert S.near_vectors(df.where("vec_id < 6")).count() == 5
