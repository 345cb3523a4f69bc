from __future__ import annotations

import random

import pytest

from tideline.llm import components as S


def slow(edges: list[tuple]) -> dict[int, int]:
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {x: find(x) for x in root}


def found(spark, edges) -> dict[int, int]:
    rows = S.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(rows) == len({r.node for r in rows})
    return {r.node: r.root for r in rows}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_links(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randint(-60, 60), rng.randint(-60, 60)) for _ in range(70)] + [(None, 1), (2, None), (3, 3), (500, 500)]
    assert found(spark, edges) == slow(edges)


def test_hubs_of_both_kinds(spark):
    low = [(0, k) for k in range(1, 1500)]
    high = [(9000, k) for k in range(3000, 4500)]
    bridge = [(1499, 3000), (2**62, -(2**62)), (2**62, 9000)]
    assert found(spark, low + high + bridge) == slow(low + high + bridge)


def test_no_part_holds_a_hub(spark):
    links = spark.createDataFrame([(0, k) for k in range(1, 6401)] + [(7, 8)], "a long, b long")
    beside = S._beside_least(links)
    assert {(r.a, r.m) for r in beside.collect()} == {(0, 1), (7, 8)} and beside.count() == 6401
    # Links meet their node's minimum by node and part, never by the node alone.
    plan = beside._jdf.queryExecution().analyzed().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert len(joins) == 1 and "part" in joins[0]
    parts = links.selectExpr("a", f"pmod(xxhash64(b), {S.PARTS}) as part").groupBy("a", "part").count()
    assert max(r["count"] for r in parts.collect()) < 200


def test_no_links(spark):
    assert found(spark, []) == {} and found(spark, [(1, 1), (None, None)]) == {}
