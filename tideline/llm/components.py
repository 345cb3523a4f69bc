"""Connected components of a graph of any size, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.session import discard, materialise

#: Each node's neighbours are dealt to so many parts, as many as a long has bits.
PARTS = 64


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``; root is the smallest node of its component.

    Each round links every node to the smallest neighbour it knows, first towards
    larger nodes, then towards smaller ones; the number of rounds grows with the
    logarithm of the longest path. A hub's neighbours are never gathered: they are dealt
    to ``PARTS`` parts, and its minimum is worked out from theirs and joined back to each of them.
    Every round is written to the shared folder. Loops and NULL ends are left out;
    an empty input gives no rows.
    """
    links = materialise(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    state = _state(links)
    while state[0]:
        stars = materialise(_towards_smaller(_towards_larger(links)), "links")
        discard(links)
        links, before, state = stars, state, _state(stars)
        if state == before:
            break
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _beside_least(links: DataFrame) -> DataFrame:
    """``(a, b, m)`` for each of ``links (a, b)``; m is the smallest b beside the same a."""
    dealt = links.withColumn("part", F.pmod(F.xxhash64("b"), F.lit(PARTS)).cast("int"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("part"))
    parts = dealt.groupBy("a", "part").agg(F.min("b").alias("m"))
    least = parts.groupBy("a").agg(F.min("m").alias("m"), F.bit_or(bit).alias("parts"))
    there = F.filter(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda p: F.getbit("parts", p) == 1)
    return dealt.join(least.select("a", "m", F.explode(there).alias("part")), ["a", "part"]).drop("part")


def _towards_larger(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return _beside_least(both).where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))


def _towards_smaller(links: DataFrame) -> DataFrame:
    return (
        _beside_least(links)
        .select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _state(links: DataFrame) -> tuple:
    """Equal for equal sets of links; two numbers reach the driver."""
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
