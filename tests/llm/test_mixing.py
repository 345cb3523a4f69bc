from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ODD_ROWS
from tideline.llm import mixing as S
from tideline.llm.queries import QUERIES


def n_words(text: str | None) -> int:
    return len((text or "").encode().split())


def slow_targets(sizes: dict[str | None, int], weights=(3, 1, 2), share=1.5) -> dict:
    names = sorted((n for n in sizes if n is not None), key=lambda n: [ord(c) for c in n]) + [n for n in sizes if n is None]
    weight = {n: weights[k % len(weights)] for k, n in enumerate(names)}
    target, free, left = {}, set(sizes), share * sum(sizes.values())
    while free:
        level = left / sum(weight[n] for n in free)
        over = [n for n in free if level * weight[n] > 2 * sizes[n]]
        if not over:
            return target | {n: level * weight[n] for n in free}
        for n in over:
            target[n] = 2 * sizes[n]
            free.discard(n)
            left -= target[n]
    return target


def check(rows, docs: list[tuple]) -> None:
    """``docs`` are (id, text, source) with an id of their own."""
    sizes: Counter = Counter()
    for _, text, source in docs:
        sizes[source] += n_words(text)
    targets = slow_targets(sizes)
    by_id = {d[0]: d for d in docs}
    taken: Counter = Counter()
    largest: Counter = Counter()
    assert len(rows) == len(docs)
    for r in rows:
        _, text, source = by_id[r.doc_id]
        assert (r.size, r.source_size) == (n_words(text), sizes[source])
        assert r.target == pytest.approx(targets[source])
        whole = int(targets[source] / sizes[source] + 1e-9) if sizes[source] else 0
        assert r.taken in (whole * r.size, (whole + 1) * r.size) and r.taken <= 2 * r.size
        taken[source] += r.taken
        largest[source] = max(largest[source], r.size)
    for source in sizes:
        assert taken[source] <= targets[source] + 1e-6
        assert taken[source] >= targets[source] - largest[source]


def test_query(spark, sf_dir, documents):
    rows = QUERIES["op10_source_mixing"](spark, sf_dir).collect()
    check(rows, [(d["doc_id"], d["text"], d["source"]) for d in documents])
    again = QUERIES["op10_source_mixing"](spark, sf_dir).collect()
    assert sorted(rows) == sorted(again)


def test_sources_of_many_sizes(spark):
    docs = []
    for k, (source, n) in enumerate([("b", 300), ("a", 5), (None, 80), ("é", 1), ("Z", 40), ("", 60), ("empty", 3)]):
        docs += [(1000 * k + j, "" if source == "empty" else "w " * (1 + j * 7 % 23), source) for j in range(n)]
    rows = S.mix(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()
    check(rows, docs)


def slow_taken(rows: list[tuple], sizes: dict, targets: dict) -> dict[int, int]:
    """Words taken of each ``(id, size, source, key)``: whole epochs, then passes along the keys, one row after another."""
    taken = {}
    for source, size in sizes.items():
        members = sorted((r for r in rows if r[2] == source), key=lambda r: r[3])
        whole = int(targets[source] / size + 1e-9) if size else 0
        room = targets[source] - whole * size
        drawn = set()
        for _ in range(S.PASSES):
            largest = room
            for doc_id, n, _, _ in members:
                if doc_id in drawn or n > largest:
                    continue
                if n > room:
                    break
                drawn.add(doc_id)
                room -= n
        taken |= {doc_id: n * (whole + (doc_id in drawn)) for doc_id, n, _, _ in members}
    return taken


def test_drawing_against_one_row_after_another(spark, sf_dir, documents):
    sizes: Counter = Counter()
    for d in documents:
        sizes[d["source"]] += n_words(d["text"])
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    key = S.sampling_key(F.col("doc_id"), F.col("text"), S.quality_weight(F.col("text")))
    keys = docs.select("doc_id", "text", "source", key.alias("key")).collect()
    want = slow_taken([(r.doc_id, n_words(r.text), r.source, r.key) for r in keys], sizes, slow_targets(sizes))
    rows = QUERIES["op10_source_mixing"](spark, sf_dir).collect()
    assert {r.doc_id: r.taken for r in rows} == want


def test_chances_follow_the_weights(spark):
    docs = [(k, "one two three four", "a" if k % 2 else "b", 0.9 if k % 4 < 2 else 0.1) for k in range(4000)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, q double")
    rows = S.mix(df, quality_col="q", share=0.5, weights=(1,)).collect()
    drawn = Counter(docs[r.doc_id][3] for r in rows if r.taken)
    assert sum(drawn.values()) == 2000 and drawn[0.9] > 2.5 * drawn[0.1]


def test_rows_are_repeated(spark, odd, nothing):
    copies = Counter()
    for r in S.mix(odd).collect():
        copies[r.doc_id] += r.copies
    mixed = S.mixed(odd)
    assert mixed.columns == odd.columns
    found = Counter(r.doc_id for r in mixed.collect())
    assert found == Counter({k: n for k, n in copies.items() if n})
    assert S.mix(odd).count() == len(ODD_ROWS)
    assert S.mix(nothing).count() == 0 and S.mixed(nothing).count() == 0
