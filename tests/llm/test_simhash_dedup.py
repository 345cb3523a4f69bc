from __future__ import annotations

import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import ODD_ROWS
from tideline.llm import simhash_dedup as S
from tideline.llm.components import connected_components
from tideline.llm.queries import QUERIES


def slow_fingerprint(text: bytes) -> int:
    words = text.lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [b" ".join(words)] * bool(words)
    votes = [0] * 64
    for shingle in shingles:
        h = xxhash.xxh64_intdigest(shingle, 42)
        for bit in range(64):
            votes[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * votes[bit] > len(shingles))


def smallest(links: dict) -> dict:
    """The smallest node reachable from each, by search."""
    found = {}
    for start in sorted(links):
        if start not in found:
            todo = [start]
            while todo:
                node = todo.pop()
                if node not in found:
                    found[node] = start
                    todo += links[node]
    return found


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB é\t\n\x0b漢", max_size=40))
def test_fingerprint(text):
    assert S.fingerprint(text.encode()) % (1 << 64) == slow_fingerprint(text.encode())


def test_chunks_of_a_long_text(monkeypatch):
    text = " ".join(f"w{k * k % 101}" for k in range(500)).encode()
    monkeypatch.setattr(S, "CHUNK", 7)
    assert S.fingerprint(text) % (1 << 64) == slow_fingerprint(text)


def test_query_against_all_pairs(spark, sf_dir, documents):
    prints = {d["doc_id"]: slow_fingerprint((d["text"] or "").encode()) for d in documents}
    links = {a: [b for b in prints if (prints[a] ^ prints[b]).bit_count() <= 2] for a in prints}
    roots = smallest(links)
    rows = QUERIES["op2_simhash_near_dedup"](spark, sf_dir).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {d: (f"{prints[d]:016x}", roots[d]) for d in prints}
    assert len(rows) == len(documents) > len(set(roots.values()))


def test_components_of_chains_hubs_and_nothing(spark):
    edges = [(k, k + 1) for k in range(0, 300)] + [(1000, k) for k in range(1001, 1400)] + [(1399, 5000), (7, 7), (None, 4)]
    rows = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    found = {r.node: r.root for r in rows}
    assert len(found) == len(rows) == 301 + 401
    assert all(root == (0 if node <= 300 else 1000) for node, root in found.items())
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(spark, odd, nothing):
    rows = S.near_duplicates(odd).collect()
    assert len(rows) == len(ODD_ROWS)
    blank = [r for r in rows if r.fingerprint == 0]
    assert {r.doc_id for r in blank} == {None, 1, 2, 3} and {r.component_id for r in blank} == {1}
    assert {r.component_id for r in rows if r.doc_id in (6, 7)} == {6}
    assert S.near_duplicates(nothing).count() == 0


def near_texts() -> tuple[str, str]:
    """Two texts with fingerprints that differ in one or two bits."""
    words = [f"w{k * k % 997}" for k in range(900)]
    first = " ".join(words)
    for k in range(len(words)):
        other = " ".join([*words[:k], "other", *words[k + 1 :]])
        if 0 < (slow_fingerprint(first.encode()) ^ slow_fingerprint(other.encode())).bit_count() <= 2:
            return first, other
    raise AssertionError("no such texts")


def test_one_row_of_a_group_with_repeated_or_no_ids(spark):
    first, second = near_texts()
    schema = "doc_id long, text string, source string"
    rows = [(3, first, "a"), (3, second, "a"), (3, second, "b"), (4, first, "a"), (None, second, "a")]
    (kept,) = S.one_of_each_group(spark.createDataFrame(rows, schema)).collect()
    smaller = min(first, second, key=lambda t: S.fingerprint(t.encode()))
    assert (kept.doc_id, kept.text, kept.source) == (3, smaller, "a")
    rows = [(None, first, "a"), (None, first, "a"), (None, first, "b"), (None, second, "a"), (None, "quite another text", "a")]
    kept = S.one_of_each_group(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.text, r.source) for r in kept) == sorted([(smaller, "a"), ("quite another text", "a")])


def test_one_row_of_each_group_stays(odd, nothing):
    kept = S.one_of_each_group(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in rows if r.doc_id in (1, 6, 8)) == sorted(
        {(True, i, t or "") for i, t, _ in ODD_ROWS if i in (1, 6, 8)}
    )
    assert not {2, 3, 7} & {r.doc_id for r in rows}
    assert "a row without an id" in {r.text for r in rows}
    assert S.one_of_each_group(nothing).count() == 0
