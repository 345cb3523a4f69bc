from __future__ import annotations

import hashlib
import random

import pytest

from tests.llm.conftest import ODD_ROWS
from tideline.llm import fingerprints as S
from tideline.llm.queries import QUERIES


def slow_prints(spark, texts: list[str]) -> dict[str, int]:
    """Votes counted term by term; only the terms' hashes come from Spark."""
    terms = set()
    split = {t: [w for w in _split(t.lower())] for t in texts}
    for words in split.values():
        terms |= set(zip(words, [*words[1:], None], strict=False))
    rows = spark.createDataFrame(list(terms) or [("", None)], "a string, b string").selectExpr("a", "b", "xxhash64(a, b) h").collect()
    hashes = {(r.a, r.b): r.h % (1 << 64) for r in rows}
    out = {}
    for t, words in split.items():
        votes = [0] * 64
        for term in zip(words, [*words[1:], None], strict=False):
            weight = min(15, sum(len(w.encode()) for w in term if w is not None))
            for bit in range(64):
                votes[bit] += weight if hashes[term] >> bit & 1 else -weight
        out[t] = sum(1 << bit for bit in range(64) if votes[bit] > 0)
    return out


def _split(text: str) -> list[str]:
    return [w.decode() for w in text.encode().split()]


def expected(spark, rows: list[tuple[int, str]]) -> dict:
    ordered = sorted(rows)
    edits = {}
    for k, (doc_id, text) in enumerate(ordered):
        after = ordered[(k + 1) % len(ordered)][1]
        quarter = len(text) // 4
        edits[doc_id] = text[: len(text) - quarter] + after[:quarter], after
    prints = slow_prints(spark, [t for _, t in rows] + [e for e, _ in edits.values()])

    def like(a: str, b: str) -> float:
        return 1 - (prints[a] ^ prints[b]).bit_count() / 64

    return {
        doc_id: (
            len(text), hashlib.sha256(edits[doc_id][0].encode()).hexdigest(), f"{prints[text]:016x}",
            f"{prints[edits[doc_id][0]]:016x}", like(text, edits[doc_id][0]), like(text, edits[doc_id][1]),
            sum((prints[text] ^ prints[other]).bit_count() <= 3 for _, other in rows) - 1 if doc_id % 100 == 0 else None,
        )
        for doc_id, text in rows
    }


def found(r) -> tuple:
    return r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next, r.n_within


def test_query_against_votes_term_by_term(spark, sf_dir, documents):
    rows = QUERIES["op6_document_fingerprints"](spark, sf_dir).collect()
    result = {r.doc_id: found(r) for r in rows}
    assert result == expected(spark, [(d["doc_id"], d["text"] or "") for d in documents])
    assert sum(r.near_edited > r.near_next for r in rows) > 0.97 * len(rows)


def test_long_texts_fill_several_chunks(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choices(["alpha", "beta", "supercalifragilistic", "x"], k=n)) for n in (0, 1, 2047, 2048, 2049, 20_000)]
    texts += [f"{w} " * 5000 for w in ("supercalifragilistic", "incomprehensibilities", "counterrevolutionaries")]
    docs = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    rows = S.fingerprints(docs, ["k"]).collect()
    want = slow_prints(spark, texts)
    assert {r.k: r.fingerprint % (1 << 64) for r in rows} == {k: want[t] for k, t in enumerate(texts)}


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_tables_find_all_within_the_radius(spark, radius):
    rng = random.Random(radius)
    prints = [rng.getrandbits(64) for _ in range(40)]
    prints += [p ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for p in prints for _ in range(10)]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    queries = df.limit(60)
    asked = {r.fingerprint for r in queries.collect()}
    rows = S.within_radius(queries, df, radius).collect()
    pairs = {(r.fingerprint, r.near): r.distance for r in rows}
    mask = (1 << 64) - 1
    assert len(pairs) == len(rows)
    assert pairs == {(a, b): ((a ^ b) & mask).bit_count() for a in asked for b in set(signed) if ((a ^ b) & mask).bit_count() <= radius}


def test_odd_rows(spark, odd, nothing):
    rows = S.compare_edits(odd).collect()
    assert len(rows) == len(ODD_ROWS)
    blank = [r for r in rows if r.doc_id in (1, 2, 3)]
    assert len(blank) == 3 and {r.fingerprint for r in blank} == {0}
    assert len({r.edited_sha256 for r in rows if r.doc_id == 8}) == 2
    assert S.compare_edits(nothing).count() == 0
    alone = S.compare_edits(spark.createDataFrame([(100, "only one here")], "doc_id long, text string")).collect()
    assert [(r.near_next, r.n_within) for r in alone] == [(1.0, 0)]
