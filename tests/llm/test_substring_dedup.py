from __future__ import annotations

import hashlib
import random

import pytest

from tests.llm.conftest import ODD_ROWS
from tideline.llm import substring_dedup as S
from tideline.llm.queries import QUERIES


def slow(rows: list[tuple[int | None, str | None]], window: int) -> list[tuple]:
    first: dict[tuple, int] = {}
    for doc_id, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        words = (text or "").encode().split()
        for i in range(len(words) - window + 1):
            first.setdefault(tuple(words[i : i + window]), doc_id)
    out = []
    for doc_id, text in rows:
        words = (text or "").encode().split()
        keep = [True] * len(words)
        for i in range(len(words) - window + 1):
            if doc_id is not None and first[tuple(words[i : i + window])] < doc_id:
                keep[i : i + window] = [False] * window
        kept = b" ".join(w for w, k in zip(words, keep, strict=True) if k)
        out.append((doc_id, len(words), keep.count(False), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(df) -> list[tuple]:
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=repr)


def test_query_against_all_windows(spark, sf_dir, documents):
    rows = found(QUERIES["op3_substring_dedup"](spark, sf_dir))
    assert rows == slow([(d["doc_id"], d["text"]) for d in documents], 13)
    assert sum(r[2] for r in rows) > 1000


@pytest.mark.parametrize(("window", "seed"), [(2, 1), (5, 2), (13, 3), (30, 4)])
def test_texts_of_few_words(spark, window, seed):
    rng = random.Random(seed)
    rows = [(rng.randint(0, 30), " ".join(rng.choices("abcd", k=rng.randint(0, 60)))) for _ in range(60)]
    passage = " ".join(f"p{k}" for k in range(40))
    rows += [(40 + k, f"x{k} {passage} y{k} {passage[: 50 + k]}") for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(S.removal_digest(docs, window=window)) == slow(rows, window)


def test_pieces_of_a_long_text(spark, monkeypatch):
    words = [f"w{k % 37}" for k in range(400)]
    whole = S._anchored([w.encode() for w in words], 13)
    monkeypatch.setattr(S, "PIECE", 50)
    cut = S._anchored([w.encode() for w in words], 13)
    assert (whole[3] == cut[3]).all()


def test_spans_are_what_is_removed(spark):
    passage = " ".join(f"p{k}" for k in range(20))
    rows = [(1, f"a b {passage} c"), (2, f"d {passage} e f {passage}")]
    found_rows = {r.doc_id: r for r in S.remove_repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found_rows[1].spans == [] and found_rows[1].kept_text == rows[0][1]
    assert [(s.first, s.end) for s in found_rows[2].spans] == [(1, 21), (23, 43)]
    assert found_rows[2].kept_text == "d e f"


def test_odd_rows(odd, nothing):
    assert found(S.removal_digest(odd)) == slow([(i, t) for i, t, _ in ODD_ROWS], 13)
    assert S.removal_digest(nothing).count() == 0
