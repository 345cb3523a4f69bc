from __future__ import annotations

import hashlib
import re

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import ODD_ROWS
from tideline.llm import fill_in_middle as S
from tideline.llm.queries import ORACLES, QUERIES

TEXTS = st.text(alphabet="aé漢😀 \n\t.<P>S", max_size=40) | st.text(max_size=300)
EVERY = ("n", "form", "prefix_chars", "middle_chars", "output", "restored", "output_sha256", "restored_sha256")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id: int | None, text: str | None) -> tuple:
    """The contract, in code points."""
    text = text or ""
    n = len(text)
    h = digest(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 7), max_size=400), st.data())
def test_ranks_and_places(symbols, data):
    array = np.array(symbols, dtype=np.uint8)
    matrix = S.WaveletMatrix(array, 3)
    end = data.draw(st.integers(0, len(symbols)))
    for which in range(3):
        places = [k for k, x in enumerate(symbols) if x >> which & 1]
        assert matrix.with_bit(which, end) == sum(k < end for k in places)
        assert [matrix.place(which, k) for k in range(len(places) + 1)] == [*places, len(symbols)]


def pieces(text: str, unit: str) -> list[str]:
    if unit == "character":
        return list(text)
    if unit == "line":
        return re.findall(r"[^\n]*\n|[^\n]+", text)
    words = [m.start() for m in re.finditer(r"[^ \t-\r]+", text)]
    return [text[a:b] for a, b in zip([0, *words[1:]], [*words[1:], len(text)])] if words else []


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.sampled_from(list(S.UNITS)), st.data())
def test_cuts_between_units(text, unit, data):
    cutter = S.Cutter(text.encode(), unit)
    want = pieces(text, unit)
    assert cutter.n == len(want)
    k = data.draw(st.integers(0, len(want)))
    expected_end = len("".join(want[:k]).encode()) if k < len(want) or not k else len(text.encode())
    assert cutter.at(k) == expected_end
    assert cutter.characters(0, cutter.at(k)) == len(text.encode()[: cutter.at(k)].decode())


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.integers(-5, 10**6), st.sampled_from(list(S.UNITS)))
def test_forms_and_round_trip(text, doc_id, unit):
    form, out, n, one, two, prefix, middle = S.transform(text.encode(), S.draws(str(doc_id), 1), unit)
    assert S.restore(out, form) == text.encode()
    if unit == "character":
        plain = form == "plain"
        assert (n, form, None if plain else prefix, None if plain else middle, out.decode()) == expected(doc_id, text)
    elif form != "plain":
        assert text.encode()[:one].decode() + text.encode()[one:two].decode() + text.encode()[two:].decode() == text


def test_query_against_the_contract_and_sql(spark, sf_dir, documents):
    rows = {r.doc_id: r for r in QUERIES["op12_fill_in_middle"](spark, sf_dir).collect()}
    assert len(rows) == len(documents)
    for d in documents:
        n, form, a, b, out = expected(d["doc_id"], d["text"])
        r = rows[d["doc_id"]]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, a, b)
        assert (r.output_sha256, r.restored_sha256) == (digest(out), digest(d["text"] or ""))
    assert {r.form for r in rows.values()} == {"plain", "psm", "spm"}
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    names = "doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256"
    shown = db.execute(f"SELECT {names} FROM ({ORACLES['op12_fill_in_middle']})").fetchall()
    assert sorted(shown) == sorted(tuple(r[c] for c in names.split(", ")) for r in rows.values())


def test_odd_rows(odd, nothing):
    rows = S.fill_in_middle(odd, outputs=EVERY).collect()
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in rows), key=repr)
    assert got == sorted(((i, *expected(i, t)) for i, t, _ in ODD_ROWS), key=repr)
    assert sorted(r.restored for r in rows) == sorted(t or "" for _, t, _ in ODD_ROWS)
    assert all(digest(r.output) == r.output_sha256 and digest(r.restored) == r.restored_sha256 for r in rows)
    assert S.fill_in_middle(nothing).count() == 0


def test_large_batches_are_handed_on_in_parts(spark, monkeypatch):
    text = "x é\n" * 3_000_000
    docs = spark.createDataFrame([(k, text) for k in range(3)], "doc_id long, text string").coalesce(1)
    rows = S.fill_in_middle(docs, unit="line", outputs=("n", "restored_sha256")).collect()
    assert [(r.n, r.restored_sha256) for r in sorted(rows)] == [(3_000_000, digest(text))] * 3


def test_wrong_settings(odd):
    with pytest.raises(ValueError, match="sentinels"):
        S.fill_in_middle(odd, sentinels=("<P>", "<P>", "<M>"))
    with pytest.raises(ValueError, match="outputs or unit"):
        S.fill_in_middle(odd, unit="page")
