from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.conftest import ODD_ROWS
from tideline.llm import token_output as S
from tideline.llm.queries import QUERIES
from tideline.session import new_folder

FILE = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(FILE)
ENCODER = S.ByteEncoder(FILE)
ALPHABET = "aZ \t\n\r\x1c\x85\xa0 é'stvred.,!0١½Ⅻ漢か한😀🇫🇷<|endoftext|>▁ﬁ\x00ſ’“"


def expected(rows: list[tuple[int | None, str | None]]) -> list[tuple]:
    out, start = [], 0
    for doc_id, text in rows:
        ids = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_query_against_the_library(spark, sf_dir, documents):
    rows = QUERIES["op4_token_output"](spark, sf_dir).collect()
    want = expected(sorted((d["doc_id"], d["text"]) for d in documents))
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows) == want


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=ALPHABET, max_size=30) | st.text(max_size=20))
def test_ids_of_any_text(text):
    assert ENCODER.ids(text).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_a_full_cache_starts_afresh():
    small = S.ByteEncoder(FILE)
    small.words.max_pieces = 50
    rng = random.Random(1)
    for _ in range(40):
        text = " ".join("".join(rng.choices("abcde.,", k=4)) for _ in range(30))
        assert small.ids(text).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 200), max_size=300), st.integers(1, 64), st.data())
def test_packing(ids, block, data):
    values = np.array(ids, dtype=np.uint32)
    segment = S.pack(values, block=block)
    assert S.unpack(segment).tolist() == ids
    first = data.draw(st.integers(0, len(ids)))
    end = data.draw(st.integers(first, len(ids)))
    assert S.unpack(segment, first, end).tolist() == ids[first:end]


@pytest.mark.parametrize("width", range(33))
def test_blocks_of_every_width(width):
    rng = np.random.default_rng(width)
    values = rng.integers(0, 1 << width, 300).astype(np.uint32)
    values[:2] = 0, (1 << width) - 1
    for size in (7, 100, 300):
        assert S.unpack(S.pack(values[:size], share=1.0, block=64)).tolist() == values[:size].tolist()


def test_outliers_do_not_widen_a_block():
    few = np.full(1024, 7, dtype=np.uint32)
    few[:20] = 2**31
    assert len(S.pack(few)) < 300


def test_odd_rows(spark, odd, nothing):
    folder = new_folder(spark, "tokens")
    S.write_tokens(odd, folder, FILE)
    rows = sorted(S.read_tokens(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted([i for i, _, _ in ODD_ROWS], key=lambda i: (i is not None, i or 0))
    assert all(zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.n_tokens for r in rows)
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:k]) for k in range(len(rows))]
    texts = {tuple([*LIBRARY.encode(t or "", add_special_tokens=False).ids, 0]) for _, t, _ in ODD_ROWS}
    assert {tuple(r.ids) for r in rows} == texts
    empty = new_folder(spark, "tokens")
    S.write_tokens(nothing, empty, FILE)
    assert S.read_tokens(spark, empty).count() == 0


@pytest.mark.parametrize("partitions", ["1", "5"])
def test_many_files_in_order(spark, partitions):
    rows = [(k, "some words " * (k % 7)) for k in range(200)]
    random.Random(2).shuffle(rows)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(partitions == "1").lower())
    try:
        folder = new_folder(spark, "tokens")
        S.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), folder, FILE)
        found = S.read_tokens(spark, folder, with_ids=False).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found) == expected(sorted(rows))
