from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import sentencepiece_model_pb2

from tests.llm.conftest import ODD_ROWS
from tideline.llm import piece_encoding as S
from tideline.llm.queries import QUERIES

FILE = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=FILE)
MODEL = S.PieceModel(FILE)
TEXTS = st.text(alphabet="aeB  .,\n\t▁é漢한😀ﬁ０　\x00<s>", max_size=30) | st.text(max_size=15)


def expected(text: str | None) -> tuple:
    ids = LIBRARY.encode(text or "", add_bos=True, add_eos=True)
    digest = hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
    return len(ids), digest, hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()


def test_query_against_the_library(spark, sf_dir, documents):
    rows = QUERIES["op7_piece_encoding"](spark, sf_dir).collect()
    found = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows}
    assert found == {d["doc_id"]: expected(d["text"]) for d in documents} and len(rows) == len(documents)
    assert {r.doc_id: r.n_bytes for r in rows} == {d["doc_id"]: len((d["text"] or "").encode()) for d in documents}


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_ids_and_spans_of_any_text(text):
    ids = MODEL.ids(text)
    assert ids.tolist() == LIBRARY.encode(text, add_bos=True, add_eos=True)
    first, end = MODEL.spans(text, ids)
    assert first[0] == 0 and end[-1] == len(text.encode()) and (first[1:] == end[:-1]).all()
    for k, (a, b) in enumerate(zip(first, end, strict=True)):
        piece = LIBRARY.id_to_piece(int(ids[k]))
        if not LIBRARY.is_byte(int(ids[k])) and not LIBRARY.is_control(int(ids[k])):
            shown = piece.replace("▁", " ")
            assert text.encode()[a:b].decode().replace("▁", " ") in (shown, shown[1:])


def mapped_model() -> tuple[S.PieceModel, sentencepiece.SentencePieceNormalizer]:
    """A model's normaliser with a compiled map, without the rest of a model."""
    library = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(library.serialized_model_proto())
    model = S.PieceModel.__new__(S.PieceModel)
    model.rules, model.map, model.by_segment = proto.normalizer_spec, S.CharacterMap(proto.normalizer_spec.precompiled_charsmap), False
    return model, library


MAPPED, NORMALISER = mapped_model()


@settings(max_examples=300, deadline=None)
@given(TEXTS | st.text(alphabet="ﬁ①㍿ｶﾞa　 é̀Å​", max_size=20))
def test_longest_prefix_normalisation(text):
    found, origin = MAPPED.normalised(text.encode())
    assert found.decode() == NORMALISER.normalize(text)
    assert len(origin) == len(found) + 1 and (np.diff(origin) >= 0).all() and origin[-1] == len(text.encode())


def test_a_full_cache_starts_afresh():
    small = S.PieceModel(FILE)
    small.pieces.max_pieces = 20
    for k in range(60):
        text = " ".join(f"word{j * k % 91}" for j in range(20))
        assert small.ids(text).tolist() == LIBRARY.encode(text, add_bos=True, add_eos=True)


def test_odd_rows(odd, nothing):
    rows = S.encode_pieces(odd, FILE).collect()
    want = sorted(tuple(LIBRARY.encode(t or "", add_bos=True, add_eos=True)) for _, t, _ in ODD_ROWS)
    assert sorted(tuple(r.ids) for r in rows) == want
    assert sorted(r.decoded for r in rows) == sorted(LIBRARY.decode(list(x)) for x in want)
    assert S.encode_pieces(nothing, FILE).count() == 0


def test_query_has_the_spans_of_every_piece(spark, sf_dir, documents):
    rows = {r.doc_id: r.spans_sha256 for r in QUERIES["op7_piece_encoding"](spark, sf_dir).collect()}
    for d in documents:
        raw, first, end, at = (d["text"] or "").encode(), [], [], 0
        for k, i in enumerate(LIBRARY.encode(d["text"] or "", add_bos=True, add_eos=True)):
            shown = "" if LIBRARY.is_control(i) else LIBRARY.id_to_piece(i).replace("▁", " ")
            if k == 1:
                shown = shown.removeprefix(" ")  # the space that is put before every text
            width = 1 if LIBRARY.is_byte(i) else len(shown.encode())
            assert LIBRARY.is_byte(i) or raw[at : at + width].decode() == shown
            first.append(at)
            at += width
            end.append(at)
        assert at == len(raw)
        assert rows[d["doc_id"]] == hashlib.sha256(np.array(first + end, dtype="<u4").tobytes()).hexdigest()


def test_longest_prefix_normalisation_of_whole_documents(documents):
    for d in documents:
        text = d["text"] or ""
        found, origin = MAPPED.normalised(text.encode())
        assert found.decode() == NORMALISER.normalize(text)
        assert len(origin) == len(found) + 1 and (np.diff(origin) >= 0).all() and origin[-1] == len(text.encode())


def test_one_batch_of_long_texts_is_handed_on_in_parts(spark):
    text = "some words and é numbers 123, " * 60_000
    docs = spark.createDataFrame([(k, text) for k in range(6)], "doc_id long, text string").coalesce(1)
    rows = S.encode_pieces(docs, FILE).collect()
    want = LIBRARY.encode(text, add_bos=True, add_eos=True)
    assert sorted(r.doc_id for r in rows) == list(range(6))
    for r in rows:
        assert r.ids == want and r.decoded == text and r.n_tokens == len(r.first_byte) == len(r.end_byte)
        assert r.first_byte[0] == 0 and r.first_byte[1:] == r.end_byte[:-1] and r.end_byte[-1] == len(text.encode())
