from __future__ import annotations

import public_tokenizers
import sentencepiece

import corpus_pipeline
from tideline.llm import mixing, quality, simhash_dedup, surrogates


def test_stages_against_the_operators(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    columns = docs.columns

    good = stages["quality classifier"](spark, docs, sf_dir).cache()
    accepted = {r.doc_id for r in quality.classify(docs, labels).where("predicted = 1").collect()}
    assert good.columns == columns and {r.doc_id for r in good.collect()} == accepted

    single = stages["SimHash near-dedup"](spark, good, sf_dir).cache()
    kept = {r.doc_id for r in simhash_dedup.near_duplicates(good).where("kept").collect()}
    assert single.columns == columns and {r.doc_id for r in single.collect()} == kept and single.count() == len(kept)

    clean = stages["PII surrogates"](spark, single, sf_dir).cache()
    texts = {r.doc_id: r.text for r in surrogates.replace_entities(single).collect()}
    assert clean.columns == columns and {r.doc_id: r.text for r in clean.collect()} == texts

    mixed = stages["mixing to target weights"](spark, clean, sf_dir).cache()
    copies = {r.doc_id: r.copies for r in mixing.mix(clean).collect() if r.copies}
    found = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert mixed.columns == columns and found == copies

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    encoded = stages["SentencePiece encoding"](spark, mixed, sf_dir).collect()
    want = sorted((r.doc_id, library.encode(r.text, add_bos=True, add_eos=True)) for r in mixed.collect())
    assert sorted((r.doc_id, r.ids) for r in encoded) == want

    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((r.doc_id, r.ids) for r in rows) == want


def test_last_stage_places_and_decodes_every_piece(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = dict(corpus_pipeline.STAGES)["SentencePiece encoding"](spark, docs, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        text = texts[r.doc_id]
        assert r.decoded == library.decode(r.ids) == text
        assert r.n_tokens == len(r.ids) == len(r.first_byte) == len(r.end_byte)
        assert b"".join(text.encode()[a:b] for a, b in zip(r.first_byte, r.end_byte, strict=True)) == text.encode()
        for k, a, b in zip(r.ids, r.first_byte, r.end_byte, strict=True):
            if not library.is_byte(k) and not library.is_control(k):
                shown = library.id_to_piece(k).replace("▁", " ")
                assert text.encode()[a:b].decode().replace("▁", " ") in (shown, shown[1:])
