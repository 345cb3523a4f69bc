"""Licence notices in documents: fixed phrases, and an exact set-similarity join with notice templates."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.texts import each_text
from tideline.session import materialise

# Phrases whose words stand one after another, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Opening sentences of public licence notices and whole short licences, and their labels.
TEMPLATES = [
    ("agpl", "licensed under the GNU Affero General Public License as published by the Free Software Foundation"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc0", "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "Released under the MIT License"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        'shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY '
        "OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
        "THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "
        '"AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
        "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
        "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
        "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]

#: The share of a template's distinct words that a block must have.
THRESHOLD = 0.9
#: A block is a line, and each stretch of so many words of a longer line or of the whole text, half a stretch apart.
#: Templates of more than half as many words have longer blocks, in steps of two.
BLOCK_WORDS = 80

_WORD_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Stretches of digits, letters and all that is not ASCII, A-Z in lower case."""
    return text.translate(_WORD_BYTES).split()


def span_of(template: str) -> int:
    """How many words the blocks have that a template is looked for in: at least twice its own, so one block has all of it."""
    span, size = BLOCK_WORDS, len(words_of(template.encode()))
    while span < 2 * size:
        span *= 2
    return span


def _stretches(words: list[bytes], span: int) -> Iterator[list[bytes]]:
    step = span // 2
    for start in range(0, max(1, len(words) - step), step):
        yield words[start : start + span]


def _blocks(text: bytes, words: list[bytes], span: int) -> Iterator[list[bytes]]:
    """The lines of a text, and its ``words`` across line breaks, as notices are wrapped."""
    lines = text.split(b"\n")
    for line in lines:
        of_line = words_of(line)
        yield from [of_line] if len(of_line) <= span else _stretches(of_line, span)
    if len(lines) > 1:
        yield from _stretches(words, span)


def _places(words: list[bytes], phrase: bytes) -> list[int]:
    """The numbers of the words at which ``phrase`` starts."""
    first, *rest = phrase.split()
    found, at = [], -1
    while True:
        try:
            at = words.index(first, at + 1)
        except ValueError:
            return found
        if words[at + 1 : at + 1 + len(rest)] == rest:
            found.append(at)


def word_counts(docs: DataFrame, text_col: str, vocabulary: set[bytes]) -> dict[bytes, int]:
    """How often each word of a fixed ``vocabulary`` stands in the corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for text in each_text(batch.column(0)):
                total.update(filter(vocabulary.__contains__, words_of(text)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], ["word", "n"]
        )

    rows = docs.select(text_col).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {bytes(r["word"]): r["n"] for r in rows}


def _ranked(docs: DataFrame, text_col: str, templates: list[tuple[str, str]]) -> tuple[dict[bytes, int], list[tuple]]:
    """The rank of each template word, rarest in the corpus first, and the templates with their words by rank."""
    sets = [(label, set(words_of(text.encode()))) for label, text in templates]
    vocabulary = set().union(*(words for _, words in sets))
    counts = word_counts(docs, text_col, vocabulary)
    rank = {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
    return rank, [(label, sorted(rank[w] for w in words)) for label, words in sets]


def _needed(size: int, threshold: float) -> int:
    return max(1, ceil(threshold * size - 1e-9))


def _prefixes(spark: SparkSession, ranked: list[tuple], spans: list[int], threshold: float) -> DataFrame:
    """A row for each word of a template's prefix: a block without any of them shares too few words."""
    rows = []
    for number, ((label, ranks), span) in enumerate(zip(ranked, spans, strict=True)):
        need = _needed(len(ranks), threshold)
        for place, rank in enumerate(ranks[: len(ranks) - need + 1]):
            rows.append((rank, span, place, number, label, ranks, len(ranks), need))
    return spark.createDataFrame(
        rows, "rank int, span int, t_place int, template int, label string, t_ranks array<int>, t_size int, need int"
    )


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: list[tuple[str, str]] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, notices``.

    ``n_base`` counts the places of ``PHRASES``; first and last are the smallest and
    largest word they start at, NULL if there are none. ``notices`` lists the templates found as
    (label, containment): each whose distinct words are in one block of the text to
    ``threshold`` or more. Blocks are lines, and stretches of ``BLOCK_WORDS`` words that run over line breaks, of more
    for longer templates, so that a template of any length is found wherever it stands whole. ``labels`` has the phrases' labels and the templates'. ``score`` is 1 where a phrase stands,
    else the largest containment found, else 0.

    The join is exact. Words are ordered by how often the corpus has them. A block and a
    template that share enough words share one of the template's rarest few; those are
    joined, pairs too short or met too late to share enough are dropped, and the rest are counted.

    NULL and blank texts have no words and no labels; repeated rows and NULL ids give a
    row each; an empty table gives none.
    """
    spark = docs.sparkSession
    listed = [(label, text) for label, text in (TEMPLATES if templates is None else templates) if words_of(text.encode())]
    rank, ranked = _ranked(docs, text_col, listed)
    spans = [span_of(text) for _, text in listed]
    word_at = {k: w for w, k in rank.items()}
    least: dict[int, int] = {}
    starters: dict[int, set[bytes]] = {}
    for (_, ranks), span in zip(ranked, spans, strict=True):
        need = _needed(len(ranks), threshold)
        least[span] = min(least.get(span, need), need)
        starters.setdefault(span, set()).update(word_at[k] for k in ranks[: len(ranks) - need + 1])
    phrases = {p.encode(): label for p, label in PHRASES.items()}
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            columns: dict[str, list] = {name: [] for name in ("row", "n_words", "places", "base", "blocks", "spans")}
            for text in each_text(batch.column("text")):
                words = words_of(text)
                places, base, blocks, of_blocks = [], [], [], []
                for phrase, label in phrases.items():
                    if found := _places(words, phrase):
                        places += found
                        base.append(label)
                for span, rare in starters.items():
                    if rare.isdisjoint(words):
                        continue
                    for block in _blocks(text, words, span):
                        ranks = sorted({rank[w] for w in block if w in rank})
                        if len(ranks) >= least[span] and not rare.isdisjoint(block):
                            blocks.append(ranks)
                            of_blocks.append(span)
                for name, value in zip(columns, (row, len(words), places, sorted(base), blocks, of_blocks), strict=True):
                    columns[name].append(value)
                row += 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(columns["row"], pa.int64()),
                    pa.array(columns["n_words"], pa.int64()),
                    pa.array(columns["places"], pa.list_(pa.int64())),
                    pa.array(columns["base"], pa.list_(pa.string())),
                    pa.array(columns["blocks"], pa.list_(pa.list_(pa.int32()))),
                    pa.array(columns["spans"], pa.list_(pa.int32())),
                ],
                ["doc_id", *columns],
            )

    kind = texts.schema["doc_id"].dataType.simpleString()
    scanned = materialise(
        texts.mapInArrow(
            scan,
            f"doc_id {kind}, row long, n_words long, places array<long>, base array<string>, "
            "blocks array<array<int>>, spans array<int>",
        ),
        "licenses",
    )
    zipped = F.zip_with("blocks", "spans", lambda b, s: F.struct(b.alias("ranks"), s.alias("span")))
    blocks = scanned.where(F.size("blocks") > 0).select("row", F.inline(zipped)).distinct()
    probes = blocks.select("row", "span", "ranks", F.size("ranks").alias("size"), F.posexplode("ranks").alias("place", "rank"))
    left = F.least(F.col("t_size") - F.col("t_place"), F.col("size") - F.col("place"))
    pairs = (
        probes.join(F.broadcast(_prefixes(spark, ranked, spans, threshold)), ["rank", "span"])
        .where((F.col("size") >= F.col("need")) & (left >= F.col("need")))
        .select("row", "ranks", "template", "label", "t_ranks", "t_size", "need")
        .distinct()
    )
    shared = F.size(F.array_intersect("ranks", "t_ranks"))
    notices = (
        pairs.where(shared >= F.col("need"))
        .groupBy("row", "label")
        .agg(F.max(shared / F.col("t_size")).alias("containment"))
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("label", "containment"))).alias("notices"))
    )
    labels = F.array_sort(F.array_union("base", F.coalesce(F.col("notices.label"), F.array().cast("array<string>"))))
    return scanned.join(notices, "row", "left").select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").alias("first_word"),
        F.array_max("places").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max("notices.containment"), F.lit(0.0))).alias("score"),
        "notices",
    )
