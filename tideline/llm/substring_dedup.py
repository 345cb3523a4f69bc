"""Removal of passages that an earlier document has, by windows of doubling length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest, xxh64_intdigest

from tideline.llm.texts import each_text
from tideline.session import discard, materialise

#: Words hashed at a time, so that a long text needs little memory.
PIECE = 1 << 18
_FACTOR = 0x9E3779B97F4A7C15
_COUNT_BITS = 6
_powers: list[np.ndarray] = []


def _power_tables() -> list[np.ndarray]:
    """Powers of an odd factor and of its inverse modulo 2^64, made once in each worker."""
    if not _powers:
        for base in (_FACTOR, pow(_FACTOR, -1, 1 << 64)):
            table = np.full(PIECE + 1, base, dtype=np.uint64)
            table[0] = 1
            _powers.append(np.cumprod(table))
    return _powers


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(33))


def _prefix(words: np.ndarray) -> np.ndarray:
    out = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * _power_tables()[0][: len(words)], out=out[1:])
    return out


def _pieces(words: list[bytes], window: int) -> Iterator[tuple[int, list[bytes]]]:
    """Stretches that have every window of the text in exactly one of them."""
    step = PIECE - window + 1
    for start in range(0, max(1, len(words) - window + 1), step):
        yield start, words[start : start + PIECE]


def _anchored(words: list[bytes], window: int) -> tuple[np.ndarray, ...] | None:
    """The windows of a text, grouped by the half-length window that stands for each of them.

    Of the half-length windows inside a window the one with the smallest hash is its
    anchor, so equal windows have equal anchors wherever they stand. Returned are,
    for each run of windows with one anchor: the anchor's hash, the hash of all words
    of the run (its lowest bits hold the number of windows), the first window's start,
    and the hash of each window of the text.
    """
    half = (window + 1) // 2
    found = []
    inverse = _power_tables()[1]
    for offset, piece in _pieces(words, window):
        n = len(piece)
        if n < window:
            return None
        raw = np.frombuffer(b"".join(map(xxh3_128_digest, piece)), dtype=np.uint64).reshape(n, 2)
        prefix = _prefix(raw[:, 0])
        halves = _mixed((prefix[half:] - prefix[:-half]) * inverse[: n - half + 1])
        anchors = sliding_window_view(halves, window - half + 1).argmin(axis=1)
        anchors += np.arange(n - window + 1)
        first = np.flatnonzero(np.diff(anchors, prepend=-1))
        count = np.diff(first, append=len(anchors))
        prefix = _prefix(raw[:, 1])
        run = _mixed((prefix[first + count - 1 + window] - prefix[first]) * inverse[first])
        run = (run << np.uint64(_COUNT_BITS)) | count.astype(np.uint64)
        windows = _mixed((prefix[window:] - prefix[:-window]) * inverse[: n - window + 1])
        found.append((halves[anchors[first]], run, first + offset, windows))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _body(text: bytes) -> int:
    """A part of the text's hash, as Spark's ``xxhash64`` gives it; tells rows of one id apart."""
    return xxh64_intdigest(text, 42) & 0x7FFFFFFF


def _runs(docs: DataFrame, window: int) -> DataFrame:
    """``(anchor, run, doc_id, place)`` for every run of windows; place is the body over the first start."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list[np.ndarray]] = [[], [], [], []]
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for doc_id, text in zip(ids, each_text(batch.column("text")), strict=True):
                words = text.split()
                found = _anchored(words, window) if len(words) >= window else None
                if found is not None:
                    anchor, run, first, _ = found
                    columns[0].append(anchor.view(np.int64))
                    columns[1].append(run.view(np.int64))
                    columns[2].append(np.full(len(first), doc_id, dtype=np.int64))
                    columns[3].append((_body(text) << 32) | first.astype(np.int64))
            if columns[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in columns], ["anchor", "run", "doc_id", "place"]
                )

    return docs.mapInArrow(cut, "anchor long, run long, doc_id long, place long")


def _windows(docs: DataFrame, places: DataFrame, window: int) -> DataFrame:
    """``(anchor, run, doc_id, at, window)`` for each window of the runs that start at ``places``."""
    wanted = places.groupBy("doc_id", F.shiftright("place", 32).alias("body")).agg(
        F.collect_list(F.col("place").bitwiseAND(0xFFFFFFFF)).alias("starts")
    )
    chosen = _with_body(docs).join(wanted, ["doc_id", "body"]).select("doc_id", "text", "starts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list[np.ndarray]] = [[], [], [], [], []]
            ids = batch.column("doc_id").to_numpy()
            texts = each_text(batch.column("text"))
            for doc_id, text, starts in zip(ids, texts, batch.column("starts"), strict=True):
                anchor, run, first, hashes = _anchored(text.split(), window)
                here = np.flatnonzero(np.isin(first, starts.values.to_numpy()))
                count = (run[here] & np.uint64((1 << _COUNT_BITS) - 1)).astype(np.int64)
                at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                columns[0].append(np.repeat(anchor[here], count).view(np.int64))
                columns[1].append(np.repeat(run[here], count).view(np.int64))
                columns[2].append(np.full(len(at), doc_id, dtype=np.int64))
                columns[3].append(at)
                columns[4].append(hashes[np.repeat(first[here], count) + at].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c)) for c in columns], ["anchor", "run", "doc_id", "at", "window"]
            )

    return chosen.mapInArrow(cut, "anchor long, run long, doc_id long, at long, window long")


def _with_body(docs: DataFrame) -> DataFrame:
    body = F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND(0x7FFFFFFF)
    return docs.withColumn("body", body)


def repeated_runs(docs: DataFrame, window: int) -> DataFrame:
    """``(doc_id, body, runs)``: for each document, the runs of windows that an earlier document has.

    A run is a long, the first window's start above ``window`` bits that tell which of
    the windows from there on are repeated.

    Level 1 takes windows of half the length, and of those only the anchors, some two
    of ``window - half + 2``. Runs whose anchor stands in one document only are out. At
    level 2 the surviving runs are extended to the full length. Runs of equal words are one class with one first
    document: any later document has all its windows repeated. Single windows are
    compared only between classes that share an anchor, once for each class.
    """
    seeds = materialise(_runs(docs.where(F.col("doc_id").isNotNull()), window), "seeds")
    shared = (
        seeds.select("anchor", "doc_id").groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    )
    # Aggregates are written before they are joined, so that a join reads two shuffles and AQE can split a hot key.
    shared = materialise(shared.where("low < high").select("anchor"), "shared")
    runs = materialise(seeds.join(shared.hint("shuffle_hash"), "anchor", "left_semi"), "runs")
    discard(seeds)

    classes = materialise(
        runs.groupBy("anchor", "run").agg(F.min("doc_id").alias("first_doc"), F.min(F.struct("doc_id", "place")).alias("at")),
        "classes",
    )
    several = classes.groupBy("anchor").agg(F.min("run").alias("low"), F.max("run").alias("high"))
    several = several.where("low < high").select("anchor")
    firsts = classes.join(several, "anchor", "left_semi").select("at.doc_id", "at.place")
    windows = materialise(_windows(docs, firsts, window), "windows")
    owners = materialise(windows.groupBy("anchor", "window").agg(F.min("doc_id").alias("owner")), "owners")
    owned = (
        windows.join(owners, ["anchor", "window"])
        .where("owner < doc_id")
        .groupBy("anchor", "run")
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").cast("int"))).alias("early"))
    )
    count = F.col("run").bitwiseAND((1 << _COUNT_BITS) - 1)
    every = F.call_function("shiftleft", F.lit(1).cast("long"), count.cast("int")) - 1
    known = classes.join(owned, ["anchor", "run"], "left").select(
        "anchor", "run", "first_doc", F.coalesce("early", F.lit(0)).alias("early")
    )
    known = materialise(known, "known")
    marks = F.when(F.col("doc_id") > F.col("first_doc"), every).otherwise(F.col("early"))
    start = F.col("place").bitwiseAND(0xFFFFFFFF)
    return (
        runs.join(known, ["anchor", "run"])
        .select("doc_id", F.shiftright("place", 32).alias("body"), marks.alias("marks"), start.alias("start"))
        .where("marks <> 0")
        .groupBy("doc_id", "body")
        .agg(F.collect_list(F.struct("start", "marks")).alias("runs"))
    )


def remove_repeated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13
) -> DataFrame:
    """One row per document: ``doc_id, n_words, kept_text, spans``.

    Words are separated by ASCII white space and compared as they are. A window of
    ``window`` consecutive words (at most 63) is repeated if a document with a smaller id has it
    too; every word that a repeated window covers is removed, judged on the input.
    ``spans`` lists the removed stretches as (first word, end word) in order;
    ``kept_text`` has the other words joined by a space.

    NULL and blank texts, and texts shorter than a window, lose nothing. A document
    with a NULL id loses nothing and is earlier than none. Rows that share an id are
    judged each by its own text and are not earlier than one another. An empty table gives no rows.
    """
    if not 2 <= window <= 63:
        raise ValueError("a window has 2 to 63 words")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = repeated_runs(texts, window)
    joined = _with_body(texts).join(found, ["doc_id", "body"], "left").select("doc_id", "text", "runs")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, kept, spans = [], [], []
            for text, runs in zip(each_text(batch.column("text")), batch.column("runs"), strict=True):
                words = text.split()
                n_words.append(len(words))
                spans.append(_spans(runs, window) if runs.is_valid else [])
                end, left = 0, []
                for a, b in spans[-1]:
                    left += words[end:a]
                    end = b
                kept.append(b" ".join(left + words[end:]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n_words, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                    pa.array(spans, _SPANS),
                ],
                ["doc_id", "n_words", "kept_text", "spans"],
            )

    kind = texts.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(
        cut, f"doc_id {kind}, n_words long, kept_text string, spans array<struct<first: long, end: long>>"
    )


_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))


def _spans(runs: pa.ListScalar, window: int) -> list[tuple[int, int]]:
    """The stretches of words that the marked windows cover, in order."""
    fields = runs.values
    start, marks = fields.field("start").to_numpy(), fields.field("marks").to_numpy()
    bits = np.flatnonzero((marks[:, None] >> np.arange(63)) & 1)
    at = np.unique(start[bits // 63] + bits % 63)
    cut = np.flatnonzero(np.diff(at) > window)
    first = at[np.concatenate([[0], cut + 1])]
    last = at[np.concatenate([cut, [len(at) - 1]])]
    return list(zip(first.tolist(), (last + window).tolist(), strict=True))


def removal_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of ``remove_repeated``."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    return remove_repeated(docs, id_col, text_col, window).select(
        "doc_id", "n_words", removed.alias("n_removed"), F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )
