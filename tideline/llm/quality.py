"""Quality scores: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.texts import each_text

#: Hashed n-grams fall on so many weights; a set of weights is 1 MB.
DIMENSIONS = 1 << 17
#: Labelled documents that are fitted on, at most; chosen by a hash of their ids.
MAX_EXAMPLES = 24_000
#: Shards fitted apart, whose weights are averaged.
SHARDS = 6
EPOCHS = 4
THRESHOLD = 0.7


@dataclass(frozen=True)
class Rates:
    """Of the follow-the-regularised-leader update: step sizes, and the two penalties."""

    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 0.05
    l2: float = 0.5


# Features.

_LETTERS = re.compile(r"[^\W\d_]+")
_DIGITS = re.compile(r"\d+")


def _shape(word: str) -> str:
    """The whole word's form: its letters by case, digits as one, other characters as they are."""

    if word.isalpha():
        return "AA" if len(word) > 1 and word.isupper() else "Aa" if word[0].isupper() else "a"

    def case(match: re.Match) -> str:
        found = match.group()
        if len(found) > 1 and found.isupper():
            return "AA"
        return "Aa" if found[:1].isupper() else "a"

    return _DIGITS.sub("9", _LETTERS.sub(case, word))


class _Words(dict):
    """Numbers distinct words, and has a hash of each word and of its form."""

    LIMIT = 300_000

    def __init__(self):
        super().__init__()
        self.known = np.zeros((2, 1 << 12), dtype=np.uint64)
        self.size = 0
        self.new: list[tuple[int, int]] = []

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self)
        self.new.append((crc32(word.lower()), crc32(_shape(word.decode("utf-8", "replace")).encode(), 1)))
        return place

    def arrays(self) -> np.ndarray:
        """The words' hashes and their forms' hashes, by number."""
        if self.new:
            end = self.size + len(self.new)
            if end > self.known.shape[1]:
                self.known = np.concatenate([self.known, np.zeros((2, max(end, self.known.shape[1])), dtype=np.uint64)], axis=1)
            self.known[:, self.size : end] = np.array(self.new, dtype=np.uint64).T
            self.size, self.new = end, []
        return self.known


def _place(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(64 - 17)).astype(np.int64)


def _pairs(x: np.ndarray) -> np.ndarray:
    return x[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + x[1:]


class Features:
    """The weights' places that a text's n-grams fall on, in groups, with each group's value.

    The groups are words, pairs of words, and one to three forms in a row, where a word
    that repeats the one before has a form of its own. A place counts once for each
    time it comes up, and a group's values sum to 1, so length alone says nothing.
    """

    def __init__(self):
        self.words = _Words()

    def of(self, text: bytes, piece: int = 1 << 17) -> Iterator[tuple[np.ndarray, float]]:
        """Groups of pieces of the text, in order; a piece has its share of the text's words."""
        words = text.split()
        for start in range(0, len(words), piece):
            part = words[start : start + piece]
            share = len(part) / len(words)
            for places in self._groups(part):
                if len(places):
                    yield places, share / len(places)

    def _groups(self, words: list[bytes]) -> Iterator[np.ndarray]:
        if len(self.words) > self.words.LIMIT:
            self.words = _Words()
        table = self.words
        index = np.fromiter(map(table.__getitem__, words), dtype=np.int64, count=len(words))
        hashes, forms = table.arrays()
        hashes, forms = hashes[index], forms[index]
        forms[1:][index[1:] == index[:-1]] = 7
        yield _place(hashes)
        yield _place(_pairs(hashes) + np.uint64(1))
        yield _place(forms + np.uint64(2))
        two = _pairs(forms)
        yield _place(two + np.uint64(3))
        if len(two) > 1:
            yield _place(two[:-1] * np.uint64(0x165667B19E3779F9) + forms[2:] + np.uint64(4))


# The model.


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float

    def score(self, features: Iterator[tuple[np.ndarray, float]]) -> float:
        total = self.bias
        for places, value in features:
            total += float(self.weights[places].sum()) * value
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def train_shard(
    examples: list[tuple[np.ndarray, np.ndarray, int]], rates: Rates, epochs: int, dimensions: int = DIMENSIONS
) -> np.ndarray:
    """Weights of one shard of ``(places, values, label)``; the last weight is the bias."""
    z = np.zeros(dimensions + 1)
    n = np.zeros(dimensions + 1)

    def weights(places: np.ndarray) -> np.ndarray:
        lead = z[places]
        shrunk = np.sign(lead) * rates.l1 - lead
        w = shrunk / ((rates.beta + np.sqrt(n[places])) / rates.alpha + rates.l2)
        return np.where(np.abs(lead) <= rates.l1, 0.0, w)

    for _ in range(epochs):
        for places, values, label in examples:
            w = weights(places)
            p = 1 / (1 + np.exp(-np.clip(w @ values, -30, 30)))
            g = (p - label) * values
            grown = n[places] + g * g
            z[places] += g - (np.sqrt(grown) - np.sqrt(n[places])) / rates.alpha * w
            n[places] = grown
    return weights(np.arange(dimensions + 1))


def in_fold(id_column: Column) -> Column:
    """Whether a document is held out: crc32 of its id as text leaves 2 when divided by 4."""
    remainder = F.crc32(id_column.cast("string").cast("binary")) % 4
    return F.coalesce(remainder == 2, F.lit(False))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_examples: int = MAX_EXAMPLES,
    shards: int = SHARDS,
    epochs: int = EPOCHS,
    rates: Rates | None = None,
) -> Model:
    """Fit on labelled documents that are not held out, at most ``max_examples`` of them.

    The bound holds at any size of the input: the ids with the smallest hashes are
    taken, sent to the scan of the documents, and their features go to ``shards`` tasks.
    Each is trained on its own; the weights that come back, one set from each shard, are
    averaged. Of several labels of one id the lowest counts, of several texts the first
    in order; labels that are neither 0 nor 1, NULL ids and ids without a document are left out. Without any label the model scores 0.5.
    """
    rates = rates or Rates()
    known = (
        labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~in_fold(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_examples)
    )
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    chosen = texts.join(F.broadcast(known), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Features()
        for batch in batches:
            places, values = [], []
            for text in each_text(batch.column("text")):
                sums = np.zeros(DIMENSIONS)
                for some, value in maker.of(text):
                    sums += np.bincount(some, minlength=DIMENSIONS) * value
                at = np.flatnonzero(sums)
                places.append(at.astype(np.int32))
                values.append(sums[at].astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("label"),
                    pa.array(places, pa.list_(pa.int32())),
                    pa.array(values, pa.list_(pa.float32())),
                ],
                ["doc_id", "label", "places", "values"],
            )

    def train(table: pa.Table) -> pa.Table:
        order = np.random.default_rng(0).permutation(len(table))
        sorted_rows = table.sort_by([("doc_id", "ascending"), ("label", "ascending")])
        places, values, label = (sorted_rows.column(c) for c in ("places", "values", "label"))
        examples = [
            (
                np.append(places[i].values.to_numpy(), DIMENSIONS).astype(np.int64),
                np.append(values[i].values.to_numpy(), 1.0),
                label[i].as_py(),
            )
            for i in order.tolist()
        ]
        weights = train_shard(examples, rates, epochs)
        return pa.table({"n": [len(examples)], "weights": [weights.astype(np.float32).tobytes()]})

    kind = texts.schema["doc_id"].dataType.simpleString()
    rows = (
        chosen.mapInArrow(features, f"doc_id {kind}, label int, places array<int>, values array<float>")
        .withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)))
        .groupBy("shard")
        .applyInArrow(train, "n long, weights binary")
        .collect()
    )
    total = sum(r["n"] for r in rows)
    if not total:
        return Model(np.zeros(DIMENSIONS, dtype=np.float32), 0.0)
    rows.sort(key=lambda r: bytes(r["weights"]))
    mean = sum(np.frombuffer(bytes(r["weights"]), dtype=np.float32) * (r["n"] / total) for r in rows)
    return Model(mean[:-1].astype(np.float32), float(mean[-1]))


def scored(
    docs: DataFrame, fitted: Model, text_col: str = "text", name: str = "score", keep: list[str] | None = None
) -> DataFrame:
    """The columns ``keep`` (all by default) and the score of each row's whole text, from 0 to 1.

    NULL and blank texts score by the bias alone.
    """
    keep = docs.columns if keep is None else keep
    if name in keep:
        raise ValueError(f"there is a column {name} already")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Features()
        for batch in batches:
            scores = [fitted.score(maker.of(x)) for x in each_text(batch.column(text_col))]
            yield batch.select(keep).append_column(name, pa.array(scores, pa.float64()))

    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(name, T.DoubleType())])
    return docs.mapInArrow(add, schema)


def classify(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``; see ``fit`` and ``scored``."""
    fitted = fit(docs, labels, id_col, text_col, label_col)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return scored(texts, fitted, keep=["doc_id"]).select(
        "doc_id", in_fold(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def accepted(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> DataFrame:
    """The rows of ``docs`` that score ``THRESHOLD`` or more, columns as they were."""
    name = "score"
    while name in docs.columns:
        name += "_"
    fitted = fit(docs, labels, id_col, text_col, label_col)
    return scored(docs, fitted, text_col, name).where(F.col(name) >= THRESHOLD).drop(name)
