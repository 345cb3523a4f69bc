from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.dataset as ds
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ODD_ROWS
from tideline.llm import quality as S
from tideline.llm.queries import QUERIES


def remainder(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % 4


def test_query_on_the_fold_held_out(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = QUERIES["op9_quality_classifier"](spark, sf_dir).collect()
    labels = {r["doc_id"]: r["quality"] for r in ds.dataset(f"{sf_dir}/labels.parquet").to_table().to_pylist()}
    assert len(rows) == ds.dataset(f"{sf_dir}/documents.parquet").count_rows()
    assert all(r.held_out == (remainder(r.doc_id) == 2) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == (r.score >= 0.7) for r in rows)
    held = [(r.score, r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [[s for s, _, q in held if q == want] for want in (1, 0)]
    assert np.mean([p == q for _, p, q in held]) > 0.95
    assert np.mean(np.array(good)[:, None] > np.array(bad)[None, :]) > 0.98


def test_labels_held_out_are_not_learnt(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    turned = labels.withColumn("quality", F.when(S.in_fold(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = S.fit(docs, labels), S.fit(docs, turned)
    assert (one.weights == two.weights).all() and one.bias == two.bias


def test_bound_on_examples(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    few = S.fit(docs, labels, max_examples=10, shards=1)
    assert 0 < np.count_nonzero(few.weights) < np.count_nonzero(S.fit(docs, labels, shards=1).weights)


def test_one_step_of_the_update():
    rates = S.Rates(alpha=1.0, beta=1.0, l1=0.1, l2=0.0)
    places, values = np.array([0, 2]), np.array([1.0, 0.5])
    weights = S.train_shard([(places, values, 1)], rates, 1, dimensions=3)
    # From weights of 0, p is 1/2, so the gradients are -0.5 and -0.25.
    assert weights == pytest.approx([0.4 / 1.5, 0, 0.15 / 1.25, 0])


def slow_form(word: str) -> str:
    """The form by one walk over the characters."""
    out, at = "", 0
    while at < len(word):
        end = at + 1
        if word[at].isdigit():
            while end < len(word) and word[end].isdigit():
                end += 1
            out += "9"
        elif word[at].isalpha():
            while end < len(word) and word[end].isalpha():
                end += 1
            run = word[at:end]
            out += "AA" if len(run) > 1 and run.isupper() else "Aa" if run[0].isupper() else "a"
        else:
            out += word[at]
        at = end
    return out


def slow_features(text: str) -> Counter:
    """Places and values of one text, n-gram by n-gram."""
    top = 1 << 64

    def place(x: int) -> int:
        return ((x ^ (x >> 31)) * 0x9E3779B97F4A7C15 % top) >> 47

    def pair(x: int, y: int) -> int:
        return (x * 0xC2B2AE3D27D4EB4F + y) % top

    words = (text or "").encode().split()
    names = [zlib.crc32(w.lower()) for w in words]
    forms = [zlib.crc32(slow_form(w.decode()).encode(), 1) for w in words]
    forms = [7 if k and words[k] == words[k - 1] else f for k, f in enumerate(forms)]
    two = [pair(a, b) for a, b in zip(forms, forms[1:])]
    groups = [
        [place(x) for x in names],
        [place((pair(a, b) + 1) % top) for a, b in zip(names, names[1:])],
        [place(x + 2) for x in forms],
        [place((x + 3) % top) for x in two],
        [place((x * 0x165667B19E3779F9 + f + 4) % top) for x, f in zip(two, forms[2:])],
    ]
    sums: Counter = Counter()
    for group in groups:
        for x in group:
            sums[x] += 1 / len(group)
    return sums


def slow_shard(examples: list[tuple[Counter, int]], rates: S.Rates, epochs: int) -> dict[int, float]:
    """The update, one weight after another."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(k: int) -> float:
        if abs(z[k]) <= rates.l1:
            return 0.0
        return (math.copysign(rates.l1, z[k]) - z[k]) / ((rates.beta + math.sqrt(n[k])) / rates.alpha + rates.l2)

    for _ in range(epochs):
        for sums, label in examples:
            w = {k: weight(k) for k in sums}
            p = 1 / (1 + math.exp(-sum(w[k] * x for k, x in sums.items())))
            for k, x in sums.items():
                g = (p - label) * x
                step = (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / rates.alpha
                z[k] += g - step * w[k]
                n[k] += g * g
    return {k: weight(k) for k in list(z)}


def test_scores_against_a_model_fitted_step_by_step(spark, sf_dir, documents):
    labels = {r["doc_id"]: r["quality"] for r in ds.dataset(f"{sf_dir}/labels.parquet").to_table().to_pylist()}
    texts = {d["doc_id"]: d["text"] for d in documents}
    ids = spark.createDataFrame([(i,) for i in sorted(set(labels) & set(texts))], "doc_id long")
    shard_of = ids.selectExpr("doc_id", f"pmod(xxhash64(doc_id), {S.SHARDS}) as shard").collect()
    features = {i: slow_features(t) for i, t in texts.items()}
    shards = defaultdict(list)
    for r in sorted(shard_of):
        if remainder(r.doc_id) != 2 and labels[r.doc_id] in (0, 1):
            shards[r.shard].append(r.doc_id)
    mean: Counter = Counter()
    total = sum(map(len, shards.values()))
    for members in shards.values():
        order = np.random.default_rng(0).permutation(len(members)).tolist()
        examples = [(features[members[k]] + Counter({S.DIMENSIONS: 1.0}), labels[members[k]]) for k in order]
        for k, w in slow_shard(examples, S.Rates(), S.EPOCHS).items():
            mean[k] += w * len(members) / total
    rows = QUERIES["op9_quality_classifier"](spark, sf_dir).collect()
    assert len(rows) == len(documents)
    for r in rows:
        lead = mean[S.DIMENSIONS] + sum(mean[k] * x for k, x in features[r.doc_id].items())
        assert r.score == pytest.approx(1 / (1 + math.exp(-lead)), abs=1e-4)


def test_forms_are_of_whole_words():
    words = ["abc", "Abc", "ABC", "A", "a1b22", "Éa!", "x" * 200, "1.2.3.4.5.6.7.8.9", "ab-" * 40 + "C", "漢字", "_x_"]
    assert [S._shape(w) for w in words] == [slow_form(w) for w in words]
    assert S._shape("a." * 50 + "b") != S._shape("a." * 50 + "9")


def test_a_long_text_is_scored_whole():
    maker = S.Features()
    words = [b"a"] * 100 + [b"zzz!!"] * 100
    model = S.Model(np.zeros(S.DIMENSIONS, dtype=np.float32), 0.0)
    model.weights[next(iter(S.Features().of(b"zzz!!")))[0]] = 1.0
    whole = model.score(maker.of(b" ".join(words)))
    assert whole == pytest.approx(model.score(maker.of(b" ".join(words), piece=50)), abs=0.02) and whole > 0.6


def test_odd_rows(spark, odd, odd_schema, nothing):
    labels = spark.createDataFrame([(4, 1), (4, 0), (6, 1), (8, 0), (None, 1), (99, 1), (7, None), (5, 3)], "doc_id long, quality int")
    rows = S.classify(odd, labels).collect()
    assert len(rows) == len(ODD_ROWS)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert not any(r.held_out for r in rows if r.doc_id is None)
    kept = S.accepted(odd, labels)
    assert kept.columns == odd.columns
    assert S.classify(nothing, labels).count() == 0
    empty = labels.where("false")
    assert {r.score for r in S.classify(odd, empty).collect()} == {0.5}
