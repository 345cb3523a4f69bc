from __future__ import annotations

import random
import re

import duckdb
import pytest

from tests.llm.conftest import ODD_ROWS
from tideline.llm import license_scan as S
from tideline.llm.queries import ORACLES, QUERIES

WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def slow(text: str | None, templates=S.TEMPLATES, threshold=S.THRESHOLD) -> tuple:
    data = (text or "").encode().lower()
    words = WORDS.findall(data)
    places, base = [], set()
    for phrase, label in S.PHRASES.items():
        wanted = phrase.encode().split()
        at = [i for i in range(len(words)) if words[i : i + len(wanted)] == wanted]
        places += at
        base |= {label} if at else set()
    labels, score = set(base), 1.0 if places else 0.0
    for label, template in templates:
        wanted = WORDS.findall(template.lower().encode())
        span = 80
        while span < 2 * len(wanted):
            span *= 2
        wanted = set(wanted)
        blocks = []
        # Lines, and the words of the whole text over line breaks.
        for run in [*(WORDS.findall(line) for line in data.split(b"\n")), words]:
            n = len(run)
            blocks += [run] if n <= span else [run[k : k + span] for k in range(0, n - span // 2, span // 2)]
        best = max((len(wanted & set(b)) / len(wanted) for b in blocks), default=0)
        if best >= threshold - 1e-9:
            labels.add(label)
            score = max(score, best)
    return (
        len(words), len(places), min(places, default=None), max(places, default=None),
        ",".join(sorted(base)), ",".join(sorted(labels)), score,
    )


def found(r) -> tuple:
    return r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score


def test_query_against_every_block_and_template(spark, sf_dir, documents):
    rows = QUERIES["op5_license_scan"](spark, sf_dir).collect()
    assert {r.doc_id: found(r) for r in rows} == {d["doc_id"]: slow(d["text"]) for d in documents}


def test_words_of_any_bytes():
    assert S.words_of(bytes(range(256))) == WORDS.findall(bytes(range(256)).lower())


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.9, 1.0])
def test_parts_of_templates(spark, threshold):
    rng = random.Random(7)
    rows = []
    for k in range(150):
        words = rng.choice(S.TEMPLATES)[1].split()
        part = rng.sample(words, rng.randint(len(words) // 2, len(words)))
        filler = [f"w{rng.randint(0, 50)}" for _ in range(rng.choice([0, 5, 200]))]
        where = rng.randint(0, len(filler))
        rows.append((k, " ".join(filler[:where] + part + filler[where:]).replace(" w3 ", "\n")))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    result = {r.doc_id: found(r) for r in S.scan_licenses(docs, threshold=threshold).collect()}
    assert result == {k: slow(t, threshold=threshold) for k, t in rows}


def test_overlapping_and_broken_phrases(spark):
    rows = [(1, "CC-BY cc by, cc  by"), (2, "gnu general public"), (3, "The MIT\nLicense"), (4, "mit licenses")]
    result = {r.doc_id: found(r) for r in S.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert result == {k: slow(t) for k, t in rows} and result[1][1:4] == (3, 0, 4)


def whole_text(text: str, threshold=S.THRESHOLD) -> str:
    """The labels of ``slow``, and of templates in 80 words that follow one another over line breaks."""
    words = WORDS.findall(text.lower().encode())
    blocks = [set(words[k : k + 80]) for k in range(0, max(1, len(words) - 40), 40)]
    sets = [(label, set(WORDS.findall(t.lower().encode()))) for label, t in S.TEMPLATES]
    wrapped = {label for label, t in sets for b in blocks if len(t & b) / len(t) >= threshold - 1e-9}
    return ",".join(sorted(wrapped | {label for label in slow(text, threshold=threshold)[5].split(",") if label}))


@pytest.mark.parametrize("width", [3, 7, 12])
@pytest.mark.parametrize("mark", ["", "# ", " * "])
def test_notices_wrapped_over_lines(spark, width, mark):
    def wrapped(words):
        return "\n".join(mark + " ".join(words[k : k + width]) for k in range(0, len(words), width))

    rng = random.Random(3)
    rows, labels = [], []
    for k, (label, template) in enumerate(S.TEMPLATES):
        before, after = ([f"w{rng.randint(0, 50)}" for _ in range(rng.choice([0, 5, 39, 200]))] for _ in range(2))
        rows.append((k, wrapped([*before, *template.split(), *after])))
        labels.append(label)
    found_labels = {r.doc_id: r.labels for r in S.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found_labels == {k: whole_text(t) for k, t in rows}
    assert all(label in found_labels[k].split(",") for k, label in enumerate(labels))


def test_words_far_apart_are_no_notice(spark):
    first, second = S.TEMPLATES[3][1].split()[:11], S.TEMPLATES[3][1].split()[11:]
    text = "\n".join([" ".join(first), *["some other line"] * 40, " ".join(second)])
    (row,) = S.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert row.labels == whole_text(text) == ""


def test_odd_rows(odd, nothing):
    rows = S.scan_licenses(odd).collect()
    assert sorted(map(found, rows), key=repr) == sorted((slow(t) for _, t, _ in ODD_ROWS), key=repr)
    assert S.scan_licenses(nothing).count() == 0


@pytest.mark.parametrize("size", [30, 89, 120, 500])
@pytest.mark.parametrize("width", [7, 10**6])
def test_templates_of_any_length(spark, size, width):
    rng = random.Random(size)
    template = [f"t{rng.randint(0, 10**6)}" for _ in range(size)]
    rows = []
    for k, (lost, ahead) in enumerate([(0, 0), (0, 33), (0, 999), (size // 20, 500), (size // 4, 10)]):
        gone = set(rng.sample(range(size), lost))
        words = [f"w{rng.randint(0, 50)}" for _ in range(ahead)] + [w for i, w in enumerate(template) if i not in gone]
        words += [f"w{rng.randint(0, 50)}" for _ in range(77)]
        rows.append((k, "\n".join(" ".join(words[i : i + width]) for i in range(0, len(words), width))))
    templates = [("long", " ".join(template)), *S.TEMPLATES]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    result = {r.doc_id: found(r) for r in S.scan_licenses(docs, templates=templates).collect()}
    assert result == {k: slow(t, templates) for k, t in rows}
    assert [result[k][5] for k in range(5)] == ["long"] * 4 + [""]


def test_wrapped_notices_agree_with_the_sql(spark, tmp_path):
    rng = random.Random(11)
    rows = []
    for k in range(60):
        words = rng.choice(S.TEMPLATES)[1].split()
        words = [w for w in words if rng.random() > rng.choice([0, 0.05, 0.2])]
        before = [f"w{rng.randint(0, 50)}" for _ in range(rng.choice([0, 39, 200]))]
        words, width = before + words, rng.choice([3, 7, 500])
        rows.append((k, "\n".join(" ".join(words[i : i + width]) for i in range(0, len(words), width))))
    rows += [(60, None), (61, ""), (62, "\n\n"), (63, "one\nApache License")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    folder = str(tmp_path / "documents.parquet")
    docs.coalesce(1).write.parquet(folder)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/*.parquet'")
    names = "doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score"
    theirs = {r[0]: tuple(r[1:]) for r in db.execute(f"SELECT {names} FROM ({ORACLES['op5_license_scan']})").fetchall()}
    mine = {r.doc_id: found(r) for r in S.scan_licenses(docs).collect()}
    assert mine == theirs == {k: slow(t) for k, t in rows}
    assert sum(bool(r[5]) for r in mine.values()) > 30
