from __future__ import annotations

import re

from pyspark.sql import functions as F

from tests.llm.conftest import ODD_ROWS
from tideline.llm import surrogates as S
from tideline.llm.queries import QUERIES

SECRET = "for tests"
TEXT = (
    "Mr. John Smith met Mrs. Anna Smith; Mr. Smith and Dr. Jones paid 4111 1111 1111 1111, then 4111111111111111, "
    "call +1 (663) 555-6869 or 123-45-6789, GB82 WEST 1234 5698 7654 32, write X@Y.COM or x@y.com from 10.20.30.40 "
    'with token = "11acdfb36bb72224148e6160f674b4be45601bff" and г-жа Анна Петрова.'
)


def replaced(spark, texts: list[str]) -> list[str]:
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in S.replace_entities(docs, SECRET).orderBy("doc_id").collect()]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def test_kinds_formats_and_coreference(spark):
    (new,) = replaced(spark, [TEXT])
    shape = re.fullmatch(
        r"Mr\. (\w+) (\w+) met Mrs\. (\w+) (\w+); Mr\. (\w+) and Dr\. (\w+) paid (\d{4} \d{4} \d{4} \d{4}), then (\d{16}), "
        r"call (\+\d \(\d{3}\) \d{3}-\d{4}) or (9\d\d-\d\d-\d{4}), (GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d), "
        r"write ([A-Z0-9.@]+) or ([a-z0-9.@]+) from (\d+\.\d+\.\d+\.\d+) "
        r'with token = "([0-9a-f]{40})" and г-жа ([А-Я][а-я]+) ([А-Я][а-я]+)\.',
        new,
    )
    assert shape, new
    g = shape.groups()
    assert g[1] == g[3] == g[4] != g[5]
    assert g[0] in S.NAMES["given-m", "latin"] and g[2] in S.NAMES["given-f", "latin"]
    assert g[15] in S.NAMES["given-f", "cyrillic"] and g[16] in S.NAMES["family", "cyrillic"]
    assert g[6].replace(" ", "") == g[7] != "4111111111111111" and luhn(g[7])
    assert g[11].lower() == g[12] and g[12].endswith(".example")
    for old in ("John", "Smith", "Jones", "555-6869", "123-45-6789", "WEST", "x@y.com", "10.20.30.40", "11acdfb3", "Петров"):
        assert old not in new


def test_same_in_every_document_and_under_one_secret_only(spark):
    a, b = replaced(spark, ["see 10.20.30.40 now", "again 10.20.30.40"])
    assert a.split()[1] == b.split()[1] != "10.20.30.40"
    docs = spark.createDataFrame([(1, "see 10.20.30.40 now")], "doc_id long, text string")
    assert S.replace_entities(docs, "another").first().text != a


def test_surrogates_are_distinct_and_not_in_the_corpus(spark):
    names = [f"Fam{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(200)] + S.NAMES["family", "latin"]
    forms = spark.createDataFrame([("family", n) for n in names], "kind string, plain string")
    rows = S.assign_surrogates(forms, SECRET).collect()
    assert {r.plain for r in rows} == set(names) and len(rows) == len(names)
    assert len({r.form for r in rows}) == len(names) and not {r.form for r in rows} & set(names)


def test_numbers_with_marks_between_their_parts(spark):
    a, b = replaced(spark, ["call +1!! (663)!! 555-6869!! now", "call +1 (663) 555-6869 now"])
    assert [c for c in a if c.isdigit()] == [c for c in b if c.isdigit()] and "555-6869" not in a + b
    assert a.replace("!!", "") == b and a.count("!!") == 3


def test_names_without_a_form_of_address_later_on(spark):
    text = "Mr John Smith came. John Smith's car: Smith, John\nand Mrs. Ann Smith-Jones's; Ann Smith-Jones, Smithson, Ann."
    other, (new, alone) = "John Smith and Smith-Jones", replaced(spark, [text, "John Smith and Smith-Jones"])
    shape = re.fullmatch(
        r"Mr (\w+) (\w+) came\. (\w+) (\w+)'s car: (\w+), (\w+)\nand Mrs\. (\w+) (\w+)'s; (\w+) (\w+), Smithson, (\w+)\.", new
    )
    assert shape, new
    g = shape.groups()
    assert g[0] == g[2] == g[5] != "John" and g[1] == g[3] == g[4] != "Smith"
    assert g[6] == g[8] == g[10] != "Ann" and g[7] == g[9] not in ("Smith-Jones", g[1])
    assert alone == other


def test_report_counts_later_mentions(spark):
    docs = spark.createDataFrame([(1, "Dr. Jones, then Jones at 10.20.30.40")], "doc_id long, text string")
    (row,) = S.replace_entities(docs, SECRET, report="report").collect()
    assert "Jones" not in row.text and {r.kind: r.entities for r in row.report} == {"name": 2, "ip": 1}


def test_phones_with_spaces_and_of_ten_digits(spark):
    (new,) = replaced(spark, ["call 555 123 4567, 5551234567, 555 1234567 or 55512345678 and 555123456"])
    shape = re.fullmatch(r"call (\d{3} \d{3} \d{4}), (\d{10}), (\d{3} \d{7}) or 55512345678 and 555123456", new)
    assert shape, new
    assert len({x.replace(" ", "") for x in shape.groups()}) == 1 and shape[2] != "5551234567"


def test_near_misses_stay(spark):
    texts = ["version 1.2.3 of 2024-01-02, 12,345.67 and 555", "a@b is no address, Mr. x neither", "ab1.2.3.4cd 999.1.1.1", ""]
    assert replaced(spark, texts) == texts


def test_query_replaces_all_it_finds_and_nothing_else(spark, sf_dir, documents):
    rows = {r.doc_id: r for r in QUERIES["op8_personal_data"](spark, sf_dir).collect()}
    assert len(rows) == len(documents)
    found = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", F.regexp_extract_all("text", F.lit(S.PATTERN), F.lit(0)).alias("e"), F.split("text", S.PATTERN, -1).alias("p")
    )
    pairs: dict[str, set] = {}
    for r in found.collect():
        rest = rows[r.doc_id].text
        assert sum(x.entities for x in rows[r.doc_id].entities) == len(r.e)
        for k, piece in enumerate(r.p):
            assert rest.startswith(piece)
            rest = rest[len(piece) :]
            if k < len(r.e):
                after = r.p[k + 1]
                new = rest if not after and k + 1 == len(r.e) else rest[: rest.index(after)] if after else None
                assert new and new != r.e[k]
                pairs.setdefault(r.e[k], set()).add(new)
                rest = rest[len(new) :]
        assert rest == ""
    assert len(pairs) > 5 and all(len(v) == 1 for v in pairs.values())
    assert len({v for x in pairs.values() for v in x}) == len(pairs)


def test_odd_rows(odd, nothing):
    new = S.replace_entities(odd, SECRET, report="report")
    assert new.columns == [*odd.columns, "report"]
    rows = new.collect()
    old = sorted((r for r in ODD_ROWS if r[0] != -9), key=repr)
    assert sorted(((r.doc_id, r.text, r.source) for r in rows if r.doc_id != -9), key=repr) == old
    (mail,) = [r for r in rows if r.doc_id == -9]
    assert "a.b@" not in mail.text and mail.text.endswith("é😀 漢字 \u0000 <|endoftext|> <s> ▁")
    assert S.replace_entities(nothing, SECRET).count() == 0


def test_a_full_format_changes_places(spark):
    numbers = [f"+1 {k // 100} {k // 10 % 10} {k % 10}" for k in range(1000)]
    plain = [n.replace(" ", "").replace("+", "") for n in numbers]
    alone = ["+44 7 7 7 7 7"]
    forms = spark.createDataFrame([("phone", p) for p in plain] + [("phone", "4477777"), ("ip", "10.0.0.1")], "kind string, plain string")
    rows = {(r.kind, r.plain): r.form for r in S.assign_surrogates(forms, SECRET).collect()}
    assert len(rows) == len(set(rows.values())) == 1002
    changed = [rows["phone", p] for p in plain]
    assert set(changed) == set(plain) and all(a != b for a, b in zip(plain, changed, strict=True))
    assert rows["phone", "4477777"] not in plain and rows["phone", "4477777"] != "4477777"
    new = replaced(spark, [f"call {n} now" for n in numbers + alone])
    assert len(set(new)) == 1001 and all(re.fullmatch(r"call \+\d+( \d)+ now", t) for t in new)
    assert all(f"call {n} now" != t for n, t in zip(numbers, new, strict=False))


def test_a_form_that_is_alone_in_a_full_format_is_masked(spark, monkeypatch):
    monkeypatch.setattr(S, "with_surrogate", lambda forms, secret, attempt: forms.withColumn("form", F.col("plain")))
    forms = spark.createDataFrame([("ssn", "123456789"), ("ip", "1.2.3.4"), ("ip", "4.3.2.1")], "kind string, plain string")
    rows = {r.plain: r.form for r in S.assign_surrogates(forms, SECRET).collect()}
    assert rows == {"123456789": "xxxxxxxxx", "1.2.3.4": "4.3.2.1", "4.3.2.1": "1.2.3.4"}


def test_one_person_over_titles(spark):
    first, second = replaced(spark, ["Dr Anna Weber came. Later Ms Anna Weber left, then Anna.", "Prof Anna Keller, Mr Kim Weber, Ms Kim Weber"])
    shape = re.fullmatch(r"Dr (\w+) (\w+) came\. Later Ms (\w+) (\w+) left, then (\w+)\.", first)
    assert shape, first
    g = shape.groups()
    assert g[0] == g[2] == g[4] != "Anna" and g[1] == g[3] != "Weber" and g[0] in S.NAMES["given-f", "latin"]
    other = re.fullmatch(r"Prof (\w+) (\w+), Mr (\w+) (\w+), Ms (\w+) (\w+)", second)
    assert other, second
    h = other.groups()
    assert h[0] == g[0] and h[3] == h[5] == g[1] and h[2] == h[4] in S.NAMES["given-n", "latin"]


def test_scripts_are_kept(spark):
    (new,) = replaced(spark, ["Mr Γιώργος Παπαδόπουλος; Ms Անահիտ Պողոսյան; Mr Ⲡⲉⲧⲣⲟⲥ Ⲁⲛⲧⲱⲛⲓⲟⲥ."])
    shape = re.fullmatch(r"Mr (\S+) (\S+); Ms (\S+) (\S+); Mr (\S+) (\S+)\.", new)
    assert shape, new
    g = shape.groups()
    assert g[0] in S.NAMES["given-m", "greek"] and g[1] in S.NAMES["family", "greek"]
    assert g[2] in S.NAMES["given-f", "armenian"] and g[3] in S.NAMES["family", "armenian"]
    assert all(0x2C80 <= ord(c) <= 0x2CFF for c in g[4] + g[5]) and g[4] != "Ⲡⲉⲧⲣⲟⲥ"


def test_no_key_is_known_beforehand(spark):
    spark.conf.unset(S.SECRET)
    docs = spark.createDataFrame([(1, "see 10.20.30.40 now")], "doc_id long, text string")
    first, again = (S.replace_entities(docs).first().text for _ in range(2))
    spark.conf.unset(S.SECRET)
    other = S.replace_entities(docs).first().text
    assert first == again != other
    spark.conf.set(S.SECRET, SECRET)
    assert S.replace_entities(docs).first().text == S.replace_entities(docs, SECRET).first().text
    spark.conf.unset(S.SECRET)


def test_what_another_detector_finds_is_gone(spark, sf_dir, documents):
    """Emails, addresses of hosts, telephone numbers and cards as a plain reader of the texts would look for them."""
    look = [
        r"[\w.+-]+@[\w-]+\.[\w.-]*\w",
        r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\d.])",
        r"\+\d{1,2} \(\d{3}\) \d{3}-\d{4}",
        r"(?<!\d)\d{4} \d{4} \d{4} \d{4}(?!\d)",
        r"(?<!\d)\d{3}-\d{2}-\d{4}(?!\d)",
    ]
    rows = {r.doc_id: r.text for r in QUERIES["op8_personal_data"](spark, sf_dir).collect()}
    seen = 0
    for d in documents:
        for pattern in look:
            for old in re.findall(pattern, d["text"] or ""):
                seen += 1
                assert old not in rows[d["doc_id"]], (d["doc_id"], old)
    assert seen > 5
