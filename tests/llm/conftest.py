from __future__ import annotations

import os

import pyarrow.dataset as ds
import pytest
from pyspark.sql import types as T

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return SF_DIR


@pytest.fixture(scope="session")
def documents() -> list[dict]:
    return ds.dataset(f"{SF_DIR}/documents.parquet").to_table().to_pylist()


LONG = " ".join(f"word{k % 977} x{k}" for k in range(60_000))

#: NULLs, blanks, ties, repeated rows and a very long text, and columns with the names that operators use inside.
ODD_ROWS = [
    (None, None, None),
    (None, "a row without an id", "s"),
    (1, None, "s"),
    (2, "", "s"),
    (3, " \t\n ", None),
    (4, "one", "t"),
    (5, "two words", "t"),
    (6, LONG, "t"),
    (7, LONG, "u"),
    (8, "A Tie In Words of some length, that stands twice under one id " * 3, "u"),
    (8, "A Tie In Words of some length, that stands twice under one id " * 3, "u"),
    (8, "another text under the same id, " * 4, "u"),
    (-9, "mail a.b@c.example.org and é😀 漢字 \u0000 <|endoftext|> <s> ▁", "s"),
]
CLASHES = ["fingerprint", "score", "size", "key", "row", "hash", "body", "copies", "runs", "component_id", "_body", "_map"]


@pytest.fixture(scope="session")
def odd_schema():
    fields = [("doc_id", T.LongType()), ("text", T.StringType()), ("source", T.StringType())]
    fields += [(c, T.StringType()) for c in CLASHES]
    return T.StructType([T.StructField(*f) for f in fields])


@pytest.fixture(scope="session")
def odd(spark, odd_schema):
    return spark.createDataFrame([(*r, *CLASHES) for r in ODD_ROWS], odd_schema)


@pytest.fixture(scope="session")
def nothing(spark, odd_schema):
    return spark.createDataFrame([], odd_schema)
