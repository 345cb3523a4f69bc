from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import SparkSession

from tideline.session import build_session


def local_session() -> SparkSession:
    spark = build_session(
        "tideline-tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="tideline-tests-"),
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="tideline-tests-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    yield session
    session.stop()
