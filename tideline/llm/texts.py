"""Columns of text batches as bytes, for functions that run inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: One word: anything between ASCII white space.
WORD = "[^\\x20\\x09-\\x0D]+"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def each_text(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each text, empty for NULL."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""
