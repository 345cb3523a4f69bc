"""Long to wide, and series of different calendars side by side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_conditional(
    df: DataFrame, by: Sequence[str] | str, name_col: str, value_col: str, mapping: Mapping[str, str]
) -> DataFrame:
    """One row per ``by``, one column per name in ``mapping`` (name to column).

    One aggregation with map-side partial results: a hot ``by`` value costs each
    map task one row in the shuffle.
    """
    by = [by] if isinstance(by, str) else list(by)
    columns = [
        F.max(F.when(F.col(name_col) == name, F.col(value_col))).alias(column)
        for name, column in mapping.items()
    ]
    return df.where(F.col(name_col).isin(*mapping)).groupBy(*by).agg(*columns)


def spine_join(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Every key of any part once, with each part left-joined onto it."""
    spine = reduce(DataFrame.unionByName, [p.select(*keys) for p in parts]).distinct()
    return reduce(lambda left, part: left.join(part, list(keys), "left"), parts, spine)


def spine_pivot(df: DataFrame, keys: Sequence[str], columns: Mapping[str, Column]) -> DataFrame:
    """``spine_join`` for parts taken from one table, in one scan and one shuffle.

    ``columns`` maps an output name to the value it takes, NULL on rows that do
    not belong to that part.  It needs each part unique by ``keys``, as a merged
    table is; keys for which every part is NULL give no row.
    """
    valued = reduce(Column.__or__, [value.isNotNull() for value in columns.values()])
    return df.where(valued).groupBy(*keys).agg(*[F.max(v).alias(name) for name, v in columns.items()])
