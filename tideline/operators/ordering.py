"""Previous row and running number per key, for keys of any size.

A window sorts each key in one task, which fails where one key holds a large part
of the table. Here rows are first cut into consecutive chunks by a range shuffle on
keys and order, so a hot key lies over as many chunks as its share of the rows; the
windows run inside chunks, and the last row of each chunk, one row for each task,
carries over what the next chunk's first key needs from the chunks before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.session import materialise

CHUNK = "_chunk"


def split_groups(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], descending: bool = False
) -> DataFrame:
    """``df`` with the number of its chunk, chunks in order of keys and ``order_by``.

    They are written once because every later step has to see the same borders.
    """
    ranged = df.repartitionByRange(*[F.col(c) for c in keys], *_ordered(order_by, descending))
    return materialise(ranged.withColumn(CHUNK, F.spark_partition_id()), "chunks")


def _ordered(order_by: Sequence[str], descending: bool) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c in order_by]


def _key(keys: Sequence[str]) -> Column:
    return F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))


def _with_carry(rows: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds ``_carry`` to the rows of each chunk's first key, where ``carry (chunk, key, carry)`` has one for it."""
    renamed = carry.select(
        F.col("chunk").alias("_carry_chunk"), F.col("key").alias("_carry_key"), F.col("carry").alias("_carry")
    )
    same = (F.col(CHUNK) == F.col("_carry_chunk")) & _key(keys).eqNullSafe(F.col("_carry_key"))
    # One row for each chunk, but it may be wide, so its size decides how it is joined.
    return rows.join(renamed, same, "left").drop("_carry_chunk", "_carry_key")


def previous_row(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], values: Sequence[str], out: str = "prev"
) -> DataFrame:
    """Adds ``out``: a struct of ``values`` from the row before, NULL on a key's first row.

    ``df`` comes from ``split_groups``.
    """
    packed = F.struct(*[F.col(v) for v in values])
    in_chunk = Window.partitionBy(CHUNK, *keys).orderBy(*order_by)
    rows = df.withColumn(out, F.lag(packed).over(in_chunk))
    last = F.max_by(F.struct(_key(keys).alias("key"), packed.alias("carry")), F.struct(*keys, *order_by))
    ends = df.groupBy(CHUNK).agg(last.alias("last"))
    # Numbers only meet in one task, the values they stand for do not.
    after = df.select(CHUNK).distinct().withColumn("chunk", F.lead(CHUNK).over(Window.orderBy(CHUNK)))
    carry = ends.join(after.where(F.col("chunk").isNotNull()), CHUNK).select("chunk", "last.key", "last.carry")
    return (
        _with_carry(rows, carry, keys)
        .withColumn(out, F.coalesce(F.col(out), F.col("_carry")))
        .drop("_carry")
    )


def number_rows(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], out: str, descending: bool = False
) -> DataFrame:
    """Adds ``out``: 1, 2, 3 ... along each key's order; ``df`` comes from ``split_groups``, in that order."""
    in_chunk = Window.partitionBy(CHUNK, *keys).orderBy(*_ordered(order_by, descending))
    rows = df.withColumn(out, F.row_number().over(in_chunk).cast("long"))
    # How many rows each chunk has of its last key; a key's chunks but the last all end with it.
    sizes = df.groupBy(CHUNK, *keys).agg(F.count(F.lit(1)).alias("n"))
    ends = sizes.groupBy(CHUNK).agg(F.max(F.struct(_key(keys).alias("key"), "n")).alias("last"))
    before = ends.select(F.col(CHUNK).alias("chunk"), F.lag("last").over(Window.orderBy(CHUNK)).alias("last"))
    so_far = F.sum("last.n").over(Window.partitionBy("last.key").orderBy("chunk"))
    carry = before.where(F.col("last").isNotNull()).select("chunk", "last.key", so_far.alias("carry"))
    return (
        _with_carry(rows, carry, keys)
        .withColumn(out, F.col(out) + F.coalesce(F.col("_carry"), F.lit(0)))
        .drop("_carry")
    )
