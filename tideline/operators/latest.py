"""Latest row, or latest few rows, of every key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Parts that a key's rows are ranked in before they meet.
SALTS = 64

_RANK, _SALT = "_rank", "_salt"


def top_n_per_key(
    df: DataFrame, keys: Sequence[str], order_col: str, n: int, tie_break: Sequence[str] = ()
) -> DataFrame:
    """The ``n`` rows of each key that come last by ``order_col``.

    Equal order values are settled by ``tie_break``, largest first.  Rows are ranked
    in parts of a key first, so a key that holds much of the table is sorted in
    many tasks, and at most ``SALTS * n`` of its rows meet in one.
    """
    order = [F.col(c).desc() for c in (order_col, *tie_break)]
    # From the whole row, so that a key whose rows all have one time is parted as well.
    hashed = [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    salt = F.pmod(F.xxhash64(*hashed), F.lit(SALTS))
    in_part = Window.partitionBy(*keys, _SALT).orderBy(*order)
    newest_first = Window.partitionBy(*keys).orderBy(*order)
    parts = df.withColumn(_SALT, salt).withColumn(_RANK, F.row_number().over(in_part))
    ranked = parts.where(F.col(_RANK) <= n).withColumn(_RANK, F.row_number().over(newest_first))
    return ranked.where(F.col(_RANK) <= n).drop(_RANK, _SALT)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order_col: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """One row per key, the last by ``order_col``; rows with a NULL key are dropped.

    Spark keeps each map task's first rank only before the shuffle, so a hot key
    sends one row for each map task.
    """
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    newest_first = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in (order_col, *tie_break)])
    return df.withColumn(_RANK, F.row_number().over(newest_first)).where(F.col(_RANK) == 1).drop(_RANK)
