"""Data-quality checks. Each returns the violations as rows and raises nothing."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``column, violations`` for every column, counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    named = [F.struct(F.lit(c).alias("column"), F.col(c).alias("violations")) for c in cols]
    return counts.select(F.inline(F.array(*named)))


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their ``count``.

    A single column is checked without its NULLs; in a combination NULL counts
    as a value.
    """
    if len(keys) == 1:
        df = df.where(F.col(keys[0]).isNotNull())
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1)


def check_expression(df: DataFrame, expr: str | Column) -> DataFrame:
    """Rows for which ``expr`` is false; a NULL result passes."""
    return df.where(~(F.expr(expr) if isinstance(expr, str) else expr))


def check_freshness(
    df: DataFrame,
    col: str,
    warn_days: int = 2,
    error_days: int = 7,
    now: dt.datetime | None = None,
) -> DataFrame:
    """One row: newest instant and status ``pass``, ``warn`` or ``error``; no rows is an error."""
    at = F.current_timestamp() if now is None else F.lit(now)
    newest = F.col("newest")
    status = (
        F.when(newest.isNull() | (newest < at - F.make_dt_interval(F.lit(error_days))), "error")
        .when(newest < at - F.make_dt_interval(F.lit(warn_days)), "warn")
        .otherwise("pass")
    )
    return df.agg(F.max(col).alias("newest")).withColumn("status", status)


def check_rows(
    df: DataFrame, name: str, keys: Sequence[str], not_null: Sequence[str] = (), rule: str | Column | None = None
) -> DataFrame:
    """``name, violations, status`` of a table's rules, all from one scan and one shuffle.

    The rules are those of ``check_not_null``, ``check_unique`` and ``check_expression``;
    rows are counted by key, with partial counts in the map tasks, and the counts are added up.
    """
    broken = F.lit(False) if rule is None else ~(F.expr(rule) if isinstance(rule, str) else rule)
    by_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(broken).alias("_broken"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{k}") for k, c in enumerate(not_null)],
    )
    repeated = F.col("_n") > 1
    if len(keys) == 1:
        repeated = repeated & F.col(keys[0]).isNotNull()
    nulls = sum((F.col(f"_null_{k}") for k in range(len(not_null))), F.lit(0))
    found = {"not null": F.sum(nulls), "unique": F.count_if(repeated)}
    if rule is not None:
        found["rule"] = F.sum("_broken")
    counts = by_key.agg(*[F.coalesce(c, F.lit(0)).cast("long").alias(k) for k, c in found.items()])
    named = [F.struct(F.lit(f"{name} {k}").alias("name"), F.col(f"`{k}`").alias("violations")) for k in found]
    return counts.select(F.inline(F.array(*named))).withColumn(
        "status", F.when(F.col("violations") > 0, "fail").otherwise("pass")
    )


class WriteChecks:
    """The rules of ``check_rows`` for a table that is written period by period.

    NULLs and rows that break ``rule`` are counted by the write itself, as its rows pass by; only
    uniqueness takes a scan, of the keys in the periods that were written. Periods that
    were not written keep what their own write found.
    """

    def __init__(self, name: str, keys: Sequence[str], not_null: Sequence[str] = (), rule: str | Column | None = None):
        self.name, self.keys, self.not_null, self.rule = name, list(keys), list(not_null), rule
        self._seen: Observation | None = None

    def watch(self, rows: DataFrame) -> DataFrame:
        """The same rows, counted by the action that they are written by."""
        broken = F.lit(False) if self.rule is None else ~(F.expr(self.rule) if isinstance(self.rule, str) else self.rule)
        nulls = sum((F.count_if(F.col(c).isNull()) for c in self.not_null), F.lit(0).cast("long"))
        self._seen = Observation()
        return rows.observe(self._seen, nulls.alias("nulls"), F.count_if(broken).alias("broken"))

    def found(self, written: DataFrame | None) -> list[tuple[str, int]]:
        """``(rule, violations)`` after the write; ``written`` are the periods it made, None if it made none."""
        counts = {"nulls": 0, "broken": 0} if self._seen is None else self._seen.get
        repeated = 0 if written is None else check_unique(written.select(*self.keys), self.keys).count()
        rows = [(f"{self.name} not null", counts["nulls"]), (f"{self.name} unique", repeated)]
        return rows + ([(f"{self.name} rule", counts["broken"])] if self.rule is not None else [])


def summarise(checks: dict[str, DataFrame]) -> DataFrame:
    """``name, violations, status`` for a set of violation tables, in one query."""

    def one(name: str, violations: DataFrame) -> DataFrame:
        found = F.sum("violations") if "violations" in violations.columns else F.count(F.lit(1))
        if "status" in violations.columns:
            found = F.count_if(F.col("status") == "error")
        return violations.agg(F.coalesce(found, F.lit(0)).cast("long").alias("violations")).select(
            F.lit(name).alias("name"),
            "violations",
            F.when(F.col("violations") > 0, "fail").otherwise("pass").alias("status"),
        )

    return reduce(DataFrame.unionByName, [one(name, df) for name, df in checks.items()])
