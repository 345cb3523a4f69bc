"""High-water marks, trailing-window reads and upserts into partitioned tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.scalars import days_before, required, utc, years_before
from tideline.operators.checks import WriteChecks, check_unique
from tideline.session import discard, materialise
from tideline.sources.tables import PERIOD_COLUMNS, partition_column, replace_periods, settle_periods, table_periods
from tideline.sources.watermarks import begin_append, end_append, kept_columns, kept_watermarks

# Earlier than any date kept, so it lets every row through.
BEGINNING = "0001-01-01"


def watermarks(df: DataFrame, keys: Sequence[str] | str, date_col: str) -> DataFrame:
    """Newest date per key, as ``max_date``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.max(date_col).alias("max_date"))


def plan_requests(
    keys_df: DataFrame,
    watermarks_df: DataFrame,
    key: str,
    default_start: Column | str | None = None,
    end: Column | str | None = None,
    overlap_days: int = 0,
) -> DataFrame:
    """One request per key: ``start_date`` to ``end_date``, keys with nothing to ask left out.

    A key starts at its own watermark, so the newest date is fetched again, or
    ``overlap_days`` earlier to see older revisions too.  A key without a
    watermark starts at ``default_start``; NULL stands for all there is.
    """

    def day(value: Column | str | None) -> Column:
        return (value if isinstance(value, Column) else F.lit(value)).cast("date")

    start = F.coalesce(days_before("max_date", overlap_days), day(default_start))
    plan = (
        keys_df.join(watermarks_df, key, "left")
        .withColumn("start_date", start)
        .withColumn("end_date", day(end))
        .drop("max_date")
    )
    return plan.where(F.coalesce(F.col("start_date") <= F.col("end_date"), F.lit(True)))


def lagged_end(days: int, now: dt.datetime | None = None) -> Column:
    """Today in UTC less the days the archive lags behind."""
    at = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    return days_before(F.to_date(utc(at)), days)


def newest_date(df: DataFrame, date_col: str) -> DataFrame:
    """One row with the newest date as ``max_date``, NULL on an empty table.

    On a table partitioned by period only the newest period's files are read.
    """
    period_col = partition_column(df)
    if period_col:
        df = df.where(F.col(period_col) == df.agg(F.max(period_col)).scalar())
    return df.agg(F.max(date_col).alias("max_date"))


def newest_stored_date(spark: SparkSession, table: str, date_col: str) -> dt.date | None:
    """The newest date of a named table partitioned by period, None if it is empty.

    The catalogue tells the periods, so no file of any but the newest one that has rows is opened.
    """
    rows = spark.table(table)
    period_col = partition_column(rows)
    for period in reversed(table_periods(spark, table)):
        newest = rows.where(F.col(period_col) == F.lit(period)).agg(F.max(date_col)).first()[0]
        if newest is not None:
            return newest
    return None


def incremental_tail(
    source: DataFrame,
    target: DataFrame | str | None,
    date_col: str = "date",
    days: int | None = None,
    years: int | None = None,
    scope: str = "global",
    keys: Sequence[str] | None = None,
    source_keys: DataFrame | None = None,
) -> DataFrame:
    """The rows of ``source`` from a trailing window before the target's newest date on.

    ``scope="global"`` measures from the newest date of the whole target, so a
    series far behind the others is passed over; ``scope="per_key"`` measures
    from each key's own newest date.  No target, an empty target, or a key the
    target does not know loads in full.  A target may be given by the name of a
    partitioned table: then the catalogue tells which period is the newest, and kept
    watermarks, if the table has them, which dates its keys have.

    With ``per_key``, a source partitioned by period is read from the smallest start of any of its keys
    on, in full if one of them has no watermark. ``source_keys`` names its keys,
    all of them, where they are known; otherwise they are found by a scan of their columns.
    """
    if target is None:
        return source
    spark = source.sparkSession
    if (days is None) == (years is None):
        raise ValueError("give either days or years")

    def cutoff(newest: Column) -> Column:
        return days_before(newest, days) if years is None else years_before(newest, years)

    if scope == "global":
        if isinstance(target, str):
            newest = newest_stored_date(spark, target, date_col)
            return source if newest is None else _from(source, date_col, cutoff(F.lit(newest)))
        beginning = F.lit(BEGINNING).cast("date")
        start = newest_date(target, date_col).select(F.coalesce(cutoff(F.col("max_date")), beginning))
        return _from(source, date_col, start.scalar())
    if scope == "per_key":
        if not keys:
            raise ValueError("scope per_key needs keys")
        starts = _newest_by_key(spark, target, list(keys), date_col).withColumn("_start", cutoff(F.col("max_date")))
        starts = starts.select(*keys, "_start")
        if partition_column(source):
            known = source.select(*keys).distinct() if source_keys is None else source_keys.select(*keys)
            beginning = F.lit(BEGINNING).cast("date")
            first = known.join(starts, list(keys), "left").agg(F.min(F.coalesce("_start", beginning)))
            source = _from(source, date_col, first.scalar())
        return (
            source.join(starts, list(keys), "left")
            .where(F.col("_start").isNull() | (F.col(date_col) >= F.col("_start")))
            .drop("_start")
        )
    raise ValueError(f"unknown scope {scope!r}")


def _newest_by_key(spark: SparkSession, target: DataFrame | str, keys: list[str], date_col: str) -> DataFrame:
    if isinstance(target, str):
        if (kept_columns(spark, target) or ([], ""))[:2] == (keys, date_col):
            return kept_watermarks(spark, target)
        target = spark.table(target)
    return watermarks(target, keys, date_col)


def _from(source: DataFrame, date_col: str, start: Column) -> DataFrame:
    """The rows from a date on."""
    period_col = partition_column(source)
    if period_col:
        # Said on the partition column as well, so older files are not listed or read.
        source = source.where(F.col(period_col) >= F.trunc(start, PERIOD_COLUMNS[period_col]))
    return source.where(F.col(date_col) >= start)


def merged_view(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target after an upsert: source rows replace or join target rows, none are deleted."""
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(source.select(*target.columns))


def with_load_time(df: DataFrame, now: dt.datetime | None = None) -> DataFrame:
    return df.withColumn("_loaded_at", F.current_timestamp() if now is None else F.lit(now).cast("timestamp"))


def merge_upsert(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    keys: Sequence[str],
    date_col: str = "date",
    cluster: Sequence[str] = (),
    unique_source: bool = False,
    checks: WriteChecks | None = None,
) -> list[dt.date]:
    """Upsert ``source`` into a partitioned table and return the periods rewritten.

    Matched keys are overwritten whole, others inserted, none deleted.  Several
    source rows for one key are an error, checked before anything is written;
    ``unique_source`` skips that for a source whose plan already ensures it.
    ``date_col`` is one of the keys, so a key never moves to another period and
    only the periods found in the source are read and rewritten.  ``checks`` counts
    broken rules in the rows as they are written.

    New periods are written beside the old ones, then the catalogue is pointed at
    them, and the old files go last: a reader sees each period whole, old or new. A
    write that fails leaves the table as it was; one that was finished and not pointed at is
    taken up first by the next merge.  Two writers must not merge into one table at a time.
    """
    if date_col not in keys:
        raise ValueError("the partitioning date must be one of the keys")
    settle_periods(spark, table)
    target = spark.table(table)
    period_col = partition_column(target)
    period = PERIOD_COLUMNS[period_col]
    columns = [c for c in target.columns if c != period_col]
    date = required(F.col(date_col), date_col, "date")
    staged = source.select(*columns).withColumn(period_col, F.trunc(date, period))

    # Worked out once: the checks below read only its key and period columns.
    staged = materialise(staged, "tail")
    try:
        if not unique_source and not check_unique(staged, keys).isEmpty():
            raise ValueError(f"several source rows for one key of {table}")
        # As many values as the calendar has periods, never as many as there are keys.
        periods = sorted(r[0] for r in staged.select(period_col).distinct().collect())
        if periods:
            touched = target.where(F.col(period_col).isin(periods))
            rows = merged_view(touched, staged, keys)
            mark = begin_append(spark, table)
            replace_periods(rows if checks is None else checks.watch(rows), table, periods, cluster)
            end_append(staged, table, mark)
    finally:
        discard(staged)
    return periods
