"""The landing job: what to ask for, and what came in, for each source."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.incremental import lagged_end, plan_requests
from tideline.operators.report import run_report, run_verdict
from tideline.plans.models import RAW_OBSERVATIONS, RAW_WEATHER
from tideline.session import discard, materialise
from tideline.sources.dimensions import locations, series_catalog
from tideline.sources.payloads import assembled_from, captured_pages, decode_weather
from tideline.sources.tables import append_rows, layer_table_name
from tideline.sources.watermarks import kept_watermarks

ECONOMIC, WEATHER = "economic", "weather"

# First day of weather asked for, and days the weather archive lags behind.
WEATHER_START = "2015-01-01"
WEATHER_LAG_DAYS = 6


@dataclass(frozen=True)
class Decoded:
    """Rows to land, the keys whose page sets are not complete, and what was written on the way."""

    rows: DataFrame
    incomplete: DataFrame | None = None
    written: DataFrame | None = None


@dataclass(frozen=True)
class RawTable:
    """One landed table: its key, how its pages decode, and which keys there are to ask for."""

    name: str
    schema: T.StructType
    key: str
    decode: Callable[[DataFrame], Decoded]
    keys: Callable[[SparkSession], DataFrame]


def _complete_series(pages: DataFrame) -> Decoded:
    """Rows of the page sets that are complete, and the series of those that are not."""
    captured = captured_pages(pages, "series_id")
    sets, rows = assembled_from(captured, "series_id")
    return Decoded(rows.drop("at"), sets.where(~F.col("complete")).select("series_id"), captured)


def _whole_pages(pages: DataFrame) -> Decoded:
    """A weather page is a whole answer."""
    return Decoded(decode_weather(pages))


RAW_TABLES = {
    ECONOMIC: RawTable("economic_observations", RAW_OBSERVATIONS, "series_id", _complete_series, series_catalog),
    WEATHER: RawTable("daily_weather", RAW_WEATHER, "location_id", _whole_pages, locations),
}


class NothingLanded(RuntimeError):
    """Keys were turned down or left incomplete, and not one row came in."""


def request_plan(
    spark: SparkSession,
    source: str,
    prefix: str = "",
    now: dt.datetime | None = None,
    start: Column | str = WEATHER_START,
    overlap_days: int = 0,
) -> DataFrame:
    """One request per key from what its raw table already holds, as its kept watermarks tell.

    A series without rows is asked for in full; a location without rows from
    ``start``, and up to the day the archive has reached.
    """
    raw = RAW_TABLES[source]
    known = kept_watermarks(spark, layer_table_name("raw", raw.name, prefix)).select(raw.key, "max_date")
    bounds = {}
    if source == WEATHER:
        bounds = {"default_start": start, "end": lagged_end(WEATHER_LAG_DAYS, now)}
    return plan_requests(raw.keys(spark), known, raw.key, overlap_days=overlap_days, **bounds)


def land_pages(
    spark: SparkSession,
    source: str,
    pages: DataFrame,
    rejected: DataFrame | None = None,
    prefix: str = "",
    batch_rows: int | None = None,
) -> DataFrame:
    """Decode captured pages, append them to the raw table, and report on every key.

    ``rejected`` holds the keys the source turned down.  Neither they nor page sets
    with a gap stop the others: a series lands whole or not at all, so its watermark
    never passes rows that are missing.  A run in which nothing landed for such
    reasons is an error, found before anything is appended.  ``batch_rows`` bounds
    the rows of a file.
    """
    raw = RAW_TABLES[source]
    decoded = raw.decode(pages)
    # Decoded once; the counts then read nothing but the key column.
    landed = materialise(decoded.rows.select(*raw.schema.fieldNames()), "landed")
    try:
        keys = raw.keys(spark).select(raw.key)
        turned_down = keys.limit(0) if rejected is None else rejected
        # One row for each key; the caller reads it.
        report = materialise(run_report(keys, landed, turned_down, raw.key, decoded.incomplete), "report")
        totals = run_verdict(report).where(F.col("verdict") == "failed").collect()
        if totals:
            total = totals[0]
            raise NothingLanded(
                f"no rows landed, {total['rejected_keys']} keys were rejected and {total['incomplete_keys']} incomplete"
            )
        append_rows(
            landed,
            layer_table_name("raw", raw.name, prefix),
            raw.schema,
            cluster=[raw.key],
            max_records_per_file=batch_rows,
            written=True,
        )
    finally:
        for used in (landed, decoded.written):
            if used is not None:
                discard(used)
    return report
