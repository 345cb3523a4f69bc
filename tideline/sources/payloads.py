"""Captured API payloads as typed observation rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.scalars import required, sentinel_to_null
from tideline.session import materialise
from tideline.sources.dimensions import locations

# The mark for a missing value, and the most observations in a page.
MISSING_VALUE = "."
PAGE_LIMIT = 1000

# Daily variables of a weather payload and the columns they land in.
DAILY_VARIABLES = {
    "temperature_2m_max": "temperature_max_c",
    "temperature_2m_min": "temperature_min_c",
    "precipitation_sum": "precipitation_sum_mm",
    "wind_speed_10m_max": "wind_speed_max_kmh",
}

# A payload that is no JSON stops the job; absent fields are allowed.
_STRICT = {"mode": "FAILFAST"}


def decode_observations(pages: DataFrame, key: str = "series_id", sentinel: str = MISSING_VALUE) -> DataFrame:
    """One row per observation of pages ``{"observations": [{"date", "value"}, ...]}``."""
    parsed = F.from_json(
        "payload", "observations ARRAY<STRUCT<date: STRING, value: STRING>>", _STRICT
    )
    return pages.select(key, "extracted_at", F.inline(parsed["observations"])).select(
        key,
        required(F.col("date").cast("date"), "date", "date").alias("date"),
        sentinel_to_null("value", sentinel).alias("value"),
        "extracted_at",
    )


def decode_parallel_arrays(
    pages: DataFrame,
    time_field: str = "time",
    value_fields: Mapping[str, str] = DAILY_VARIABLES,
    block: str = "daily",
) -> DataFrame:
    """One row per date of pages ``{block: {time: [...], field: [...], ...}}``.

    Dates decide the rows: a shorter value array pads with NULL, a longer one is
    cut, a missing one is NULL throughout.  The other columns of ``pages`` stay.
    """
    arrays = ", ".join(f"`{f}`: ARRAY<DOUBLE>" for f in value_fields)
    schema = f"`{block}` STRUCT<`{time_field}`: ARRAY<STRING>, {arrays}>"
    others = [c for c in pages.columns if c != "payload"]
    parsed = pages.select(*others, F.from_json("payload", schema, _STRICT)[block].alias("_block"))
    dated = parsed.select(*others, "_block", F.posexplode(f"_block.{time_field}").alias("_pos", "_date"))
    values = [
        F.get(F.col(f"_block.{field}"), F.col("_pos")).alias(column)
        for field, column in value_fields.items()
    ]
    date = required(F.col("_date").cast("date"), "date", "date").alias("date")
    return dated.select(*others, date, *values)


def decode_weather(pages: DataFrame) -> DataFrame:
    """Weather rows of pages keyed by ``location_id``, with what is known of the location.

    A page of a location that is not known stops the job.
    """
    # The dimension is 20 rows kept in code, so it can go to every task.
    places = locations(pages.sparkSession).withColumnRenamed("name", "location_name")
    located = pages.join(F.broadcast(places), "location_id", "left")
    name = required(F.col("location_name"), "location_name", "string")
    return decode_parallel_arrays(located.withColumn("location_name", name))


def assemble_pages(pages: DataFrame, key: Sequence[str] | str, page_limit: int = PAGE_LIMIT) -> DataFrame:
    """Per page set: pages, rows, and whether the set is complete.

    A set is complete when its offsets run 0, limit, 2 x limit ... without a
    gap, every page before the last is full, and the last one is short.  Of a page
    captured twice the later capture counts, of equal times the larger payload in order.
    """
    key = [key] if isinstance(key, str) else list(key)
    return _sets(_captured(pages, key).drop("observations"), key, page_limit)


def assembled(
    pages: DataFrame, key: Sequence[str] | str, page_limit: int = PAGE_LIMIT, sentinel: str = MISSING_VALUE
) -> tuple[DataFrame, DataFrame]:
    """The sets as ``assemble_pages`` gives them, and the rows of the complete ones from the same parse.

    Rows have the key, ``at`` (their place in the set from 0), date, value and extracted_at.
    """
    return assembled_from(captured_pages(pages, key), key, page_limit, sentinel)


def captured_pages(pages: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """The captures that count, parsed once and written to the shared folder."""
    return materialise(_captured(pages, [key] if isinstance(key, str) else list(key)), "pages")


def assembled_from(
    captured: DataFrame, key: Sequence[str] | str, page_limit: int = PAGE_LIMIT, sentinel: str = MISSING_VALUE
) -> tuple[DataFrame, DataFrame]:
    """``assembled`` over what ``captured_pages`` gave."""
    key = [key] if isinstance(key, str) else list(key)
    sets = _sets(captured.drop("observations"), key, page_limit)
    items = captured.select(*key, "page_offset", "extracted_at", F.posexplode("observations").alias("_pos", "_item"))
    rows = items.join(sets.where("complete").select(*key), key, "left_semi").select(
        *key,
        (F.col("page_offset") + F.col("_pos")).alias("at"),
        required(F.col("_item.date").cast("date"), "date", "date").alias("date"),
        sentinel_to_null("_item.value", sentinel).alias("value"),
        "extracted_at",
    )
    return sets, rows


def _captured(pages: DataFrame, key: list[str]) -> DataFrame:
    """The capture of each page that counts, parsed, with its number of observations."""
    # Grouped by page, so a key with very many pages is not gathered in one task.
    last = pages.groupBy(*key, "page_offset").agg(
        F.max(F.struct("extracted_at", "payload")).alias("_last")
    )
    parsed = F.from_json("_last.payload", "observations ARRAY<STRUCT<date: STRING, value: STRING>>", _STRICT)
    return last.select(
        *key,
        F.col("page_offset").cast("long").alias("page_offset"),
        F.col("_last.extracted_at").alias("extracted_at"),
        F.coalesce(parsed["observations"], F.array()).alias("observations"),
    ).withColumn("size", F.array_size("observations").cast("long"))


def _sets(captured: DataFrame, key: list[str], page_limit: int) -> DataFrame:
    full = F.col("size") >= page_limit
    sets = captured.groupBy(*key).agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum("size").alias("rows"),
        F.max("page_offset").alias("_last"),
        F.count_if(F.pmod("page_offset", F.lit(page_limit)) != 0).alias("_misplaced"),
        F.count_if(~full).alias("_short"),
        F.max_by(full, "page_offset").alias("_last_full"),
    )
    contiguous = (F.col("_misplaced") == 0) & (F.col("_last") == (F.col("pages") - 1) * page_limit)
    ended = (F.col("_short") == 1) & ~F.col("_last_full")
    return sets.select(*key, "pages", "rows", (contiguous & ended).alias("complete"))
