"""The test tables seen as the tables the operators work on, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.sources.dimensions import (
    HOUSE_PRICE_ID,
    LOCATIONS,
    NATIONAL_SERIES,
    STATE_FIPS,
    WEEKLY_WAGE_ID,
)
from tideline.workload.catalogue import read

SERIES_IDS = [*NATIONAL_SERIES] + [t % f for t in (HOUSE_PRICE_ID, WEEKLY_WAGE_ID) for f in STATE_FIPS]


# Orders of every third customer go to the next one, so that some customers have none.

def other_customer() -> Column:
    key = F.col("o_custkey")
    return F.when(F.pmod(key, F.lit(3)) == 0, key + 1).otherwise(key)


OTHER_CUSTOMER = "(CASE WHEN o_custkey % 3 = 0 THEN o_custkey + 1 ELSE o_custkey END)"


# Events as observations: one series per user and event type, revised within the day.

def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(
        "user_id",
        "event_type",
        F.to_date("ts").alias("date"),
        "value",
        F.col("ts").alias("extracted_at"),
        "event_id",
    )


OBSERVATIONS = (
    "obs AS (SELECT user_id, event_type, CAST(ts AS DATE) AS date, value, ts AS extracted_at, event_id "
    "FROM events)"
)
LATEST_OBSERVATIONS = (
    OBSERVATIONS + ", latest AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER ("
    "PARTITION BY user_id, event_type, date ORDER BY extracted_at DESC, event_id DESC) AS rn FROM obs) "
    "WHERE rn = 1)"
)


# Line items as raw economic observations: parts spread over the 118 series.

def raw_observations(spark: SparkSession, sf_dir: str, *more: Column) -> DataFrame:
    ids = F.array(*[F.lit(s) for s in SERIES_IDS])
    return read(spark, sf_dir, "lineitem").select(
        F.get(ids, F.pmod("l_partkey", F.lit(len(SERIES_IDS))).cast("int")).alias("series_id"),
        F.to_date("l_shipdate").alias("date"),
        F.when(F.col("l_discount") > 0, F.col("l_extendedprice")).alias("value"),
        (F.col("l_shipdate") + F.make_dt_interval(days=F.col("l_linenumber"))).alias("extracted_at"),
        *more,
    )


def listed(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


RAW_OBSERVATIONS = (
    f"raw_obs AS (SELECT {listed(SERIES_IDS)}[1 + l_partkey % {len(SERIES_IDS)}] AS series_id, "
    "CAST(l_shipdate AS DATE) AS date, CASE WHEN l_discount > 0 THEN l_extendedprice END AS value, "
    "l_shipdate + to_days(CAST(l_linenumber AS INTEGER)) AS extracted_at FROM lineitem)"
)


RAW_OBSERVATIONS_WITH_LINE = (
    f"raw_lines AS (SELECT {listed(SERIES_IDS)}[1 + l_partkey % {len(SERIES_IDS)}] AS series_id, "
    "CAST(l_shipdate AS DATE) AS date, CASE WHEN l_discount > 0 THEN l_extendedprice END AS value, l_linenumber "
    "FROM lineitem)"
)


def ranked_first(source: str, keys: str, order: str, where: str = "true") -> str:
    """SQL for the first row of each key."""
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) "
        f"AS rn FROM {source} WHERE {where}) WHERE rn = 1"
    )


OBSERVATION_ORDER = "extracted_at DESC, value DESC NULLS LAST"
STAGED_OBSERVATIONS = (
    RAW_OBSERVATIONS + ", staged AS (" + ranked_first("raw_obs", "series_id, date", OBSERVATION_ORDER) + ")"
)


# Orders as raw daily weather: customers spread over the 20 locations.

def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    def place(position: int) -> Column:
        values = F.array(*[F.lit(row[position]) for row in LOCATIONS])
        return F.get(values, F.pmod("o_custkey", F.lit(len(LOCATIONS))).cast("int"))

    price = F.col("o_totalprice")
    return read(spark, sf_dir, "orders").select(
        place(0).alias("location_id"),
        place(1).alias("location_name"),
        place(2).alias("country"),
        place(3).alias("latitude"),
        place(4).alias("longitude"),
        F.to_date("o_orderdate").alias("date"),
        (price / 1000).alias("temperature_max_c"),
        F.when(F.col("o_orderstatus") != "P", price / 2000).alias("temperature_min_c"),
        F.pmod("o_orderkey", F.lit(50)).cast("double").alias("precipitation_sum_mm"),
        F.pmod("o_custkey", F.lit(90)).cast("double").alias("wind_speed_max_kmh"),
        (F.col("o_orderdate") + F.make_dt_interval(days=F.pmod("o_orderkey", F.lit(7)).cast("int"))).alias(
            "extracted_at"
        ),
    )


def _place_sql(position: int) -> str:
    values = [row[position] for row in LOCATIONS]
    places = listed(values) if isinstance(values[0], str) else "[" + ", ".join(
        f"CAST({v} AS DOUBLE)" for v in values
    ) + "]"
    return f"{places}[1 + o_custkey % {len(LOCATIONS)}]"


RAW_WEATHER = (
    f"raw_weather AS (SELECT {_place_sql(0)} AS location_id, {_place_sql(1)} AS location_name, "
    f"{_place_sql(2)} AS country, {_place_sql(3)} AS latitude, {_place_sql(4)} AS longitude, "
    "CAST(o_orderdate AS DATE) AS date, o_totalprice / 1000 AS temperature_max_c, "
    "CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 2000 END AS temperature_min_c, "
    "CAST(o_orderkey % 50 AS DOUBLE) AS precipitation_sum_mm, "
    "CAST(o_custkey % 90 AS DOUBLE) AS wind_speed_max_kmh, "
    "o_orderdate + to_days(CAST(o_orderkey % 7 AS INTEGER)) AS extracted_at FROM orders)"
)
WEATHER_ORDER = (
    "extracted_at DESC, location_name DESC, country DESC, latitude DESC, longitude DESC, "
    "temperature_max_c DESC NULLS LAST, temperature_min_c DESC NULLS LAST, "
    "precipitation_sum_mm DESC, wind_speed_max_kmh DESC"
)
STAGED_WEATHER = (
    RAW_WEATHER + ", staged AS (" + ranked_first("raw_weather", "location_id, date", WEATHER_ORDER) + ")"
)


# Conversations as versioned documents: one name per conversation and role, one load per turn.

def loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "conversations").select(
        F.concat_ws("/", F.col("conv_id").cast("string"), "role").alias("name"),
        "turn",
        "text",
        F.pmod(F.length("text"), F.lit(2)).cast("string").alias("parity"),
    )


LOADS = (
    "loads AS (SELECT CAST(conv_id AS VARCHAR) || '/' || role AS name, turn, text, "
    "CAST(length(text) % 2 AS VARCHAR) AS parity FROM conversations)"
)


# Documents with headers and headings glued in: closed, unclosed and no header in turn.

def definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.pmod("doc_id", F.lit(3))
    header = F.concat(
        F.lit("name: "), "source", F.lit("\ndescription: >\n  document "), F.col("doc_id").cast("string"),
        F.lit("\n  in "), "lang", F.lit("\ntools:\n  - Read\n  - "), "lang", F.lit("\nskills: "), "source",
        F.lit("\n"),
    )
    body = F.replace(F.replace("text", F.lit(". "), F.lit(".\n")), F.lit(", "), F.lit("\n  ## "))
    return read(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        F.when(kind == 0, F.concat(F.lit("---\n"), header, F.lit("--- \n"), body))
        .when(kind == 1, F.concat(F.lit(" ---\r\n"), header, body))
        .otherwise(body)
        .alias("content"),
    )


_HEADER = (
    "'name: ' || source || chr(10) || 'description: >' || chr(10) || '  document ' || "
    "CAST(doc_id AS VARCHAR) || chr(10) || '  in ' || lang || chr(10) || 'tools:' || chr(10) || "
    "'  - Read' || chr(10) || '  - ' || lang || chr(10) || 'skills: ' || source || chr(10)"
)
_BODY = "replace(replace(text, '. ', '.' || chr(10)), ', ', chr(10) || '  ## ')"
DEFINITIONS = (
    "definitions AS (SELECT doc_id, source, lang, CASE doc_id % 3 "
    f"WHEN 0 THEN '---' || chr(10) || {_HEADER} || '--- ' || chr(10) || {_BODY} "
    f"WHEN 1 THEN ' ---' || chr(13) || chr(10) || {_HEADER} || {_BODY} "
    f"ELSE {_BODY} END AS content FROM documents)"
)
