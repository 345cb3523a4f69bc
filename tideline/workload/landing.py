"""Payload decoding: payloads are packed from the tables row by row and decoded back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.ordering import CHUNK, number_rows, split_groups
from tideline.plans.landing import RAW_TABLES, land_pages, request_plan
from tideline.plans.layers import create_raw_tables
from tideline.session import new_folder
from tideline.sources.dimensions import LOCATIONS
from tideline.sources.payloads import (
    DAILY_VARIABLES,
    PAGE_LIMIT,
    assemble_pages,
    assembled,
    decode_observations,
    decode_parallel_arrays,
    decode_weather,
)
from tideline.sources.tables import LOAD_BATCH_ROWS, layer_table_name
from tideline.sources.watermarks import kept_watermarks
from tideline.streaming.page_sets import land_page_sets
from tideline.workload import inputs
from tideline.workload.catalogue import query, read


@query(
    "decode_observations",
    "SELECT event_id AS series_id, CAST(ts AS DATE) AS date, value, ts AS extracted_at FROM events "
    "UNION ALL SELECT event_id, CAST(ts AS DATE) + 1, NULL, ts FROM events "
    "UNION ALL SELECT event_id, CAST(ts AS DATE) + 2, NULL, ts FROM events "
    "UNION ALL SELECT event_id, CAST(ts AS DATE) + 3, 0.0, ts FROM events",
)
def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a page of four observations: a value, a missing mark, no value, a zero."""
    events = read(spark, sf_dir, "events")
    written = [F.col("value").cast("string"), F.lit("."), F.lit(None).cast("string"), F.lit("0")]
    items = [
        F.struct(
            F.date_format(F.date_add(F.to_date("ts"), i), "yyyy-MM-dd").alias("date"), value.alias("value")
        )
        for i, value in enumerate(written)
    ]
    pages = events.select(
        F.col("event_id").alias("series_id"),
        F.to_json(F.struct(F.array(*items).alias("observations"))).alias("payload"),
        F.col("ts").alias("extracted_at"),
    )
    return decode_observations(pages)


@query(
    "decode_parallel_arrays",
    "SELECT o_orderkey AS location_id, CAST(o_orderdate AS DATE) + CAST(i AS INTEGER) AS date, "
    "CASE i WHEN 0 THEN o_totalprice WHEN 1 THEN o_totalprice + 1 END AS temperature_max_c, "
    "o_totalprice - i AS temperature_min_c, CAST(NULL AS DOUBLE) AS precipitation_sum_mm, "
    "CASE i WHEN 1 THEN o_totalprice * 2 END AS wind_speed_max_kmh, o_orderdate AS extracted_at "
    "FROM orders, range(3) AS r(i) WHERE o_orderstatus <> 'P'",
)
def parallel_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as three days: one array short, one long, one missing, one with gaps.

    Pending orders have no daily block and so give no rows.
    """
    price, gap = F.col("o_totalprice"), F.lit(None).cast("double")
    day = F.to_date("o_orderdate")
    block = F.struct(
        F.array(*[F.date_format(F.date_add(day, i), "yyyy-MM-dd") for i in range(3)]).alias("time"),
        F.array(price, price + 1).alias("temperature_2m_max"),
        F.array(*[price - i for i in range(4)]).alias("temperature_2m_min"),
        F.array(gap, price * 2, gap).alias("wind_speed_10m_max"),
    )
    pages = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("location_id"),
        F.when(F.col("o_orderstatus") == "P", "{}")
        .otherwise(F.to_json(F.struct(block.alias("daily"))))
        .alias("payload"),
        F.col("o_orderdate").alias("extracted_at"),
    )
    return decode_parallel_arrays(pages)


@query(
    "decode_weather",
    f"WITH {inputs.RAW_WEATHER} SELECT * EXCLUDE (date, i), date + CAST(i AS INTEGER) AS date "
    "FROM raw_weather, range(2) AS r(i)",
)
def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as two days of the same weather, with its location looked up."""
    rows = inputs.raw_weather(spark, sf_dir)
    days = [F.date_format(F.date_add("date", i), "yyyy-MM-dd") for i in range(2)]
    block = F.struct(
        F.array(*days).alias("time"),
        *[F.array(column, column).alias(field) for field, column in DAILY_VARIABLES.items()],
    )
    payload = F.to_json(F.struct(block.alias("daily"))).alias("payload")
    return decode_weather(rows.select("location_id", payload, "extracted_at"))


_PAGES = (
    "captures AS (SELECT l_orderkey AS series_id, (l_linenumber - 1) * 3 AS page_offset, l_shipdate AS extracted_at, "
    "CASE WHEN l_linenumber < 3 THEN 3 ELSE CAST(l_quantity AS BIGINT) % 4 END AS size, l_suppkey FROM lineitem), "
    "pages AS (" + inputs.ranked_first("captures", "series_id, page_offset", "extracted_at DESC, size DESC, l_suppkey DESC")
    + "), last_page AS (SELECT series_id, max(page_offset) AS last FROM pages GROUP BY 1), "
    "sets AS (SELECT series_id, count(*) AS pages, CAST(sum(size) AS BIGINT) AS rows, "
    "last = (count(*) - 1) * 3 AND count(*) FILTER (size < 3) = 1 "
    "AND bool_or(page_offset = last AND size < 3) AS complete "
    "FROM pages JOIN last_page USING (series_id) GROUP BY series_id, last)"
)


def _captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order as captures of its pages of at most three observations, some of a page more than once.

    The payload begins with its size and supplier in fixed width, so that captures of one time are
    ordered alike here and in SQL.
    """
    size = F.when(F.col("l_linenumber") < 3, 3).otherwise(F.pmod(F.col("l_quantity").cast("int"), F.lit(4)))
    item = F.struct(F.lit("2024-01-01").alias("date"), F.col("l_suppkey").cast("string").alias("value"))
    mark = F.concat(size.cast("string"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0"))
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("series_id"),
        ((F.col("l_linenumber") - 1) * 3).alias("page_offset"),
        F.to_json(F.struct(mark.alias("mark"), F.array_repeat(item, size).alias("observations"))).alias("payload"),
        F.col("l_shipdate").alias("extracted_at"),
    )


@query("assemble_pages", f"WITH {_PAGES} SELECT * FROM sets")
def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble_pages(_captures(spark, sf_dir), "series_id", page_limit=3)


@query(
    "assembled_rows",
    f"WITH {_PAGES} SELECT series_id, page_offset + i AS at, DATE '2024-01-01' AS date, "
    "CAST(l_suppkey AS DOUBLE) AS value, extracted_at "
    "FROM pages JOIN sets USING (series_id), range(3) AS r(i) WHERE i < size AND complete",
)
def page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assembled(_captures(spark, sf_dir), "series_id", page_limit=3)[1]


# Two runs of the landing job: lines 1 to 3 of every order, then the others from the watermarks on.
_JOB = (
    f"WITH {inputs.RAW_OBSERVATIONS_WITH_LINE}, first_sets AS (SELECT series_id FROM raw_lines WHERE l_linenumber <= 3 "
    "GROUP BY 1 HAVING count(*) % 1000 <> 0), "
    "first AS (SELECT series_id, date, value, TIMESTAMP '2024-01-01' AS extracted_at FROM raw_lines "
    "SEMI JOIN first_sets USING (series_id) WHERE l_linenumber <= 3), "
    "marks AS (SELECT series_id, max(date) AS mark FROM first GROUP BY 1), "
    "asked AS (SELECT raw_lines.* FROM raw_lines LEFT JOIN marks USING (series_id) "
    "WHERE l_linenumber > 3 AND (mark IS NULL OR date >= mark)), "
    "second_sets AS (SELECT series_id FROM asked GROUP BY 1 HAVING count(*) % 1000 <> 0), "
    "second AS (SELECT series_id, date, value, TIMESTAMP '2024-01-02' AS extracted_at FROM asked "
    "SEMI JOIN second_sets USING (series_id)) SELECT * FROM first UNION ALL SELECT * FROM second"
)


def _answers(lines: DataFrame, run: int) -> DataFrame:
    """What the source answers: pages of a thousand observations for each series, in order of their dates.

    An answer that ends with a full page has lost its last page, and so is not complete.
    """
    order = ["date", "value", "line"]
    numbered = number_rows(split_groups(lines, ["series_id"], order), ["series_id"], order, "n").drop(CHUNK)
    text = F.coalesce(F.col("value").cast("string"), F.lit("."))
    item = F.struct("n", F.date_format("date", "yyyy-MM-dd").alias("date"), text.alias("value"))
    offset = (F.floor((F.col("n") - 1) / PAGE_LIMIT) * PAGE_LIMIT).cast("long").alias("page_offset")
    pages = numbered.groupBy("series_id", offset).agg(F.sort_array(F.collect_list(item)).alias("observations"))
    return pages.select(
        "series_id",
        "page_offset",
        F.to_json(F.struct("observations")).alias("payload"),
        F.lit(dt.datetime(2024, 1, run, tzinfo=dt.timezone.utc)).cast("timestamp").alias("extracted_at"),
    )


def _two_landings(spark: SparkSession, sf_dir: str) -> str:
    """Two runs over all line items: plan the requests, land the pages, plan again from what landed."""
    prefix = f"landing_{uuid.uuid4().hex}_"
    create_raw_tables(spark, prefix)
    lines = inputs.raw_observations(spark, sf_dir, F.col("l_linenumber").alias("line"))
    for run, part in ((1, F.col("line") <= 3), (2, F.col("line") > 3)):
        plan = request_plan(spark, "economic", prefix)
        asked = lines.where(part).join(plan, "series_id").where(
            F.col("start_date").isNull() | (F.col("date") >= F.col("start_date"))
        )
        land_pages(spark, "economic", _answers(asked, run), prefix=prefix, batch_rows=LOAD_BATCH_ROWS)
    return layer_table_name("raw", "economic_observations", prefix)


def _plain_times(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query("landing_job", _JOB)
def landing_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = spark.table(_two_landings(spark, sf_dir))
    return _plain_times(landed.select("series_id", "date", "value", "extracted_at"), "extracted_at")


@query(
    "kept_watermarks",
    f"SELECT series_id, max(date) AS max_date, max(extracted_at) AS newest FROM ({_JOB}) GROUP BY series_id",
)
def marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the table knows of its keys after both runs, without being read."""
    return _plain_times(kept_watermarks(spark, _two_landings(spark, sf_dir)), "newest")


# Weather twenty years later, so that the days that are asked for by default lie within it. The first run asks
# from 2015 to six days before it, the second from each location's newest day on.
_SHIFT = 7305
_RUNS = (dt.datetime(2018, 6, 15, 12, tzinfo=dt.timezone.utc), dt.datetime(2030, 1, 1, tzinfo=dt.timezone.utc))
_WEATHER_JOB = (
    f"WITH {inputs.RAW_WEATHER}, later AS (SELECT * EXCLUDE (date, extracted_at), date + {_SHIFT} AS date FROM raw_weather), "
    "first AS (SELECT *, TIMESTAMP '2018-06-15 12:00:00' AS extracted_at FROM later "
    "WHERE date BETWEEN DATE '2015-01-01' AND DATE '2018-06-09'), "
    "marks AS (SELECT location_id, max(date) AS mark FROM first GROUP BY 1), "
    "second AS (SELECT later.*, TIMESTAMP '2030-01-01' AS extracted_at FROM later LEFT JOIN marks USING (location_id) "
    "WHERE date >= coalesce(mark, DATE '2015-01-01') AND date <= DATE '2029-12-26')"
)


def _weather_answers(plan: DataFrame, spark: SparkSession, sf_dir: str, now: dt.datetime) -> DataFrame:
    """A page for each order's day, of the days that were asked for."""
    rows = inputs.raw_weather(spark, sf_dir).drop("extracted_at").withColumn("date", F.date_add("date", _SHIFT))
    asked = rows.join(plan.select("location_id", "start_date", "end_date"), "location_id")
    asked = asked.where(F.col("date").between(F.col("start_date"), F.col("end_date")))
    block = F.struct(
        F.array(F.date_format("date", "yyyy-MM-dd")).alias("time"),
        *[F.array(column).alias(field) for field, column in DAILY_VARIABLES.items()],
    )
    payload = F.to_json(F.struct(block.alias("daily"))).alias("payload")
    return asked.select("location_id", payload, F.lit(now).cast("timestamp").alias("extracted_at"))


def _land_weather(spark: SparkSession, sf_dir: str, prefix: str, now: dt.datetime) -> None:
    plan = request_plan(spark, "weather", prefix, now)
    land_pages(spark, "weather", _weather_answers(plan, spark, sf_dir, now), prefix=prefix)


@query("weather_landing_job", _WEATHER_JOB + " SELECT * FROM first UNION ALL SELECT * FROM second")
def weather_landing_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs with a fixed clock: the default start, the days the archive lags behind, then from the newest day on."""
    prefix = f"landing_{uuid.uuid4().hex}_"
    create_raw_tables(spark, prefix)
    for now in _RUNS:
        _land_weather(spark, sf_dir, prefix, now)
    landed = spark.table(layer_table_name("raw", "daily_weather", prefix))
    return _plain_times(landed.drop("date_month"), "extracted_at")


@query(
    "weather_request_plan",
    _WEATHER_JOB + ", places AS (SELECT unnest(" + inputs.listed([row[0] for row in LOCATIONS]) + ") AS location_id) "
    "SELECT location_id, coalesce(mark, DATE '2015-01-01') AS start_date, DATE '2018-06-07' AS end_date "
    "FROM places LEFT JOIN marks USING (location_id) WHERE coalesce(mark, DATE '2015-01-01') <= DATE '2018-06-07'",
)
def weather_request_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan two days before the first run: locations that are ahead of the archive by then have nothing to ask for."""
    prefix = f"landing_{uuid.uuid4().hex}_"
    create_raw_tables(spark, prefix)
    _land_weather(spark, sf_dir, prefix, _RUNS[0])
    plan = request_plan(spark, "weather", prefix, _RUNS[0] - dt.timedelta(days=2))
    return plan.select("location_id", "start_date", "end_date")


# Pages of an order, all captured at one time, that arrive in three runs: first the first, then the second, then the others.
_ONE_TIME = _PAGES.replace("l_shipdate AS extracted_at", "TIMESTAMP '2024-01-01' AS extracted_at")


@query(
    "streamed_page_sets",
    f"WITH {_ONE_TIME} SELECT CAST(series_id AS VARCHAR) AS series_id, DATE '2024-01-01' AS date, "
    "CAST(l_suppkey AS DOUBLE) AS value, extracted_at "
    "FROM pages JOIN sets USING (series_id), range(3) AS r(i) WHERE i < size AND complete",
)
def streamed_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sets held by the stream until their short last page; those that stay open land nothing."""
    prefix = f"landing_{uuid.uuid4().hex}_"
    create_raw_tables(spark, prefix)
    table = layer_table_name("raw", "economic_observations", prefix)
    captures = new_folder(spark, "captures")
    checkpoint = new_folder(spark, "stream")
    at = F.lit(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)).cast("timestamp")
    pages = _captures(spark, sf_dir).withColumns(
        {"series_id": F.col("series_id").cast("string"), "page_offset": F.col("page_offset").cast("long"), "extracted_at": at}
    )
    for part in (F.col("page_offset") == 0, F.col("page_offset") == 3, F.col("page_offset") > 3):
        pages.where(part).write.mode("append").parquet(captures)
        land_page_sets(spark, captures, table, RAW_TABLES["economic"].schema, page_limit=3, checkpoint=checkpoint)
    return _plain_times(spark.table(table).drop("date_month"), "extracted_at")
