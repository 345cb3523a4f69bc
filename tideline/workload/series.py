"""Deduplication, reshaping, scalar rules and incremental reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.scalars import regex_extract_null, safe_divide, sentinel_to_null
from tideline.operators.incremental import incremental_tail, plan_requests, watermarks
from tideline.operators.latest import latest_per_key, top_n_per_key
from tideline.operators.reshape import pivot_conditional, spine_join, spine_pivot
from tideline.plans.models import HOURS_PER_YEAR
from tideline.sources.dimensions import ids_from_templates
from tideline.workload import inputs
from tideline.workload.catalogue import query, read

KEYS = ["user_id", "event_type", "date"]

# Event types and the columns they take in the wide table.
WIDE = {
    "view": "views",
    "click": "clicks",
    "error": "errors",
    "purchase": "purchases",
    "signup": "signups",
}
_WIDE_SQL = ", ".join(f"max(CASE WHEN event_type = '{t}' THEN value END) AS {c}" for t, c in WIDE.items())


@query(
    "latest_per_key",
    f"WITH {inputs.LATEST_OBSERVATIONS} "
    "SELECT user_id, event_type, date, value, extracted_at, event_id FROM latest",
)
def latest_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(inputs.observations(spark, sf_dir), KEYS, "extracted_at", ["event_id"])


@query(
    "latest_weather_shape",
    "SELECT * EXCLUDE (rn) FROM (SELECT *, o_totalprice / 1000 AS price_thousands, row_number() OVER "
    "(PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1",
)
def latest_weather_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").withColumn("price_thousands", F.col("o_totalprice") / 1000)
    return latest_per_key(orders, ["o_custkey"], "o_orderdate", ["o_orderkey"])


@query(
    "top_n_per_key",
    "SELECT * EXCLUDE (rn) FROM (SELECT o_custkey, o_orderkey, o_orderdate, row_number() OVER (PARTITION BY "
    "o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn <= 5",
)
def top_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return top_n_per_key(orders, ["o_custkey"], "o_orderdate", 5, ["o_orderkey"])


def wide_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = latest_observations(spark, sf_dir)
    return pivot_conditional(latest, ["user_id", "date"], "event_type", "value", WIDE)


@query(
    "pivot_indicators",
    f"WITH {inputs.LATEST_OBSERVATIONS}, wide AS (SELECT user_id, date, {_WIDE_SQL} FROM latest "
    "GROUP BY user_id, date) SELECT *, views - clicks AS view_click_spread, "
    f"purchases / nullif(signups * {HOURS_PER_YEAR}, 0) AS purchase_ratio FROM wide",
)
def pivot_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest revisions, long to wide, with a spread and a safe ratio."""
    return wide_events(spark, sf_dir).withColumns(
        {
            "view_click_spread": F.col("views") - F.col("clicks"),
            "purchase_ratio": safe_divide("purchases", F.col("signups") * HOURS_PER_YEAR),
        }
    )


@query(
    "spread",
    f"WITH {inputs.LATEST_OBSERVATIONS}, wide AS (SELECT user_id, date, {_WIDE_SQL} FROM latest "
    "GROUP BY user_id, date) SELECT user_id, date, purchases - errors AS spread FROM wide",
)
def spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_events(spark, sf_dir).select(
        "user_id", "date", (F.col("purchases") - F.col("errors")).alias("spread")
    )


@query(
    "daily_range",
    f"WITH {inputs.RAW_WEATHER} SELECT location_id, date, extracted_at, "
    "temperature_max_c - temperature_min_c AS temperature_range_c FROM raw_weather",
)
def daily_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.raw_weather(spark, sf_dir).select(
        "location_id",
        "date",
        "extracted_at",
        (F.col("temperature_max_c") - F.col("temperature_min_c")).alias("temperature_range_c"),
    )


@query(
    "safe_ratio",
    "SELECT l_orderkey, l_linenumber, l_extendedprice / nullif(l_discount * "
    f"{HOURS_PER_YEAR}, 0) AS ratio FROM lineitem",
)
def safe_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        safe_divide("l_extendedprice", F.col("l_discount") * HOURS_PER_YEAR).alias("ratio"),
    )


@query(
    "sentinel_to_null",
    "SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value FROM events",
)
def sentinel(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events")
    written = F.when(F.col("event_type") == "error", ".").otherwise(F.col("value").cast("string"))
    return events.select("event_id", sentinel_to_null(written).alias("value"))


@query("regex_filter", "SELECT p_partkey, p_brand FROM part WHERE regexp_matches(p_brand, '^Brand#[0-9]{2}$')")
def regex_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return parts.where(F.col("p_brand").rlike(r"\ABrand#\d{2}\z"))


@query(
    "regex_extract_null",
    "SELECT p_partkey, nullif(regexp_extract(p_brand, '^Brand#([0-9]{2})$', 1), '') AS brand_code FROM part",
)
def regex_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(
        "p_partkey", regex_extract_null("p_brand", r"\ABrand#(\d{2})\z").alias("brand_code")
    )


# Two series per user, named like the state series, with the user id inside the name: what went well, and the rest.
_SERIES_SQL = (
    f"WITH {inputs.OBSERVATIONS}, named AS (SELECT CASE WHEN event_type IN ('purchase', 'signup') "
    "THEN 'PUR' || user_id || '000A' ELSE 'ERR' || user_id || '10SA' END AS series_id, date, max(value) AS value "
    "FROM obs GROUP BY ALL), "
    "p AS (SELECT date, value AS purchases, regexp_extract(series_id, '^PUR([0-9]+)000A$', 1) AS user_key "
    "FROM named WHERE regexp_matches(series_id, '^PUR[0-9]+000A$') AND value IS NOT NULL), "
    "e AS (SELECT date, value AS errors, regexp_extract(series_id, '^ERR([0-9]+)10SA$', 1) AS user_key "
    "FROM named WHERE regexp_matches(series_id, '^ERR[0-9]+10SA$') AND value IS NOT NULL), "
    "spine AS (SELECT user_key, date FROM p UNION SELECT user_key, date FROM e) "
    "SELECT spine.user_key, spine.date, p.purchases, e.errors, purchases / nullif(errors, 0) AS ratio "
    "FROM spine LEFT JOIN p ON spine.user_key = p.user_key AND spine.date = p.date "
    "LEFT JOIN e ON spine.user_key = e.user_key AND spine.date = e.date"
)
PURCHASE_SERIES, ERROR_SERIES = r"\APUR(\d+)000A\z", r"\AERR(\d+)10SA\z"


def named_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id").cast("string")
    name = F.when(
        F.col("event_type").isin("purchase", "signup"), F.concat(F.lit("PUR"), user, F.lit("000A"))
    ).otherwise(F.concat(F.lit("ERR"), user, F.lit("10SA")))
    obs = inputs.observations(spark, sf_dir)
    return obs.groupBy(name.alias("series_id"), "date").agg(F.max("value").alias("value"))


@query("state_spine", _SERIES_SQL)
def state_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spine from one scan: both parts come from one table with unique keys."""
    named = named_series(spark, sf_dir)
    purchase = regex_extract_null("series_id", PURCHASE_SERIES)
    error = regex_extract_null("series_id", ERROR_SERIES)
    parts = named.select(
        F.coalesce(purchase, error).alias("user_key"),
        "date",
        F.when(purchase.isNotNull(), F.col("value")).alias("purchases"),
        F.when(error.isNotNull(), F.col("value")).alias("errors"),
    )
    spine = spine_pivot(
        parts, ["user_key", "date"], {"purchases": F.col("purchases"), "errors": F.col("errors")}
    )
    return spine.withColumn("ratio", safe_divide("purchases", "errors"))


@query("state_spine_join", _SERIES_SQL)
def state_spine_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spine as distinct keys with each part joined on."""
    named = named_series(spark, sf_dir)

    def part(pattern: str, column: str) -> DataFrame:
        return named.where(F.col("series_id").rlike(pattern) & F.col("value").isNotNull()).select(
            regex_extract_null("series_id", pattern).alias("user_key"), "date", F.col("value").alias(column)
        )

    parts = [part(PURCHASE_SERIES, "purchases"), part(ERROR_SERIES, "errors")]
    return spine_join(parts, ["user_key", "date"]).withColumn("ratio", safe_divide("purchases", "errors"))


@query(
    "series_catalog",
    "SELECT c_name AS series_id FROM customer UNION ALL SELECT 'HPI' || p_partkey || '000A' FROM part "
    "UNION ALL SELECT 'WAGE' || p_partkey || '10SA' FROM part",
)
def catalogue_of_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = read(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("code"))
    literal = read(spark, sf_dir, "customer").select(F.col("c_name").alias("series_id"))
    return literal.unionByName(ids_from_templates(codes, "code", ["HPI%s000A", "WAGE%s10SA"]))


@query(
    "watermarks",
    "SELECT o_custkey, max(CAST(o_orderdate AS DATE)) AS max_date FROM orders GROUP BY o_custkey",
)
def order_watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").withColumn("date", F.to_date("o_orderdate"))
    return watermarks(orders, "o_custkey", "date")


# Orders go to customers 1, 2, 4, 5, ..., so that every third customer has no watermark.
@query(
    "request_plan",
    f"WITH wm AS (SELECT {inputs.OTHER_CUSTOMER} AS o_custkey, max(CAST(o_orderdate AS DATE)) AS max_date FROM orders "
    "GROUP BY 1), plan AS (SELECT c_custkey, "
    "coalesce(max_date - 3, DATE '1995-01-01') AS start_date, DATE '2001-03-01' AS end_date "
    "FROM customer LEFT JOIN wm ON c_custkey = o_custkey) SELECT * FROM plan WHERE start_date <= end_date",
)
def request_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders")
    marks = watermarks(
        orders.select(inputs.other_customer().alias("c_custkey"), F.to_date("o_orderdate").alias("date")),
        "c_custkey",
        "date",
    )
    customers = read(spark, sf_dir, "customer").select("c_custkey")
    return plan_requests(customers, marks, "c_custkey", "1995-01-01", "2001-03-01", overlap_days=3)


def _dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("date"), "o_totalprice"
    )


_LANDED = "DATE '2000-02-29'"
_TAIL = (
    "WITH src AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS date, o_totalprice FROM orders), "
    f"tgt AS (SELECT * FROM src WHERE date <= {_LANDED}) "
)


def _landed(source: DataFrame) -> DataFrame:
    return source.where(F.col("date") <= F.lit("2000-02-29").cast("date"))


@query(
    "incremental_tail_days",
    _TAIL + "SELECT * FROM src WHERE date >= (SELECT max(date) - 90 FROM tgt)",
)
def tail_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _dated_orders(spark, sf_dir)
    return incremental_tail(source, _landed(source), days=90)


@query(
    "incremental_tail_years",
    _TAIL + "SELECT * FROM src WHERE date >= (SELECT CAST(max(date) - INTERVAL 3 YEAR AS DATE) FROM tgt)",
)
def tail_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _dated_orders(spark, sf_dir)
    return incremental_tail(source, _landed(source), years=3)


@query(
    "incremental_tail_days_per_key",
    _TAIL.rstrip() + ", cut AS (SELECT o_custkey AS k, max(date) - 90 AS start FROM tgt GROUP BY 1) "
    "SELECT src.* FROM src LEFT JOIN cut ON o_custkey = k WHERE start IS NULL OR date >= start",
)
def tail_days_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _dated_orders(spark, sf_dir)
    return incremental_tail(source, _landed(source), days=90, scope="per_key", keys=["o_custkey"])
