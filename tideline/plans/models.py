"""The models of the four layers as plain functions on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.scalars import safe_divide
from tideline.operators.latest import latest_per_key
from tideline.operators.reshape import pivot_conditional, spine_pivot
from tideline.sources.dimensions import HOUSE_PRICE_ID, NATIONAL_SERIES, WEEKLY_WAGE_ID
from tideline.sources.tables import partition_column


# Columns of the raw tables, with their types and whether they may be NULL.
RAW_OBSERVATIONS = T.StructType(
    [
        T.StructField("series_id", T.StringType(), False),
        T.StructField("date", T.DateType(), False),
        T.StructField("value", T.DoubleType()),
        T.StructField("extracted_at", T.TimestampType(), False),
    ]
)
RAW_WEATHER = T.StructType(
    [
        T.StructField("location_id", T.StringType(), False),
        T.StructField("location_name", T.StringType(), False),
        T.StructField("country", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("date", T.DateType(), False),
        T.StructField("temperature_max_c", T.DoubleType()),
        T.StructField("temperature_min_c", T.DoubleType()),
        T.StructField("precipitation_sum_mm", T.DoubleType()),
        T.StructField("wind_speed_max_kmh", T.DoubleType()),
        T.StructField("extracted_at", T.TimestampType(), False),
    ]
)

OBSERVATION_KEYS = ["series_id", "date"]
WEATHER_KEYS = ["location_id", "date"]
STATE_KEYS = ["state_fips", "date"]

# Hours worked in a year: 40 a week, 52 weeks.
HOURS_PER_YEAR = 2080

# The state code inside a state series id of either kind; \z because $ would accept a
# final newline.
HOUSE_PRICE_PREFIX, HOUSE_PRICE_SUFFIX = HOUSE_PRICE_ID.split("%s")
WEEKLY_WAGE_PREFIX, WEEKLY_WAGE_SUFFIX = WEEKLY_WAGE_ID.split("%s")
STATE_PATTERN = (
    rf"\A(?:{HOUSE_PRICE_PREFIX}(?=\d{{2}}{HOUSE_PRICE_SUFFIX}\z)"
    rf"|{WEEKLY_WAGE_PREFIX}(?=\d{{2}}{WEEKLY_WAGE_SUFFIX}\z))(\d{{2}})"
)

# Columns of the marts in their order.
INDICATOR_FACT_COLUMNS = [
    "date",
    "fed_funds_rate",
    "treasury_yield_10y",
    "treasury_yield_2y",
    "yield_curve_spread",
    "mortgage_rate_30y",
    "unemployment_rate",
    "nonfarm_payrolls",
    "cpi_all_urban",
    "core_cpi",
    "pce_price_index",
    "gdp_nominal",
    "gdp_real",
    "housing_starts",
    "consumer_sentiment",
    "industrial_production",
    "median_home_price_national",
    "avg_hourly_earnings",
    "housing_affordability_ratio",
]
STATE_FACT_COLUMNS = [
    "state_fips",
    "date",
    "house_price_index",
    "avg_weekly_wage",
    "housing_affordability_ratio",
]
WEATHER_FACT_COLUMNS = [
    "location_id",
    "location_name",
    "country",
    "latitude",
    "longitude",
    "date",
    "temperature_max_c",
    "temperature_min_c",
    "temperature_range_c",
    "precipitation_sum_mm",
    "wind_speed_max_kmh",
]


def _staged(raw: DataFrame, schema: T.StructType, keys: list[str]) -> DataFrame:
    # The period column rides along as a key: it follows from the date, and being a
    # key lets a cutoff on it reach the scan below the ranking.
    period = [c for c in [partition_column(raw)] if c]
    values = [f for f in schema.fieldNames() if f not in keys and f != "extracted_at"]
    columns = raw.select(*schema.fieldNames(), *period)
    return latest_per_key(columns, [*keys, *period], "extracted_at", values)


def staged_observations(raw: DataFrame) -> DataFrame:
    """The latest revision of every (series_id, date)."""
    return _staged(raw, RAW_OBSERVATIONS, OBSERVATION_KEYS)


def staged_weather(raw: DataFrame) -> DataFrame:
    """The latest revision of every (location_id, date)."""
    return _staged(raw, RAW_WEATHER, WEATHER_KEYS)


def national_indicators(observations: DataFrame) -> DataFrame:
    """One row per date, one column per national series, with the spread and the price ratio."""
    period = [c for c in [partition_column(observations)] if c]
    wide = pivot_conditional(observations, ["date", *period], "series_id", "value", NATIONAL_SERIES)
    spread = F.col("treasury_yield_10y") - F.col("treasury_yield_2y")
    ratio = safe_divide("median_home_price_national", F.col("avg_hourly_earnings") * HOURS_PER_YEAR)
    return wide.withColumns(
        {"yield_curve_spread": spread, "housing_affordability_ratio": ratio}
    ).select("date", *NATIONAL_SERIES.values(), "yield_curve_spread", "housing_affordability_ratio", *period)


def state_affordability(observations: DataFrame) -> DataFrame:
    """House price index and weekly wage of each state on every date either was reported."""
    period = [c for c in [partition_column(observations)] if c]
    is_price = F.startswith("series_id", F.lit(HOUSE_PRICE_PREFIX))
    is_wage = F.startswith("series_id", F.lit(WEEKLY_WAGE_PREFIX))
    # The prefixes reach the scan, where files sorted by series skip what has neither.
    of_state = (is_price | is_wage) & F.col("series_id").rlike(STATE_PATTERN)
    parts = observations.where(of_state).select(
        F.regexp_extract("series_id", STATE_PATTERN, 1).alias("state_fips"),
        "date",
        *period,
        F.when(is_price, F.col("value")).alias("house_price_index"),
        F.when(is_wage, F.col("value")).alias("avg_weekly_wage"),
    )
    measures = {m: F.col(m) for m in ("house_price_index", "avg_weekly_wage")}
    return spine_pivot(parts, [*STATE_KEYS, *period], measures).select(
        *STATE_KEYS,
        *measures,
        safe_divide("house_price_index", "avg_weekly_wage").alias("housing_affordability_ratio"),
        *period,
    )


def weather_metrics(weather: DataFrame) -> DataFrame:
    """Daily weather with its temperature range."""
    period = [c for c in [partition_column(weather)] if c]
    spread = F.col("temperature_max_c") - F.col("temperature_min_c")
    columns = [c for c in RAW_WEATHER.fieldNames() if c != "extracted_at"]
    return weather.select(*columns, spread.alias("temperature_range_c"), *period)
