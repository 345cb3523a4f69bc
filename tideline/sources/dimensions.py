"""The two dimensions kept in code."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# National series and the columns they take in the wide table.
NATIONAL_SERIES = {
    "FEDFUNDS": "fed_funds_rate",
    "DGS10": "treasury_yield_10y",
    "DGS2": "treasury_yield_2y",
    "MORTGAGE30US": "mortgage_rate_30y",
    "UNRATE": "unemployment_rate",
    "PAYEMS": "nonfarm_payrolls",
    "CPIAUCSL": "cpi_all_urban",
    "CPILFESL": "core_cpi",
    "PCEPI": "pce_price_index",
    "GDP": "gdp_nominal",
    "GDPC1": "gdp_real",
    "HOUST": "housing_starts",
    "UMCSENT": "consumer_sentiment",
    "INDPRO": "industrial_production",
    "MSPUS": "median_home_price_national",
    "AHETPI": "avg_hourly_earnings",
}

# 2-digit FIPS codes of the 50 states and DC.
STATE_FIPS = [
    "01", "02", "04", "05", "06", "08", "09", "10", "11", "12",
    "13", "15", "16", "17", "18", "19", "20", "21", "22", "23",
    "24", "25", "26", "27", "28", "29", "30", "31", "32", "33",
    "34", "35", "36", "37", "38", "39", "40", "41", "42", "44",
    "45", "46", "47", "48", "49", "50", "51", "53", "54", "55",
    "56",
]

# Id templates of the state series.
HOUSE_PRICE_ID = "ATNHPIUS%s000A"
WEEKLY_WAGE_ID = "ENUC%s40010SA"

# Id, name, country, latitude and longitude of the weather locations.
LOCATIONS = [
    ("new_york", "New York", "US", 40.7128, -74.0060),
    ("los_angeles", "Los Angeles", "US", 34.0522, -118.2437),
    ("mexico_city", "Mexico City", "MX", 19.4326, -99.1332),
    ("sao_paulo", "Sao Paulo", "BR", -23.5505, -46.6333),
    ("buenos_aires", "Buenos Aires", "AR", -34.6037, -58.3816),
    ("london", "London", "GB", 51.5074, -0.1278),
    ("paris", "Paris", "FR", 48.8566, 2.3522),
    ("berlin", "Berlin", "DE", 52.5200, 13.4050),
    ("madrid", "Madrid", "ES", 40.4168, -3.7038),
    ("moscow", "Moscow", "RU", 55.7558, 37.6173),
    ("cairo", "Cairo", "EG", 30.0444, 31.2357),
    ("lagos", "Lagos", "NG", 6.5244, 3.3792),
    ("johannesburg", "Johannesburg", "ZA", -26.2041, 28.0473),
    ("nairobi", "Nairobi", "KE", -1.2921, 36.8219),
    ("dubai", "Dubai", "AE", 25.2048, 55.2708),
    ("mumbai", "Mumbai", "IN", 19.0760, 72.8777),
    ("beijing", "Beijing", "CN", 39.9042, 116.4074),
    ("tokyo", "Tokyo", "JP", 35.6762, 139.6503),
    ("singapore", "Singapore", "SG", 1.3521, 103.8198),
    ("sydney", "Sydney", "AU", -33.8688, 151.2093),
]


def locations(spark: SparkSession) -> DataFrame:
    """The 20 weather locations."""
    return spark.createDataFrame(
        LOCATIONS, "location_id STRING, name STRING, country STRING, latitude DOUBLE, longitude DOUBLE"
    )


def ids_from_templates(codes: DataFrame, code_col: str, templates: list[str]) -> DataFrame:
    """``series_id`` for every code and template: each row fans out in place, without a join."""
    ids = [F.format_string(t, F.col(code_col)) for t in templates]
    return codes.select(F.explode(F.array(*ids)).alias("series_id"))


def series_catalog(spark: SparkSession) -> DataFrame:
    """The 118 series ids: national ones, then two for every state."""
    national = spark.createDataFrame([(s,) for s in NATIONAL_SERIES], "series_id STRING")
    states = spark.createDataFrame([(f,) for f in STATE_FIPS], "state_fips STRING")
    return national.unionByName(
        ids_from_templates(states, "state_fips", [HOUSE_PRICE_ID, WEEKLY_WAGE_ID])
    )
