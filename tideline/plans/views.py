"""The view models as SQL, for views that the catalogue keeps and any session can read."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from tideline.plans import models
from tideline.sources.dimensions import NATIONAL_SERIES

_INFINITY = "double('Infinity')"


def _text(value: str) -> str:
    """A string of SQL that stands for itself, without escapes."""
    return "r'" + value + "'"


def safe_ratio(a: str, b: str) -> str:
    """``a / b`` as double, NULL on a zero divisor and on overflow."""
    a, b = f"CAST({a} AS DOUBLE)", f"CAST({b} AS DOUBLE)"
    quotient = f"try_divide({a}, {b})"
    overflow = f"abs({quotient}) = {_INFINITY} AND abs({a}) < {_INFINITY} AND abs({b}) < {_INFINITY}"
    return f"CASE WHEN NOT coalesce({overflow}, false) THEN {quotient} END"


def staged(raw: str, columns: Sequence[str], keys: Sequence[str]) -> str:
    """The latest revision of every key; the period follows from the date and rides along."""
    every = [*columns, "date_month"]
    known = " AND ".join(f"{k} IS NOT NULL" for k in (*keys, "date_month"))
    values = [c for c in columns if c not in keys and c != "extracted_at"]
    order = ", ".join(f"{c} DESC" for c in ("extracted_at", *values))
    return (
        f"SELECT {', '.join(every)} FROM (SELECT {', '.join(every)}, row_number() OVER "
        f"(PARTITION BY {', '.join(keys)}, date_month ORDER BY {order}) AS _rank FROM {raw} WHERE {known}) WHERE _rank = 1"
    )


def national_indicators(observations: str) -> str:
    wide = ", ".join(f"max(CASE WHEN series_id = '{s}' THEN value END) AS {c}" for s, c in NATIONAL_SERIES.items())
    ids = ", ".join(f"'{s}'" for s in NATIONAL_SERIES)
    ratio = safe_ratio("median_home_price_national", f"avg_hourly_earnings * {models.HOURS_PER_YEAR}")
    return (
        f"SELECT date, {', '.join(NATIONAL_SERIES.values())}, treasury_yield_10y - treasury_yield_2y AS yield_curve_spread, "
        f"{ratio} AS housing_affordability_ratio, date_month FROM "
        f"(SELECT date, date_month, {wide} FROM {observations} WHERE series_id IN ({ids}) GROUP BY date, date_month)"
    )


def state_affordability(observations: str) -> str:
    is_price = f"startswith(series_id, '{models.HOUSE_PRICE_PREFIX}')"
    is_wage = f"startswith(series_id, '{models.WEEKLY_WAGE_PREFIX}')"
    pattern = _text(models.STATE_PATTERN)
    return (
        f"SELECT state_fips, date, house_price_index, avg_weekly_wage, {safe_ratio('house_price_index', 'avg_weekly_wage')} "
        "AS housing_affordability_ratio, date_month FROM (SELECT state_fips, date, date_month, "
        "max(house_price_index) AS house_price_index, max(avg_weekly_wage) AS avg_weekly_wage FROM "
        f"(SELECT regexp_extract(series_id, {pattern}, 1) AS state_fips, date, date_month, "
        f"CASE WHEN {is_price} THEN value END AS house_price_index, CASE WHEN {is_wage} THEN value END AS avg_weekly_wage "
        f"FROM {observations} WHERE ({is_price} OR {is_wage}) AND rlike(series_id, {pattern})) "
        "WHERE house_price_index IS NOT NULL OR avg_weekly_wage IS NOT NULL GROUP BY state_fips, date, date_month)"
    )


def weather_metrics(weather: str) -> str:
    columns = ", ".join(c for c in models.RAW_WEATHER.fieldNames() if c != "extracted_at")
    return f"SELECT {columns}, temperature_max_c - temperature_min_c AS temperature_range_c, date_month FROM {weather}"


def _staged_as(schema, keys: Sequence[str]) -> Callable[[str], str]:
    return lambda raw: staged(raw, schema.fieldNames(), keys)


#: The SQL of each view model over the table or view that it reads.
VIEWS: dict[tuple[str, str], Callable[[str], str]] = {
    ("1_staging_warehouses", "economic_observations"): _staged_as(models.RAW_OBSERVATIONS, models.OBSERVATION_KEYS),
    ("1_staging_warehouses", "daily_weather"): _staged_as(models.RAW_WEATHER, models.WEATHER_KEYS),
    ("3_staging_marts", "national_indicators"): national_indicators,
    ("3_staging_marts", "state_affordability"): state_affordability,
    ("3_staging_marts", "weather_metrics"): weather_metrics,
}
