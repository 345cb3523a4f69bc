"""The models of both sources, as plans over raw rows and as the layered job over written tables."""

from __future__ import annotations

import datetime as dt
import uuid
from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.checks import check_rows
from tideline.plans import models
from tideline.plans.landing import RAW_TABLES
from tideline.plans.layers import CheckFailed, create_raw_tables, model_rows, run_layers
from tideline.sources.dimensions import NATIONAL_SERIES
from tideline.sources.tables import append_rows, layer_table_name
from tideline.sources.watermarks import kept_watermarks
from tideline.workload import inputs
from tideline.workload.catalogue import query

_NATIONAL = ", ".join(f"'{s}'" for s in NATIONAL_SERIES)
_PIVOT = ", ".join(
    f"max(CASE WHEN series_id = '{s}' THEN value END) AS {c}" for s, c in NATIONAL_SERIES.items()
)


def _indicators(source: str) -> str:
    return (
        "SELECT *, treasury_yield_10y - treasury_yield_2y AS yield_curve_spread, median_home_price_national / "
        f"nullif(avg_hourly_earnings * 2080, 0) AS housing_affordability_ratio FROM (SELECT date, {_PIVOT} "
        f"FROM {source} WHERE series_id IN ({_NATIONAL}) GROUP BY date)"
    )


def _affordability(source: str) -> str:
    def part(pattern: str, column: str) -> str:
        return (
            f"(SELECT date, value AS {column}, regexp_extract(series_id, '{pattern}', 1) AS state_fips "
            f"FROM {source} WHERE regexp_matches(series_id, '{pattern}') AND value IS NOT NULL)"
        )

    price = part("^ATNHPIUS([0-9]{2})000A$", "house_price_index")
    wage = part("^ENUC([0-9]{2})40010SA$", "avg_weekly_wage")
    return (
        "SELECT s.state_fips, s.date, house_price_index, avg_weekly_wage, "
        "house_price_index / nullif(avg_weekly_wage, 0) AS housing_affordability_ratio FROM "
        f"(SELECT state_fips, date FROM {price} UNION SELECT state_fips, date FROM {wage}) AS s "
        f"LEFT JOIN {price} AS p ON s.state_fips = p.state_fips AND s.date = p.date "
        f"LEFT JOIN {wage} AS w ON s.state_fips = w.state_fips AND s.date = w.date"
    )


def _metrics(source: str) -> str:
    return (
        "SELECT * EXCLUDE (extracted_at), temperature_max_c - temperature_min_c AS temperature_range_c "
        f"FROM {source}"
    )


@query(
    "staged_observations",
    f"WITH {inputs.STAGED_OBSERVATIONS} SELECT series_id, date, value, extracted_at FROM staged",
)
def staged_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.staged_observations(inputs.raw_observations(spark, sf_dir))


@query("staged_weather", f"WITH {inputs.STAGED_WEATHER} SELECT * FROM staged")
def staged_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.staged_weather(inputs.raw_weather(spark, sf_dir))


@query("national_indicators", f"WITH {inputs.STAGED_OBSERVATIONS} {_indicators('staged')}")
def national_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.national_indicators(staged_observations(spark, sf_dir))


@query("state_affordability", f"WITH {inputs.STAGED_OBSERVATIONS} {_affordability('staged')}")
def state_affordability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.state_affordability(staged_observations(spark, sf_dir))


@query("weather_metrics", f"WITH {inputs.STAGED_WEATHER} {_metrics('staged')}")
def weather_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.weather_metrics(staged_weather(spark, sf_dir))


# The layered job is run twice: over what was extracted up to the first cut, then over
# everything.  The second run merges trailing windows into the tables of the first.
FIRST_RUN = dt.datetime(2000, 6, 15)
_CUT = "TIMESTAMP '2000-06-15'"


def _merged(first: str, second: str, keys: str, tail: str) -> str:
    same = " AND ".join(f"s.{k.strip()} = t.{k.strip()}" for k in keys.split(","))
    window = f"(SELECT * FROM {second} WHERE date >= (SELECT {tail} FROM {first}))"
    return (
        f"SELECT * FROM {window} UNION ALL BY NAME SELECT * FROM {first} AS t "
        f"WHERE NOT EXISTS (SELECT 1 FROM {window} AS s WHERE {same})"
    )


_DAYS, _YEARS = "max(date) - 90", "CAST(max(date) - INTERVAL 3 YEAR AS DATE)"


def _layers_sql(raw: str, raw_name: str, order: str, keys: str, mart, mart_keys: str, tail: str) -> str:
    return (
        f"WITH {raw}, stage1 AS ({inputs.ranked_first(raw_name, keys, order, f'extracted_at <= {_CUT}')}), "
        f"stage2 AS ({inputs.ranked_first(raw_name, keys, order)}), "
        f"house2 AS ({_merged('stage1', 'stage2', keys, _DAYS)}), "
        f"mart1 AS ({mart('stage1')}), mart2 AS ({mart('house2')}) "
        + _merged("mart1", "mart2", mart_keys, tail)
    )


def _two_runs(spark: SparkSession, source: str, raw: DataFrame, mart: str, *others: str) -> DataFrame:
    prefix = f"run_{uuid.uuid4().hex}_"
    landed = RAW_TABLES[source]
    table = layer_table_name("raw", landed.name, prefix)
    early = F.col("extracted_at") <= F.lit(FIRST_RUN).cast("timestamp_ntz")
    create_raw_tables(spark, prefix)

    def land(rows: DataFrame):
        return lambda _: append_rows(rows, table, landed.schema, cluster=[landed.key])

    chosen = {"sources": [source], "models": [mart, *others], "prefix": prefix}
    run_layers(spark, land=[land(raw.where(early))], **chosen)
    run_layers(spark, land=[land(raw.where(~early))], **chosen)
    rows = model_rows(spark, "4_marts", mart, prefix)
    return rows.drop("_loaded_at", "date_month", "date_year")


_ECONOMIC = (inputs.RAW_OBSERVATIONS, "raw_obs", inputs.OBSERVATION_ORDER, "series_id, date")


@query("layered_national_indicators", _layers_sql(*_ECONOMIC, _indicators, "date", _DAYS))
def layered_national(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_runs(spark, "economic", inputs.raw_observations(spark, sf_dir), "national_indicators", "economic_observations")


@query("layered_state_affordability", _layers_sql(*_ECONOMIC, _affordability, "state_fips, date", _YEARS))
def layered_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_runs(spark, "economic", inputs.raw_observations(spark, sf_dir), "state_affordability", "economic_observations")


@query(
    "layered_daily_weather",
    _layers_sql(
        inputs.RAW_WEATHER, "raw_weather", inputs.WEATHER_ORDER, "location_id, date", _metrics,
        "location_id, date", _DAYS,
    ),
)
def layered_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_runs(spark, "weather", inputs.raw_weather(spark, sf_dir), "daily_weather", "weather_metrics")


_GATE = (
    f"WITH {inputs.STAGED_WEATHER}, found AS (SELECT 'stg_warehouses.daily_weather' AS name, "
    "(SELECT count(*) FROM staged WHERE location_id IS NULL OR date IS NULL) AS nulls, "
    "(SELECT count(*) FROM (SELECT 1 FROM staged GROUP BY location_id, date HAVING count(*) > 1)) AS repeats "
    "UNION ALL SELECT 'lineitem', (SELECT count(*) FILTER (l_tax IS NULL) FROM lineitem), "
    "(SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))) "
    "SELECT name || ' not null' AS name, nulls AS violations, CASE WHEN nulls > 0 THEN 'fail' ELSE 'pass' END AS status "
    "FROM found UNION ALL SELECT name || ' unique', repeats, CASE WHEN repeats > 0 THEN 'fail' ELSE 'pass' END FROM found "
    "UNION ALL SELECT 'lineitem rule', n, CASE WHEN n > 0 THEN 'fail' ELSE 'pass' END "
    "FROM (SELECT count(*) AS n FROM lineitem WHERE NOT (l_discount < 0.09))"
)


@query("gate_summary", _GATE)
def gate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate's rules over the staged rows of a landed table, and over line items, which break some."""
    prefix = f"gate_{uuid.uuid4().hex}_"
    landed = RAW_TABLES["weather"]
    create_raw_tables(spark, prefix)
    append_rows(inputs.raw_weather(spark, sf_dir), layer_table_name("raw", landed.name, prefix), landed.schema)
    staged = model_rows(spark, "1_staging_warehouses", "daily_weather", prefix)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return check_rows(staged, "stg_warehouses.daily_weather", ["location_id", "date"], ["location_id", "date"]).unionByName(
        check_rows(lines, "lineitem", ["l_orderkey", "l_linenumber"], ["l_tax"], "l_discount < 0.09")
    )


# Every rule that the gate looks at on the way from landed weather to the mart, and the freshness of what landed.
_GATED = (
    "WITH rules(name) AS (VALUES ('stg_warehouses.daily_weather not null'), ('stg_warehouses.daily_weather unique'), "
    "('warehouses.daily_weather not null'), ('warehouses.daily_weather unique'), ('stg_marts.weather_metrics not null'), "
    "('stg_marts.weather_metrics unique'), ('marts.daily_weather not null'), ('marts.daily_weather unique')), "
    f"{inputs.RAW_WEATHER}, newest AS (SELECT max(extracted_at) AS last_seen FROM raw_weather), "
    "runs(run, now) AS (SELECT 1, (SELECT max(extracted_at) FROM raw_weather WHERE extracted_at <= "
    f"{_CUT}) + INTERVAL 1 DAY UNION ALL SELECT 2, last_seen + INTERVAL 8 DAY FROM newest) "
    "SELECT CAST(run AS INTEGER) AS run, name, CAST(0 AS BIGINT) AS violations FROM runs, rules WHERE run = 1 "
    "UNION ALL SELECT CAST(run AS INTEGER), 'raw.daily_weather freshness', CAST(CASE WHEN run = 2 THEN 1 ELSE 0 END AS BIGINT) FROM runs"
)


@query("gated_layers", _GATED)
def gated_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the gate sees in two runs: the first passes, the second is stopped as what landed is over a week old."""
    prefix = f"gated_{uuid.uuid4().hex}_"
    landed = RAW_TABLES["weather"]
    raw = inputs.raw_weather(spark, sf_dir)
    table = layer_table_name("raw", landed.name, prefix)
    early = F.col("extracted_at") <= F.lit(FIRST_RUN).cast("timestamp_ntz")
    create_raw_tables(spark, prefix)
    seen: list[tuple[int, str, int]] = []
    for run, part, days in ((1, early, 1), (2, ~early, 8)):
        append_rows(raw.where(part), table, landed.schema, cluster=[landed.key])
        newest = kept_watermarks(spark, table).agg(F.max("newest").cast("string")).first()[0]
        now = dt.datetime.fromisoformat(newest).replace(tzinfo=dt.timezone.utc) + dt.timedelta(days=days)
        gated: list[tuple[str, int]] = []
        with suppress(CheckFailed):
            run_layers(spark, sources=["weather"], gate=True, now=now, prefix=prefix, gated=gated)
        seen += [(run, name.replace(f"{prefix}", ""), violations) for name, violations in gated]
    return spark.createDataFrame(seen, "run int, name string, violations long")
