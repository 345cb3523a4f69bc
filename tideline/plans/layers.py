"""The layered job: five stages in a fixed order, stopping at the first failure."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.checks import WriteChecks, check_freshness, check_rows, summarise
from tideline.operators.incremental import incremental_tail, merge_upsert, with_load_time
from tideline.plans import models as layer_models
from tideline.plans.landing import ECONOMIC, RAW_TABLES, WEATHER
from tideline.plans.views import VIEWS
from tideline.sources.tables import (
    LAYERS,
    ensure_table,
    layer_table_name,
    partition_column,
    ref,
    store_view,
    view_name,
)
from tideline.sources.watermarks import kept_watermarks

# The spread may only be there when both yields are.
SPREAD_RULE = (
    "yield_curve_spread IS NULL OR (treasury_yield_10y IS NOT NULL AND treasury_yield_2y IS NOT NULL)"
)


@dataclass(frozen=True)
class Model:
    """One model: where it belongs, what it reads, and the rules its rows keep."""

    layer: str
    name: str
    source: str
    reads: tuple[str, str]
    transform: Callable[[DataFrame], DataFrame]
    keys: Sequence[str]
    not_null: Sequence[str]
    # Tables only: columns in order, partition unit and trailing window.
    columns: Sequence[str] = ()
    period: str = "month"
    cluster: Sequence[str] = ()
    days: int | None = None
    years: int | None = None
    rule: str | None = None

    @property
    def is_table(self) -> bool:
        return bool(self.columns)

    @property
    def by_key(self) -> list[str]:
        """What tells the model's series apart; nothing where each date has one row."""
        return [k for k in self.keys if k != "date"]


def _same(df: DataFrame) -> DataFrame:
    return df


_OBSERVATION_COLUMNS = layer_models.RAW_OBSERVATIONS.fieldNames()
_RAW, _STAGE, _WAREHOUSE, _MART_STAGE, _MART = LAYERS

MODELS = [
    Model(
        _STAGE, "economic_observations", ECONOMIC, (_RAW, "economic_observations"),
        layer_models.staged_observations,
        layer_models.OBSERVATION_KEYS, ["series_id", "date", "extracted_at"],
    ),
    Model(
        _STAGE, "daily_weather", WEATHER, (_RAW, "daily_weather"),
        layer_models.staged_weather, layer_models.WEATHER_KEYS, ["location_id", "date", "extracted_at"],
    ),
    Model(
        _WAREHOUSE, "economic_observations", ECONOMIC, (_STAGE, "economic_observations"),
        _same, layer_models.OBSERVATION_KEYS, ["series_id", "date", "extracted_at"],
        columns=_OBSERVATION_COLUMNS, cluster=["series_id"], days=90,
    ),
    Model(
        _WAREHOUSE, "daily_weather", WEATHER, (_STAGE, "daily_weather"),
        _same, layer_models.WEATHER_KEYS, ["location_id", "date", "extracted_at"],
        columns=layer_models.RAW_WEATHER.fieldNames(), cluster=["location_id"], days=90,
    ),
    Model(
        _MART_STAGE, "national_indicators", ECONOMIC, (_WAREHOUSE, "economic_observations"),
        layer_models.national_indicators, ["date"], ["date"],
    ),
    Model(
        _MART_STAGE, "state_affordability", ECONOMIC, (_WAREHOUSE, "economic_observations"),
        layer_models.state_affordability, layer_models.STATE_KEYS, ["state_fips", "date"],
    ),
    Model(
        _MART_STAGE, "weather_metrics", WEATHER, (_WAREHOUSE, "daily_weather"),
        layer_models.weather_metrics, layer_models.WEATHER_KEYS, ["location_id", "date"],
    ),
    Model(
        _MART, "national_indicators", ECONOMIC, (_MART_STAGE, "national_indicators"),
        _same, ["date"], ["date"],
        columns=layer_models.INDICATOR_FACT_COLUMNS, days=90, rule=SPREAD_RULE,
    ),
    Model(
        _MART, "state_affordability", ECONOMIC, (_MART_STAGE, "state_affordability"),
        _same, layer_models.STATE_KEYS, ["state_fips", "date"],
        columns=layer_models.STATE_FACT_COLUMNS,
        period="year", cluster=["state_fips"], years=3,
    ),
    Model(
        _MART, "daily_weather", WEATHER, (_MART_STAGE, "weather_metrics"),
        _same, layer_models.WEATHER_KEYS, ["location_id", "date"],
        columns=layer_models.WEATHER_FACT_COLUMNS, cluster=["location_id"], days=90,
    ),
]

class CheckFailed(RuntimeError):
    """A check of a layer found violations; later layers were not built."""


def create_raw_tables(spark: SparkSession, prefix: str = "", root: str | None = None) -> None:
    for raw in RAW_TABLES.values():
        name = layer_table_name("raw", raw.name, prefix)
        ensure_table(spark, name, raw.schema, "month", root=root, watermark_keys=[raw.key])


def model_rows(spark: SparkSession, layer: str, name: str, prefix: str = "") -> DataFrame:
    """What a model holds: a table's rows, or a view's plan over the tables below it."""
    found = next((m for m in MODELS if (m.layer, m.name) == (layer, name)), None)
    if found is None or found.is_table:
        return ref(spark, layer_table_name(layer, name, prefix))
    return found.transform(model_rows(spark, *found.reads, prefix))


def build_model(
    spark: SparkSession,
    model: Model,
    prefix: str = "",
    now: dt.datetime | None = None,
    scope: str = "global",
    root: str | None = None,
    checks: WriteChecks | None = None,
) -> list[dt.date]:
    """Build one model: a view, or the merge of its trailing window. Returns periods rewritten.

    A view is stored in the catalogue, where other sessions find it, and is a view of this session by another name.
    """
    name = layer_table_name(model.layer, model.name, prefix)
    if not model.is_table:
        store_view(spark, name, VIEWS[model.layer, model.name](layer_table_name(*model.reads, prefix)), root)
        model_rows(spark, model.layer, model.name, prefix).createOrReplaceTempView(view_name(name))
        return []
    rows = model.transform(model_rows(spark, *model.reads, prefix))
    types = {f.name: f.dataType for f in rows.schema.fields}
    fields = [T.StructField(c, types[c]) for c in model.columns]
    schema = T.StructType([*fields, T.StructField("_loaded_at", T.TimestampType())])
    ensure_table(spark, name, schema, model.period, root, model.by_key, "_loaded_at")
    tail = _tail(spark, model, rows, name, scope, prefix)
    # Ranked or grouped by the same keys further down, so the tail is unique.
    return merge_upsert(
        spark, name, with_load_time(tail, now), model.keys, cluster=model.cluster, unique_source=True, checks=checks
    )


def _tail(spark: SparkSession, model: Model, rows: DataFrame, target: str | None, scope: str, prefix: str) -> DataFrame:
    """The trailing window of ``rows`` that a table model takes."""
    below = next((m for m in MODELS if (m.layer, m.name) == model.reads), None)
    # One series is all there is: it can't lag behind another.
    scope = scope if model.by_key else "global"
    source_keys = None
    if scope == "per_key" and below and below.reads[0] == _RAW and below.by_key == model.by_key:
        source_keys = kept_watermarks(spark, layer_table_name(*below.reads, prefix))
    return incremental_tail(
        rows, target, days=model.days, years=model.years, scope=scope, keys=model.by_key, source_keys=source_keys
    )


def model_checks(spark: SparkSession, model: Model, prefix: str = "", scope: str | None = None) -> DataFrame:
    """``name, violations, status`` of the rules declared for a model.

    Of a view, ``scope`` leaves only the trailing window that the table above it takes; without it
    the whole model is read.
    """
    rows = model_rows(spark, model.layer, model.name, prefix)
    name = layer_table_name(model.layer, model.name, prefix)
    above = next((m for m in MODELS if m.is_table and m.reads == (model.layer, model.name)), None)
    if scope and above and not model.is_table:
        target = layer_table_name(above.layer, above.name, prefix)
        rows = _tail(spark, above, rows, target if spark.catalog.tableExists(target) else None, scope, prefix)
    return check_rows(rows, name, model.keys, model.not_null, model.rule)


def run_layers(
    spark: SparkSession,
    layers: Sequence[str] | None = None,
    sources: Sequence[str] | None = None,
    models: Sequence[str] | None = None,
    gate: bool = False,
    now: dt.datetime | None = None,
    prefix: str = "",
    scope: str = "global",
    root: str | None = None,
    land: Sequence[Callable[[SparkSession], None]] = (),
    gated: list[tuple[str, int]] | None = None,
) -> dict[str, list[dt.date]]:
    """Land new rows, then build the layers one after the other for the chosen sources or models.

    Returns the periods rewritten for each table.  With ``gate`` the raw tables'
    freshness and every layer's rules are checked before the next layer is built: a table's
    by the write that makes its periods, a view's over the window that the table above it
    will take. ``gated`` takes the (rule, violations) that the gate saw.
    """
    chosen = [
        m
        for m in MODELS
        if (sources is None or m.source in sources) and (models is None or m.name in models)
    ]
    create_raw_tables(spark, prefix, root)
    for step in land:
        step(spark)
    seen = [] if gated is None else gated
    if gate:
        _gate(_rows(summarise(raw_checks(spark, sources, prefix, now))), seen)
    rewritten: dict[str, list[dt.date]] = {}
    for layer in [x for x in LAYERS if layers is None or x in layers]:
        built = [m for m in chosen if m.layer == layer]
        found: list[tuple[str, int]] = []
        for model in built:
            name = layer_table_name(layer, model.name, prefix)
            checks = WriteChecks(name, model.keys, model.not_null, model.rule) if gate and model.is_table else None
            periods = build_model(spark, model, prefix, now, scope, root, checks)
            if model.is_table:
                rewritten[name] = periods
            if checks:
                table = spark.table(name)
                found += checks.found(table.where(F.col(partition_column(table)).isin(periods)) if periods else None)
            elif gate:
                found += _rows(model_checks(spark, model, prefix, scope))
        if gate:
            _gate(found, seen)
    return rewritten


def raw_checks(
    spark: SparkSession,
    sources: Sequence[str] | None = None,
    prefix: str = "",
    now: dt.datetime | None = None,
) -> dict[str, DataFrame]:
    """Freshness of the raw tables, from their kept watermarks."""
    named = {
        layer_table_name("raw", raw.name, prefix): source
        for source, raw in RAW_TABLES.items()
        if sources is None or source in sources
    }
    return {f"{t} freshness": check_freshness(kept_watermarks(spark, t), "newest", now=now) for t in named}


def _rows(summary: DataFrame) -> list[tuple[str, int]]:
    # One row per declared rule comes back, never the violating rows.
    return [(r["name"], r["violations"]) for r in summary.collect()]


def _gate(found: list[tuple[str, int]], seen: list[tuple[str, int]]) -> None:
    seen += found
    failed = [f"{name}: {violations}" for name, violations in found if violations]
    if failed:
        raise CheckFailed("; ".join(failed))
