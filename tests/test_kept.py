"""State kept beside tables: commit marks of replaced periods, watermarks, rules counted by the write."""

from __future__ import annotations

import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.checks import WriteChecks, check_rows
from tideline.operators.incremental import merge_upsert, plan_requests, watermarks
from tideline.plans.landing import NothingLanded, land_pages, request_plan
from tideline.plans.layers import CheckFailed, create_raw_tables, run_layers
from tideline.plans.models import RAW_OBSERVATIONS
from tideline.session import children, shared_folder, subfolders
from tideline.sources import tables, watermarks as kept
from tideline.sources.dimensions import series_catalog
from tideline.sources.tables import append_rows, ensure_table, table_location

D, TS, UTC = dt.date, dt.datetime, dt.timezone.utc
FACT = T.StructType(
    [T.StructField("k", T.StringType()), T.StructField("date", T.DateType()), T.StructField("v", T.DoubleType())]
)


@pytest.fixture
def prefix():
    return f"t{uuid.uuid4().hex}_"


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def facts(spark, *data):
    return spark.createDataFrame(list(data), FACT)


# Commit marks


def found_again(spark, table):
    """The table as a new catalogue finds it."""
    spark.sql(f"DROP TABLE {table}")
    ensure_table(spark, table, FACT, "month")
    return spark.table(table)


def swap(spark, table, name, data, finished):
    """What a merge leaves that died after it wrote some or all of its rows."""
    folder = f"{table_location(spark, table)}/{name}"
    write = facts(spark, *data).withColumn("date_month", F.trunc("date", "month")).write.partitionBy("date_month")
    write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", str(finished).lower()).parquet(folder)
    return folder


@pytest.mark.parametrize("merged", [False, True])
def test_a_half_written_merge_never_counts(spark, prefix, merged):
    table = f"{prefix}wh.facts"
    ensure_table(spark, table, FACT, "month")
    whole = [(f"k{i}", D(2024, 1, 1 + i), float(i)) for i in range(20)]
    if merged:
        merge_upsert(spark, table, facts(spark, *whole), ["k", "date"])
    else:
        append_rows(facts(spark, *whole), table, FACT)
    folder = swap(spark, table, ".swap-09999999999999999999-x", whole[:1], finished=False)
    assert spark.table(table).count() == 20
    assert found_again(spark, table).count() == 20
    assert children(spark, folder), "a reader removes nothing"
    merge_upsert(spark, table, facts(spark, ("new", D(2024, 1, 30), 1.0)), ["k", "date"])
    assert children(spark, folder) == []
    assert found_again(spark, table).count() == 21


@pytest.mark.parametrize("new_catalogue", [False, True])
def test_a_finished_merge_that_was_not_pointed_at_is_taken_up(spark, prefix, new_catalogue):
    table = f"{prefix}wh.facts"
    ensure_table(spark, table, FACT, "month")
    merge_upsert(spark, table, facts(spark, ("a", D(2024, 1, 1), 1.0), ("b", D(2024, 2, 1), 1.0)), ["k", "date"])
    swap(spark, table, ".swap-09999999999999999998-x", [("a", D(2024, 1, 1), 2.0), ("c", D(2024, 3, 1), 2.0)], finished=True)
    assert rows(spark.table(table), "k", "v") == [("a", 1.0), ("b", 1.0)]
    if new_catalogue:
        found_again(spark, table)
    else:
        merge_upsert(spark, table, facts(spark), ["k", "date"])
    assert rows(spark.table(table), "k", "v") == [("a", 2.0), ("b", 1.0), ("c", 2.0)]
    merge_upsert(spark, table, facts(spark, ("c", D(2024, 3, 1), 3.0)), ["k", "date"])
    assert rows(found_again(spark, table), "k", "v") == [("a", 2.0), ("b", 1.0), ("c", 3.0)]


def test_merges_leave_one_folder_for_each_period(spark, prefix):
    table = f"{prefix}wh.facts"
    ensure_table(spark, table, FACT, "month")
    for run in range(4):
        data = [(f"k{i}", D(2024, m, 1), float(run)) for i in range(3) for m in (1, 2, run + 3)]
        merge_upsert(spark, table, facts(spark, *data), ["k", "date"])
    location = table_location(spark, table)
    held = [p for s in subfolders(spark, location) for p in ([s] if "=" in s else subfolders(spark, f"{location}/{s}"))]
    assert len(held) == len(set(held)) == 6
    assert {r.v for r in spark.table(table).where("month(date) <= 2").collect()} == {3.0}


def test_new_periods_take_one_catalogue_statement(spark, prefix, monkeypatch):
    table = f"{prefix}wh.facts"
    ensure_table(spark, table, FACT, "month")
    said = []
    sql = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **b: (said.append(text), sql(self, text, *a, **b))[1])
    merge_upsert(spark, table, facts(spark, *[("a", D(2020 + m // 12, m % 12 + 1, 1), 1.0) for m in range(30)]), ["k", "date"])
    assert len([x for x in said if x.startswith("ALTER")]) == 1


# Watermarks


def captured(spark, *sets):
    payload = {k: [{"date": str(D(2024, 1, 1) + dt.timedelta(days=i)), "value": "1"} for i in range(n)] for k, n in sets}
    return spark.createDataFrame(
        [(k, 0, json.dumps({"observations": p}), TS(2024, 2, 1, tzinfo=UTC)) for k, p in payload.items()],
        "series_id string, page_offset long, payload string, extracted_at timestamp",
    )


def scanned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_watermarks_follow_the_table(spark, prefix):
    create_raw_tables(spark, prefix)
    table = f"{prefix}raw.economic_observations"
    assert kept.kept_watermarks(spark, table).isEmpty()
    for sets in ([("DGS2", 3), ("DGS10", 1)], [("DGS2", 2), ("GDP", 5), ("UNLISTED", 1)], [("DGS10", 9)]):
        land_pages(spark, "economic", captured(spark, *sets), prefix=prefix)
        want = watermarks(spark.table(table), "series_id", "date")
        assert rows(kept.kept_watermarks(spark, table), "series_id", "max_date") == rows(want)
        plan = request_plan(spark, "economic", prefix)
        assert rows(plan) == rows(plan_requests(series_catalog(spark), want, "series_id"))
    files = plan.inputFiles()
    assert files and all("/.watermarks/" in f for f in files), "the plan does not read the raw table"
    # Rows that come in by another way than the job are known as well.
    one = spark.createDataFrame([("GDP", D(2025, 1, 1), 1.0, TS(2025, 1, 2, tzinfo=UTC))], RAW_OBSERVATIONS)
    append_rows(one, table, RAW_OBSERVATIONS)
    assert kept.kept_watermarks(spark, table).where("series_id = 'GDP'").first()["max_date"] == D(2025, 1, 1)


@pytest.mark.parametrize("lost", ["end_append", "insert_rows"])
def test_a_lost_update_is_worked_out_again(spark, prefix, monkeypatch, lost):
    create_raw_tables(spark, prefix)
    table = f"{prefix}raw.economic_observations"
    land_pages(spark, "economic", captured(spark, ("DGS2", 2)), prefix=prefix)
    kept.kept_watermarks(spark, table).collect()

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
        m.setattr(tables, lost, die)
        land_pages(spark, "economic", captured(spark, ("DGS2", 7), ("GDP", 1)), prefix=prefix)
    spark.catalog.refreshTable(table)
    want = rows(watermarks(spark.table(table), "series_id", "date"))
    assert len(want) == (2 if lost == "end_append" else 1)
    assert rows(kept.kept_watermarks(spark, table), "series_id", "max_date") == want
    folder = f"{table_location(spark, table)}/.watermarks"
    assert not [n for n in children(spark, folder) if "pending" in n]


def test_an_unfinished_state_does_not_count(spark, prefix):
    create_raw_tables(spark, prefix)
    table = f"{prefix}raw.economic_observations"
    land_pages(spark, "economic", captured(spark, ("DGS2", 2)), prefix=prefix)
    before = rows(kept.kept_watermarks(spark, table))
    state = kept.kept_watermarks(spark, table).withColumn("max_date", F.lit(D(2099, 1, 1)))
    broken = f"{table_location(spark, table)}/.watermarks/state-99999999999999999999-x"
    state.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(broken)
    assert rows(kept.kept_watermarks(spark, table)) == before


def test_a_landing_leaves_no_intermediates(spark, prefix):
    create_raw_tables(spark, prefix)
    folder = f"{shared_folder(spark)}/tideline"
    before = set(subfolders(spark, folder))
    land_pages(spark, "economic", captured(spark, ("DGS2", 2)), prefix=prefix)
    with pytest.raises(NothingLanded):
        land_pages(spark, "economic", captured(spark, ("DGS2", 0)), captured(spark, ("GDP", 0)).select("series_id"), prefix)
    left = set(subfolders(spark, folder)) - before
    assert all(n.startswith("report-") for n in left) and len(left) == 2, "the caller reads the report"


# The gate


def test_write_checks_count_what_the_write_sees(spark, prefix):
    table = f"{prefix}wh.facts"
    ensure_table(spark, table, FACT, "month")
    data = [("a", D(2024, 1, 1), None), ("b", D(2024, 1, 1), -1.0), ("c", D(2024, 2, 1), 1.0)]
    checks = WriteChecks("facts", ["k", "date"], ["v"], "v >= 0")
    periods = merge_upsert(spark, table, facts(spark, *data), ["k", "date"], checks=checks)
    found = checks.found(spark.table(table).where(F.col("date_month").isin(periods)))
    assert found == [tuple(r)[:2] for r in check_rows(spark.table(table), "facts", ["k", "date"], ["v"], "v >= 0").collect()]
    assert found == [("facts not null", 1), ("facts unique", 0), ("facts rule", 1)]
    # A period that is written again is counted whole, one that is not is left out.
    again = WriteChecks("facts", ["k", "date"], ["v"], "v >= 0")
    periods = merge_upsert(spark, table, facts(spark, ("d", D(2024, 2, 2), None)), ["k", "date"], checks=again)
    assert again.found(spark.table(table).where(F.col("date_month").isin(periods))) == [
        ("facts not null", 1), ("facts unique", 0), ("facts rule", 0),
    ]
    # Rows that came in twice by another way are found in the periods that are written.
    append_rows(facts(spark, ("d", D(2024, 2, 2), None)), table, FACT)
    assert again.found(spark.table(table))[1] == ("facts unique", 1)
    idle = WriteChecks("facts", ["k", "date"], ["v"])
    assert merge_upsert(spark, table, facts(spark), ["k", "date"], checks=idle) == []
    assert idle.found(None) == [("facts not null", 0), ("facts unique", 0)]


def observations(spark, *data):
    return spark.createDataFrame([(*d, TS(2024, 1, 1, tzinfo=UTC)) for d in data], RAW_OBSERVATIONS)


def test_the_gate_reads_no_old_period(spark, prefix, tmp_path):
    """Old periods' files are made unreadable; a run with the gate goes through all the same."""
    root = str(tmp_path)
    create_raw_tables(spark, prefix, root)
    raw = f"{prefix}raw.economic_observations"
    old = [("DGS10", D(2015, 1, 1 + i), 1.0) for i in range(5)] + [("DGS2", D(2015, 2, 1), 2.0)]
    append_rows(observations(spark, *old, ("DGS10", D(2023, 12, 1), 4.0)), raw, RAW_OBSERVATIONS)
    chosen = {"sources": ["economic"], "models": ["economic_observations", "national_indicators"], "prefix": prefix, "root": root}
    run_layers(spark, gate=True, now=TS(2024, 1, 2, tzinfo=UTC), **chosen)
    broken = [f for f in tmp_path.rglob("*.parquet") if "=2015-0" in str(f)]
    assert len(broken) >= 6
    for file in broken:
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
        file.write_bytes(b"unreadable")
    append_rows(observations(spark, ("DGS2", D(2023, 12, 2), 3.0)), raw, RAW_OBSERVATIONS)
    for name in ("raw", "warehouses"):
        spark.catalog.refreshTable(f"{prefix}{name}.economic_observations")
    gated: list = []
    run_layers(spark, gate=True, now=TS(2024, 1, 2, tzinfo=UTC), gated=gated, **chosen)
    assert len(gated) == 10 and all(n == 0 for _, n in gated)
    mart = spark.table(f"{prefix}marts.national_indicators").where("date_month >= '2023-01-01'")
    assert rows(mart, "date", "treasury_yield_2y") == [(D(2023, 12, 1), None), (D(2023, 12, 2), 3.0)]
    with pytest.raises(Exception, match="is not a Parquet file|FAILED_READ_FILE"):
        spark.table(raw).collect()


def test_a_rule_that_is_broken_stops_before_the_next_layer(spark, prefix, monkeypatch):
    from dataclasses import replace

    from tideline.plans import layers

    strict = [replace(m, rule="value < 5") if (m.layer, m.name) == ("2_warehouses", "economic_observations") else m for m in layers.MODELS]
    monkeypatch.setattr(layers, "MODELS", strict)
    create_raw_tables(spark, prefix)
    append_rows(observations(spark, ("DGS10", D(2023, 12, 1), 9.0)), f"{prefix}raw.economic_observations", RAW_OBSERVATIONS)
    with pytest.raises(CheckFailed, match="warehouses.economic_observations rule: 1"):
        run_layers(spark, sources=["economic"], gate=True, now=TS(2024, 1, 2, tzinfo=UTC), prefix=prefix)
    assert not spark.catalog.tableExists(f"{prefix}marts.national_indicators")
