"""Layouts that spare work: tails read from the smallest start on, stored views, buckets, recorded digests."""

from __future__ import annotations

import datetime as dt
import re
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.incremental import incremental_tail, merge_upsert, watermarks
from tideline.operators.latest import latest_per_key, top_n_per_key
from tideline.operators import versions
from tideline.operators.versions import next_versions
from tideline.plans.layers import MODELS, create_raw_tables, model_rows, run_layers
from tideline.plans.models import RAW_OBSERVATIONS, RAW_WEATHER
from tideline.plans import registry
from tideline.plans.registry import registry_table, sync_definitions
from tideline.session import shared_folder, subfolders
from tideline.sources.definitions import read_definitions
from tideline.sources.tables import append_rows, bucket_layout, ensure_table, layer_table_name, table_location

D, TS, UTC = dt.date, dt.datetime, dt.timezone.utc
FACT = T.StructType(
    [T.StructField("k", T.StringType()), T.StructField("date", T.DateType()), T.StructField("v", T.DoubleType())]
)


@pytest.fixture
def prefix():
    return f"t{uuid.uuid4().hex}_"


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# Tails by key


def unreadable(spark, table, before):
    """Break the files of the periods before a date."""
    from pathlib import Path
    from urllib.parse import urlparse

    broken = 0
    for file in spark.table(table).where(F.col("date_month") < F.lit(before)).inputFiles():
        path = Path(urlparse(file).path)
        path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
        path.write_bytes(b"unreadable")
        broken += 1
    spark.catalog.refreshTable(table)
    return broken


@pytest.mark.parametrize("by_name", [False, True])
def test_per_key_tail_reads_from_the_smallest_start_on(spark, prefix, by_name):
    source, target = f"{prefix}a.source", f"{prefix}a.target"
    ensure_table(spark, source, FACT, "month", watermark_keys=["k"], at_col="date")
    ensure_table(spark, target, FACT, "month", watermark_keys=["k"], at_col="date")
    data = [(k, D(2020 + y, m, 15), float(m)) for k in "abc" for y in range(3) for m in (1, 6, 12)]
    landed = spark.createDataFrame(data, FACT)
    append_rows(landed, source, FACT)
    # a is loaded up to the end of 2022, b up to its June.
    loaded = landed.where("k = 'a' OR (k = 'b' AND date < '2022-07-01') OR k = 'c'")
    merge_upsert(spark, target, loaded, ["k", "date"])
    want = [r for r in data if r[1] >= {"a": D(2022, 9, 16), "b": D(2022, 3, 17), "c": D(2022, 9, 16)}[r[0]]]
    assert unreadable(spark, source, D(2022, 3, 1)) > 0
    known = spark.table(source).where("date_month >= '2022-03-01'").select("k").distinct()
    tail = incremental_tail(
        spark.table(source), target if by_name else spark.table(target), days=90, scope="per_key", keys=["k"], source_keys=known
    )
    assert rows(tail, "k", "date", "v") == sorted(want, key=repr)


def test_per_key_tail_takes_new_keys_in_full(spark, prefix):
    source, target = f"{prefix}a.source", f"{prefix}a.target"
    ensure_table(spark, source, FACT, "month")
    ensure_table(spark, target, FACT, "month", watermark_keys=["k"], at_col="date")
    data = [(k, D(2020, m, 15), float(m)) for k in "an" for m in (1, 6, 12)]
    append_rows(spark.createDataFrame(data, FACT), source, FACT)
    merge_upsert(spark, target, spark.createDataFrame(data[:3], FACT), ["k", "date"])
    tail = incremental_tail(spark.table(source), target, days=90, scope="per_key", keys=["k"])
    assert rows(tail, "k", "date") == sorted([("a", D(2020, 12, 15))] + [r[:2] for r in data[3:]], key=repr)
    # Kept watermarks of the merged table are those of its rows.
    plain = incremental_tail(spark.table(source), spark.table(target), days=90, scope="per_key", keys=["k"])
    assert rows(plain) == rows(tail)
    nothing = incremental_tail(spark.table(source).where("false"), target, days=90, scope="per_key", keys=["k"])
    assert nothing.isEmpty()


# Views in the catalogue


def test_views_are_read_by_another_session(spark, prefix):
    create_raw_tables(spark, prefix)
    now = TS(2024, 1, 2, tzinfo=UTC)
    at = TS(2024, 1, 1, tzinfo=UTC)
    series = [
        ("DGS10", D(2023, 12, 1), 4.0), ("DGS2", D(2023, 12, 1), 3.0), ("MSPUS", D(2023, 12, 1), 4160.0),
        ("AHETPI", D(2023, 12, 1), 1.0), ("AHETPI", D(2023, 12, 2), 0.0), ("MSPUS", D(2023, 12, 2), 1.0),
        ("ATNHPIUS06000A", D(2023, 1, 1), 200.0), ("ENUC0640010SA", D(2023, 1, 1), 0.0), ("ENUC0640010SA", D(2023, 4, 1), 60.0),
        ("ATNHPIUS07A", D(2023, 1, 1), 1.0), ("xATNHPIUS06000A", D(2023, 1, 1), 1.0), ("ATNHPIUS06000A\n", D(2023, 1, 1), 9.0),
        ("UNRATE", D(2023, 11, 1), None), ("MSPUS", D(2023, 12, 3), 1e308), ("AHETPI", D(2023, 12, 3), 1e-300),
    ]
    revised = [("DGS2", D(2023, 12, 1), 3.5, at + dt.timedelta(hours=1)), ("DGS2", D(2023, 12, 1), None, at)]
    append_rows(
        spark.createDataFrame([(*s, at) for s in series] + revised, RAW_OBSERVATIONS),
        f"{prefix}raw.economic_observations", RAW_OBSERVATIONS,
    )
    place = ("london", "London", "GB", 51.5, -0.1)
    weather = [(*place, D(2023, 12, d), 9.0 + d, None if d == 2 else 2.0, 0.0, 10.0, at + dt.timedelta(hours=h)) for d in (1, 2) for h in (0, 1)]
    append_rows(spark.createDataFrame(weather, RAW_WEATHER), f"{prefix}raw.daily_weather", RAW_WEATHER)
    run_layers(spark, now=now, prefix=prefix, gate=True)
    other = spark.newSession()
    views = [m for m in MODELS if not m.is_table]
    assert len(views) == 5
    for model in views:
        name = layer_table_name(model.layer, model.name, prefix)
        stored, planned = other.table(name), model_rows(spark, model.layer, model.name, prefix)
        assert stored.dtypes == planned.dtypes, name
        assert rows(stored) == rows(planned) != [], name


# Buckets


def bucketed(spark, table, buckets=5):
    ensure_table(spark, table, FACT, "month", bucket_by=["k", "date"], buckets=buckets)


def test_no_shuffle_over_a_bucketed_table(spark, prefix):
    table = f"{prefix}a.facts"
    bucketed(spark, table)
    assert bucket_layout(spark, table) == (5, ["k", "date"])
    for run in range(3):
        data = [(f"k{i % 7}", D(2024, 1 + i % 3, 1 + i % 9), float(run * 100 + i)) for i in range(200)]
        append_rows(spark.createDataFrame(data, FACT), table, FACT)
    plain = f"{prefix}a.plain"
    ensure_table(spark, plain, FACT, "month")
    append_rows(spark.table(table), plain, FACT)
    latest = latest_per_key(spark.table(table).drop("date_month"), ["k", "date"], "v")
    want = latest_per_key(spark.table(plain).drop("date_month"), ["k", "date"], "v")
    assert rows(latest) == rows(want)
    assert "Exchange" not in plan_of(latest) and "Exchange" in plan_of(want)
    files = spark.table(table).inputFiles()
    assert len(files) <= 3 * 3 * 5 and all(re.search(r"_0000[0-4]\.c000", f) for f in files)
    # By a part of the key the counts of each task still meet, one row for each key.
    marks = watermarks(spark.table(table), "k", "date")
    assert rows(marks) == rows(watermarks(spark.table(plain), "k", "date"))


def test_merges_keep_the_buckets(spark, prefix):
    table = f"{prefix}a.facts"
    bucketed(spark, table)
    old = [(f"k{i}", D(2024, 1 + i % 2, 1), 0.0) for i in range(20)]
    merge_upsert(spark, table, spark.createDataFrame(old, FACT), ["k", "date"])
    new = [(f"k{i}", D(2024, 1, 1), 1.0) for i in range(0, 30, 2)]
    merge_upsert(spark, table, spark.createDataFrame(new, FACT), ["k", "date"])
    want = {(k, d): v for k, d, v in old} | {(k, d): v for k, d, v in new}
    assert rows(spark.table(table), "k", "date", "v") == sorted(((*k, v) for k, v in want.items()), key=repr)
    latest = latest_per_key(spark.table(table), ["k", "date"], "v")
    assert "Exchange" not in plan_of(latest) and latest.count() == len(want)
    # Joined to a side that is not bucketed, only that side is dealt anew.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        side = spark.createDataFrame(new, FACT)
        kept = spark.table(table).join(side.select("k", "date"), ["k", "date"], "left_anti")
        assert plan_of(kept).count("Exchange hashpartitioning") == 1
        assert kept.count() == len(want) - len(new)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.sql(f"DROP TABLE {table}")
    bucketed(spark, table)
    assert rows(spark.table(table), "k", "date", "v") == sorted(((*k, v) for k, v in want.items()), key=repr)


# Digests


def test_a_sync_reads_no_recorded_text(spark, prefix):
    files = spark.createDataFrame(
        [("agent", "a", "one", None), ("agent", "b", "two", None), ("skill", "a", "three", None), ("skill", "x", None, "bad")],
        "kind string, name string, content string, error string",
    )
    folder = f"{shared_folder(spark)}/tideline"
    before = set(subfolders(spark, folder))
    assert rows(sync_definitions(spark, files, prefix)) == [("agent", 2, 2, 0), ("skill", 2, 1, 1)]
    assert rows(sync_definitions(spark, files, prefix)) == [("agent", 2, 0, 0), ("skill", 2, 0, 1)]
    left = set(subfolders(spark, folder)) - before
    assert not [n for n in left if n.startswith(("definitions-", "changed-"))]
    history = spark.table(registry_table("agent", prefix))
    assert rows(history, "name", "content_sha256") == rows(history.select("name", F.sha2("content", 256)))
    later = files.withColumn("content", F.when(F.col("name") == "a", "changed").otherwise(F.col("content")))
    found = next_versions(later.where("kind = 'agent'").select("name", "content"), history)
    scans = [line for line in plan_of(found).splitlines() if "FileScan" in line and "agent_snapshots" in line]
    assert scans and not [s for s in scans if re.search(r"\bcontent#|content:", s)], "no text of the history is scanned"
    assert rows(found, "name", "version") == [("a", 2)]


def test_texts_are_not_put_in_order(spark, prefix, monkeypatch):
    seen = []

    def watched(module, name):
        call = getattr(module, name)

        def run(df, *args):
            seen.append((name, "content" in df.columns))
            return call(df, *args)

        monkeypatch.setattr(module, name, run)

    watched(versions, "split_groups")
    watched(versions, "materialise")
    watched(registry, "materialise")
    files = spark.createDataFrame([("agent", f"a{i}", f"text {i}", None) for i in range(9)], "kind string, name string, content string, error string")
    for appended in (9, 3):
        seen.clear()
        later = F.when(F.col("name") < "a3", F.concat("content", F.lit("more"))).otherwise(F.col("content"))
        batch = files if appended == 9 else files.withColumn("content", later)
        assert rows(sync_definitions(spark, batch, prefix))[0] == ("agent", 9, appended, 0)
        assert sorted(set(seen)) == [("materialise", False), ("materialise", True), ("split_groups", False)]
        assert seen.count(("materialise", True)) == 1, "texts are written once, beside the table"
    found = rows(spark.table(registry_table("agent", prefix)), "name", "version", "content")
    want = [(f"a{i}", 1, f"text {i}") for i in range(9)] + [(f"a{i}", 2, f"text {i}more") for i in range(3)]
    assert found == sorted(want, key=repr)


def test_loads_without_an_order_are_an_error(spark, prefix):
    history = spark.createDataFrame([], "name string, content string, version long, snapshotted_at timestamp")
    loads = spark.createDataFrame([("a", c, i) for i, c in enumerate(("x", "y", "x"))], "name string, content string, at long")
    with pytest.raises(ValueError, match="no order"):
        next_versions(loads, history)
    assert rows(next_versions(loads, history, order_by=["at"]), "at", "version") == [(0, 1), (1, 2), (2, 3)]
    same = spark.createDataFrame([("a", "x"), ("a", "x")], "name string, content string")
    assert rows(next_versions(same, history), "name", "version") == [("a", 1)]


def test_hidden_files_that_are_no_text_have_their_error(spark, tmp_path):
    folder = tmp_path / ".claude" / "agents"
    folder.mkdir(parents=True)
    for name in ("bad.md", "_bad.md", ".bad.md"):
        (folder / name).write_bytes(b"ab\xff\xfecd")
    (folder / "_good.md").write_bytes("é\r\nx".encode())
    found = {r.path.rsplit("/", 1)[1]: (r.content, r.error) for r in read_definitions(spark, str(tmp_path)).collect()}
    assert found["_good.md"] == ("é\nx", None)
    assert {found[n] for n in ("bad.md", "_bad.md", ".bad.md") if n in found} == {(None, "not valid UTF-8")} and len(found) >= 3


def test_a_hot_key_of_one_time_is_parted(spark):
    df = spark.range(0, 5000).select(F.lit("hot").alias("k"), F.lit(D(2024, 1, 1)).alias("at"), "id")
    found = top_n_per_key(df, ["k"], "at", 3)
    assert found.count() == 3
    salted = [line for line in plan_of(found).splitlines() if "xxhash64(" in line]
    assert salted and "id#" in salted[0]
    assert rows(top_n_per_key(df, ["k"], "at", 3, ["id"]), "id") == [(4997,), (4998,), (4999,)]
