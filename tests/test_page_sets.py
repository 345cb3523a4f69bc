"""Page sets that arrive over several micro-batches."""

from __future__ import annotations

import datetime as dt
import json
import random
import uuid

import pytest

from tideline.plans.layers import create_raw_tables
from tideline.plans.models import RAW_OBSERVATIONS
from tideline.session import new_folder
from tideline.streaming import landing
from tideline.streaming.landing import OBSERVATION_PAGES, append_once, missing_rows
from tideline.streaming.page_sets import land_page_sets, whole_sets

D, TS, UTC = dt.date, dt.datetime, dt.timezone.utc


def at(hour):
    return TS(2024, 1, 1, hour, tzinfo=UTC)


@pytest.fixture
def stream(spark):
    """Captures arrive, a run lands what is whole: ``arrive(pages...)`` and ``held()``."""
    prefix = f"t{uuid.uuid4().hex}_"
    create_raw_tables(spark, prefix)
    table = f"{prefix}raw.economic_observations"
    captures, checkpoint = new_folder(spark, "captures"), new_folder(spark, "checkpoint")

    class Stream:
        name, place = table, checkpoint

        def arrive(self, *pages, **options):
            data = []
            for series, offset, size, hour in pages:
                items = [{"date": str(D(2024, 1, 1) + dt.timedelta(days=offset + k)), "value": str(hour)} for k in range(size)]
                data.append((series, offset, json.dumps({"observations": items}), at(hour)))
            if data:
                spark.createDataFrame(data, OBSERVATION_PAGES).coalesce(1).write.mode("append").parquet(captures)
            land_page_sets(spark, captures, table, RAW_OBSERVATIONS, page_limit=3, checkpoint=checkpoint, **options)

        def held(self):
            rows = spark.table(table).groupBy("series_id").agg({"*": "count", "value": "sum"}).collect()
            return {r[0]: (r["count(1)"], r["sum(value)"]) for r in rows}

    return Stream()


def test_a_set_over_three_batches_lands_once_and_whole(stream):
    stream.arrive(("a", 0, 3, 1), ("b", 0, 2, 1))
    assert stream.held() == {"b": (2, 2.0)}
    stream.arrive(("a", 6, 1, 1))
    assert stream.held() == {"b": (2, 2.0)}, "a page is missing in the middle"
    stream.arrive(("a", 3, 3, 1))
    assert stream.held() == {"a": (7, 7.0), "b": (2, 2.0)}
    stream.arrive()
    assert stream.held()["a"] == (7, 7.0)
    # The next extraction is a set of its own.
    stream.arrive(("a", 0, 3, 5))
    assert stream.held()["a"] == (7, 7.0)
    stream.arrive(("a", 3, 0, 5))
    assert stream.held()["a"] == (10, 22.0)


def test_later_captures_and_broken_off_runs(stream):
    stream.arrive(("a", 0, 3, 1), ("a", 0, 3, 2), ("c", 3, 1, 1))
    stream.arrive(("a", 3, 2, 2))
    assert stream.held() == {"a": (5, 10.0)}, "the later capture of a page counts"
    # c's first run lost its first page; the second run's first page does not complete the old one.
    stream.arrive(("c", 0, 3, 4))
    assert "c" not in stream.held()
    stream.arrive(("c", 3, 3, 4))
    stream.arrive(("c", 6, 2, 4))
    assert stream.held()["c"] == (8, 32.0)


def test_files_one_by_one(stream):
    for page in (("a", 6, 1, 1), ("a", 0, 3, 1), ("a", 3, 3, 1)):
        stream.arrive(page, max_files=1)
    assert stream.held() == {"a": (7, 7.0)}


@pytest.mark.parametrize("dies", ["before", "after"])
def test_a_batch_that_is_run_again_appends_nothing_twice(spark, stream, monkeypatch, dies):
    append = landing.append_rows
    calls = []

    def fail(*args, **options):
        calls.append(args)
        if dies == "after":
            append(*args, **options)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m, pytest.raises(Exception, match="driver lost"):
        m.setattr(landing, "append_rows", fail)
        stream.arrive(("a", 0, 2, 1), ("b", 0, 1, 1))
    assert calls
    spark.catalog.refreshTable(stream.name)
    assert bool(stream.held()) == (dies == "after")
    stream.arrive()
    assert stream.held() == {"a": (2, 2.0), "b": (1, 1.0)}
    stream.arrive()
    assert stream.held() == {"a": (2, 2.0), "b": (1, 1.0)}


def test_a_batch_number_is_appended_once(spark, stream):
    rows = spark.createDataFrame([("x", D(2024, 1, 1), None, at(1)), ("x", D(2024, 1, 1), None, at(1))], RAW_OBSERVATIONS)
    for _ in range(2):
        append_once(rows, 7, stream.place, stream.name, RAW_OBSERVATIONS)
    assert spark.table(stream.name).count() == 2
    append_once(rows, 8, stream.place, stream.name, RAW_OBSERVATIONS)
    assert spark.table(stream.name).count() == 4


def test_missing_rows_count_copies(spark, stream):
    one, other = ("x", D(2024, 1, 1), None, at(1)), ("y", D(2024, 2, 1), 1.0, at(2))
    append_once(spark.createDataFrame([one], RAW_OBSERVATIONS), 0, stream.place, stream.name, RAW_OBSERVATIONS)
    rows = spark.createDataFrame([one, one, one, other], RAW_OBSERVATIONS)
    found = missing_rows(rows, spark.table(stream.name)).collect()
    assert sorted(r.series_id for r in found) == ["x", "x", "y"]
    assert missing_rows(rows.limit(0), spark.table(stream.name)).isEmpty()


def one_by_one(pages, limit):
    """The pages of a key that count, and whether they are whole, taken one after another."""
    held = {}
    for offset, at, size, payload in pages:
        old = held.get(offset)
        if old is None or (at, payload or "") > (old[0], old[2] or ""):
            held[offset] = at, size, payload
    newest = None
    for offset in sorted(held):
        if newest is not None and held[offset][0] < newest:
            del held[offset]
        else:
            newest = held[offset][0]
    order = sorted(held)
    sizes = [held[k][1] for k in order]
    whole = order == [k * limit for k in range(len(order))] and min(sizes[:-1], default=limit) >= limit and sizes[-1] < limit
    return [(k, *held[k], whole) for k in order]


def test_sets_of_random_pages(spark):
    rng = random.Random(3)
    pages = []
    for key in [None, *(str(k) for k in range(400))]:
        for _ in range(rng.randint(1, 6)):
            size = rng.choice((0, 1, 3, 3, 3, 4))
            payload = rng.choice((None, "", "a", "b\U0001f600", "b\uffee")) if size == 0 else f"{size}{rng.choice('ab')}"
            pages.append((key, rng.choice((0, 0, 3, 3, 6, 6, 9, -3, 4)), rng.randint(1, 3), size, payload))
    df = spark.createDataFrame(pages, "series_id string, page_offset long, at long, size long, payload string")
    found = whole_sets(df.repartition(3), "series_id", page_limit=3)
    got = sorted((str(r[0]), r[1], r[2], r[3], r[4] or "", r[5]) for r in found.collect())
    want = []
    for key in {p[0] for p in pages}:
        counted = one_by_one([p[1:] for p in pages if p[0] == key], 3)
        want += [(str(key), k, at, size, payload or "", whole) for k, at, size, payload, whole in counted]
    assert got == sorted(want)
    assert {True, False} == {w[-1] for w in want}
    plan = whole_sets(df, "series_id", page_limit=3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan and "Pandas" not in plan


def test_a_batch_that_is_run_again_keeps_what_waits(spark, stream, monkeypatch):
    stream.arrive(("a", 0, 3, 1), ("c", 0, 3, 1))
    with monkeypatch.context() as m, pytest.raises(Exception, match="driver lost"):
        m.setattr(landing, "append_rows", lambda *args, **options: (_ for _ in ()).throw(RuntimeError("driver lost")))
        stream.arrive(("a", 3, 1, 1), ("b", 0, 3, 1))
    stream.arrive()
    assert stream.held() == {"a": (4, 4.0)}
    stream.arrive(("b", 3, 2, 1), ("c", 3, 0, 1))
    assert stream.held() == {"a": (4, 4.0), "b": (5, 5.0), "c": (3, 3.0)}
    with pytest.raises(Exception, match="page_offset"):
        stream.arrive(("d", 0, 1, 1), ("d", None, 0, 1))
