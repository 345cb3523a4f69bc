"""Operators on hand-made rows: ties, boundaries, empty targets, hot keys."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tideline.operators.checks import (
    check_expression,
    check_freshness,
    check_not_null,
    check_unique,
    summarise,
)
from tideline.operators.incremental import incremental_tail, lagged_end, merged_view, plan_requests, watermarks
from tideline.operators.latest import latest_per_key, top_n_per_key
from tideline.operators.ordering import CHUNK, number_rows, previous_row, split_groups
from tideline.operators.report import empty_keys, key_lists, run_report, run_verdict
from tideline.operators.reshape import pivot_conditional, spine_join, spine_pivot
from tideline.operators.versions import diff_last_two, line_changes, next_versions, version_history, version_pairs

D = dt.date
T = dt.datetime


@pytest.fixture
def small_chunks(spark):
    """Chunks as many as shuffle partitions, however few rows there are."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def test_latest_keeps_later_revision_and_drops_null_keys(spark):
    df = spark.createDataFrame(
        [
            ("a", D(2024, 1, 1), 1.0, T(2024, 1, 2)),
            ("a", D(2024, 1, 1), 2.0, T(2024, 1, 3)),
            ("a", D(2024, 1, 2), 3.0, T(2024, 1, 1)),
            (None, D(2024, 1, 1), 4.0, T(2024, 1, 1)),
            ("b", None, 5.0, T(2024, 1, 1)),
        ],
        "k string, date date, v double, at timestamp",
    )
    assert rows(latest_per_key(df, ["k", "date"], "at"), "k", "v") == [("a", 2.0), ("a", 3.0)]


def test_ties_are_settled_by_the_tie_break(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 1, 9), ("a", 1, 7)], "k string, at int, id int")
    assert rows(latest_per_key(df, ["k"], "at", ["id"])) == [("a", 1, 9)]


def test_latest_is_cut_down_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("at"))
    plan = latest_per_key(df, ["k"], "at")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_top_n_past_the_rank_limit(spark, small_chunks):
    df = spark.range(6000).select((F.col("id") % 3).alias("k"), F.col("id").alias("at")).where("k < 2")
    found = top_n_per_key(df, ["k"], "at", 1500)
    assert found.columns == ["k", "at"]
    assert found.distinct().count() == 3000
    assert found.agg(F.min("at")).first()[0] == 1500
    few = top_n_per_key(df.where("at < 9"), ["k"], "at", 1500)
    assert few.count() == 6


def test_previous_and_number_for_groups_of_any_size(spark, small_chunks):
    rng = random.Random(1)
    data = [("hot" if rng.random() < 0.5 else f"k{rng.randint(0, 40)}", i, rng.randint(0, 3)) for i in range(3000)]
    data += [(None, i, 0) for i in range(50)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "k string, t int, v int").repartition(8)
    split = split_groups(df, ["k"], ["t"])
    spread = split.where("k = 'hot'").select(CHUNK).distinct().count()
    assert spread > 1, "the hot key must not lie in one chunk"
    found = number_rows(previous_row(split, ["k"], ["t"], ["v"]), ["k"], ["t"], "n")
    expected, seen = [], {}
    for k, t, v in sorted(data, key=lambda r: r[1]):
        n, before = seen.get(k, (0, None))
        seen[k] = (n + 1, v)
        expected.append((k, t, v, before, n + 1))
    assert rows(found, "k", "t", "v", "prev.v", "n") == sorted(expected, key=repr)


def test_few_shuffles_and_no_window_over_whole_keys(spark):
    df = split_groups(spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("t")), ["k"], ["t"])
    for found in (previous_row(df, ["k"], ["t"], ["t"]), number_rows(df, ["k"], ["t"], "n")):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning") <= 4
        assert "hashpartitioning(k#" not in plan


def test_a_hot_key_is_ranked_in_parts(spark):
    df = spark.range(1000).select(F.format_string("hot%d", F.col("id") % 1).alias("k"), F.col("id").alias("at"))
    assert rows(top_n_per_key(df, ["k"], "at", 3)) == [("hot0", 997), ("hot0", 998), ("hot0", 999)]
    plan = top_n_per_key(df, ["k"], "at", 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_number_rows_without_keys(spark, small_chunks):
    df = spark.range(1000).repartition(8)
    found = number_rows(split_groups(df, [], ["id"]), [], ["id"], "n")
    assert found.where(F.col("n") != F.col("id") + 1).isEmpty()
    assert found.count() == 1000


def dated(spark, data):
    return spark.createDataFrame(data, "k string, date date")


def test_tail_boundary_days(spark):
    target = dated(spark, [("a", D(2024, 3, 31))])
    source = dated(spark, [("a", D(2024, 1, 1)), ("a", D(2024, 1, 2)), ("b", D(2024, 4, 9))])
    late = [("a", D(2024, 1, 2)), ("b", D(2024, 4, 9))]
    assert rows(incremental_tail(source, target, days=90)) == [("a", D(2024, 1, 1)), *late]
    assert rows(incremental_tail(source, target, days=89)) == late


def test_tail_boundary_leap_year(spark):
    target = dated(spark, [("a", D(2024, 2, 29))])
    source = dated(spark, [("a", D(2021, 2, 27)), ("a", D(2021, 2, 28))])
    assert rows(incremental_tail(source, target, years=3)) == [("a", D(2021, 2, 28))]


def test_empty_or_missing_target_loads_in_full(spark):
    source = dated(spark, [("a", D(1900, 1, 1))])
    empty = source.limit(0)
    for scope in ("global", "per_key"):
        assert incremental_tail(source, empty, days=90, scope=scope, keys=["k"]).count() == 1
    assert incremental_tail(source, None, days=90).count() == 1


def test_late_slow_series(spark):
    target = dated(spark, [("daily", D(2024, 7, 27)), ("quarterly", D(2024, 1, 1))])
    source = dated(spark, [("daily", D(2024, 7, 28)), ("quarterly", D(2024, 4, 1)), ("new", D(1990, 1, 1))])
    assert rows(incremental_tail(source, target, days=90)) == [("daily", D(2024, 7, 28))]
    per_key = incremental_tail(source, target, days=90, scope="per_key", keys=["k"])
    assert rows(per_key, "k") == [("daily",), ("new",), ("quarterly",)]


def test_tail_arguments(spark):
    source = dated(spark, [("a", D(2024, 1, 1))])
    for arguments in ({}, {"days": 1, "years": 1}, {"days": 1, "scope": "x"}, {"days": 1, "scope": "per_key"}):
        with pytest.raises(ValueError):
            incremental_tail(source, source, **arguments)


def test_merged_view(spark):
    target = spark.createDataFrame([("a", 1, 1.0), ("b", 1, 2.0)], "k string, d int, v double")
    source = spark.createDataFrame([(9.0, "a", 1), (3.0, "c", 1)], "v double, k string, d int")
    once = merged_view(target, source, ["k", "d"])
    assert rows(once) == [("a", 1, 9.0), ("b", 1, 2.0), ("c", 1, 3.0)]
    assert rows(merged_view(once, source, ["k", "d"])) == rows(once)


def test_request_plan(spark):
    keys = spark.createDataFrame([("known",), ("ahead",), ("new",)], "k string")
    marks = watermarks(
        dated(spark, [("known", D(2024, 1, 1)), ("known", D(2024, 1, 5)), ("ahead", D(2024, 2, 1))]), "k", "date"
    )
    plan = plan_requests(keys, marks, "k", "2015-01-01", "2024-01-20")
    assert rows(plan) == [("known", D(2024, 1, 5), D(2024, 1, 20)), ("new", D(2015, 1, 1), D(2024, 1, 20))]
    open_plan = plan_requests(keys, marks, "k", overlap_days=3)
    assert rows(open_plan) == [
        ("ahead", D(2024, 1, 29), None),
        ("known", D(2024, 1, 2), None),
        ("new", None, None),
    ]
    end = spark.range(1).select(lagged_end(6, T(2024, 1, 10, 23, tzinfo=dt.timezone.utc))).first()[0]
    assert end == D(2024, 1, 4)


def test_pivot_keeps_all_null_dates(spark):
    df = spark.createDataFrame(
        [(1, "x", None), (2, "x", 3.0), (2, "y", 4.0), (2, "other", 9.0), (3, "other", 1.0)],
        "d int, name string, v double",
    )
    wide = pivot_conditional(df, "d", "name", "v", {"x": "ex", "y": "why"})
    assert rows(wide) == [(1, None, None), (2, 3.0, 4.0)]


def test_both_spines_agree(spark):
    df = spark.createDataFrame(
        [("p", "01", 1, 5.0), ("p", "02", 1, 6.0), ("w", "01", 1, 7.0), ("w", "03", 2, 8.0), ("p", "04", 1, None), ("w", "04", 1, None)],
        "part string, s string, d int, v double",
    )
    measures = {p: F.when(F.col("part") == p, F.col("v")) for p in ("p", "w")}
    single = spine_pivot(df, ["s", "d"], measures)
    parts = [df.where((F.col("part") == p) & F.col("v").isNotNull()).select("s", "d", F.col("v").alias(p)) for p in ("p", "w")]
    expected = [("01", 1, 5.0, 7.0), ("02", 1, 6.0, None), ("03", 2, None, 8.0)]
    assert rows(single, "s", "d", "p", "w") == expected
    assert rows(spine_join(parts, ["s", "d"]), "s", "d", "p", "w") == expected


def test_checks(spark):
    df = spark.createDataFrame([(1, None, 1), (1, "x", 2), (None, "x", 3), (None, "x", 3)], "a int, b string, c int")
    assert rows(check_not_null(df, ["a", "b", "c"])) == [("a", 2), ("b", 1), ("c", 0)]
    assert rows(check_unique(df, ["a"])) == [(1, 2)]
    assert rows(check_unique(df, ["a", "b"])) == [(None, "x", 2)]
    assert rows(check_expression(df, "a > 1 or c < 2"), "c") == [(2,)]
    summary = summarise({"nulls": check_not_null(df, ["a", "b"]), "rule": check_expression(df, "c < 9")})
    assert rows(summary) == [("nulls", 3, "fail"), ("rule", 0, "pass")]


def test_freshness(spark):
    now = T(2024, 1, 31, tzinfo=dt.timezone.utc)
    found = []
    for age in (1, 3, 8):
        df = spark.createDataFrame([(now - dt.timedelta(days=age),), (T(2020, 1, 1),)], "at timestamp")
        found.append(check_freshness(df, "at", now=now).first()["status"])
    assert found == ["pass", "warn", "error"]
    empty = spark.createDataFrame([], "at timestamp")
    assert check_freshness(empty, "at", now=now).first()["status"] == "error"
    assert summarise({"f": check_freshness(empty, "at", now=now)}).first()["status"] == "fail"


@pytest.mark.parametrize(
    ("landed", "rejected", "expected"),
    [
        ([], [], "nothing new"),
        ([], ["a"], "failed"),
        (["b"] * 5, ["a"], "loaded with rejected keys"),
        (["b"], [], "loaded"),
    ],
)
def test_run_verdict(spark, landed, rejected, expected):
    def keys(values):
        return spark.createDataFrame([(v,) for v in values], "k string")

    report = run_report(keys(["a", "b", "c"]), keys(landed), keys(rejected), "k")
    assert run_verdict(report).first()["verdict"] == expected
    status = {r["k"]: (r["rows"], r["status"]) for r in report.collect()}
    assert status["a"] == (0, "rejected" if rejected else "empty")
    assert status["b"] == ((len(landed), "loaded") if landed else (0, "empty"))
    assert rows(empty_keys(keys(["a", "b"]), keys(landed), "k"))[:1] == [("a",)]


def test_key_lists_hold_every_key(spark, small_chunks):
    report = spark.range(250).select(F.format_string("%03d", "id").alias("k"), F.lit("empty").alias("status"))
    lines = sorted(key_lists(report, "k", per_line=100).collect(), key=lambda r: r["line"])
    assert [r["keys"] for r in lines] == [
        ", ".join(f"{i:03d}" for i in range(start, min(start + 100, 250))) for start in (0, 100, 200)
    ]


def test_version_history(spark, small_chunks):
    loads = spark.createDataFrame(
        [("x", i, c) for i, c in enumerate("AABA")] + [("y", 0, None), ("y", 1, None), ("y", 2, "A")],
        "name string, t int, content string",
    )
    found = version_history(loads, ["name"], ["t"], "content")
    assert rows(found, "name", "t", "version") == [("x", 0, 1), ("x", 2, 2), ("x", 3, 3), ("y", 0, 1), ("y", 2, 2)]


def test_version_pairs(spark, small_chunks):
    history = spark.createDataFrame([("x", v, f"text {v}") for v in (1, 2, 5)] + [("y", 1, "t")], "name string, version long, content string")
    found = version_pairs(history, ["name"], ["version"])
    assert rows(found) == [("x", 1, 2, "text 1", "text 2"), ("x", 2, 5, "text 2", "text 5")]


def test_line_changes_count_repeats(spark):
    pairs = spark.createDataFrame([(1, "a\nb\nb\n", "b\nc\nc\n"), (2, "same", "same"), (3, None, "new")], "id int, older string, newer string")
    assert rows(line_changes(pairs, ["id"])) == [
        (1, "a\n", -1),
        (1, "b\n", -1),
        (1, "c\n", 2),
        (3, "new", 1),
    ]


HISTORY = "name string, content string, version long, snapshotted_at timestamp"


def test_next_versions(spark):
    history = spark.createDataFrame(
        [("a", "old", 1, T(2024, 1, 1)), ("a", "now", 2, T(2024, 1, 2)), ("b", "old", 7, T(2024, 1, 1))], HISTORY
    )
    current = spark.createDataFrame([("a", "now"), ("b", "new"), ("c", "first")], "name string, content string")
    changed = next_versions(current, history, T(2024, 1, 3, tzinfo=dt.timezone.utc))
    assert rows(changed, "name", "version") == [("b", 8), ("c", 1)]
    again = next_versions(current, history.unionByName(changed.select(*history.columns)))
    assert again.isEmpty()


def test_diff_of_last_two(spark):
    history = spark.createDataFrame(
        [
            ("one", "a", 1, T(2024, 1, 1)),
            ("same", "a", 1, T(2024, 1, 1)),
            ("same", "a", 2, T(2024, 1, 2)),
            ("two", "zero", 1, T(2023, 1, 1)),
            ("two", "a\nb\n", 2, T(2024, 1, 1)),
            ("two", "a\nc\n", 3, T(2024, 1, 2, 3, 4, 5, 678)),
        ],
        HISTORY,
    )
    found = {r["name"]: r["diff"] for r in diff_last_two(history).collect()}
    assert found == {
        "one": "(fewer than 2 snapshots exist for 'one' — nothing to diff)",
        "same": "(no text changes between last two snapshots)",
        "two": "--- v2 (2024-01-01 00:00:00+00:00)\n+++ v3 (2024-01-02 03:04:05.000678+00:00)\n"
        "@@ -1,2 +1,2 @@\n a\n-b\n+c\n",
    }
