"""Versioned documents: change detection, numbering, history and differences."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.documents import NO_CHANGE, TOO_FEW, lines_of, unified_diff
from tideline.functions.scalars import utc
from tideline.operators.latest import latest_per_key, top_n_per_key
from tideline.operators.ordering import CHUNK, number_rows, previous_row, split_groups
from tideline.session import materialise

#: The column that a history may keep its contents' digests in, so that no text is read to compare.
DIGEST = "content_sha256"

_DIGEST, _ROW = "_digest", "_row"

HISTORY_COLUMNS = ["version", "snapshotted_at", "notes", "performance_tag"]


def next_versions(
    current: DataFrame,
    history: DataFrame,
    now: dt.datetime | None = None,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """The loads whose content differs from the one before, numbered on from the recorded versions.

    ``current`` has the loads of each ``name`` in the order ``order_by``; with one load
    for each name no order is needed.  The first load is compared with the name's
    latest recorded version, so a second run over the same loads gives none.  Contents
    are compared by digest, and only digests are ranked and carried along; a history with a column
    ``content_sha256`` has them on record.  Different loads of one name without an order are an error.
    """
    loads = written_loads(current)
    return with_versions(loads, version_steps(loads, history, order_by), now)


def written_loads(current: DataFrame) -> DataFrame:
    """``current`` with digests and row numbers, written once: steps are found from these, texts stay where they are."""
    numbered = current.withColumns({_DIGEST: _digest("content"), _ROW: F.monotonically_increasing_id()})
    return materialise(numbered, "loads")


def version_steps(loads: DataFrame, history: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """The row number and ``version`` of each of ``written_loads`` that ``next_versions`` keeps; no text is read."""
    recorded = F.col(DIGEST) if DIGEST in history.columns else _digest("content")
    last = latest_per_key(
        history.select("name", "snapshotted_at", "version", recorded.alias("_recorded")),
        ["name"],
        "snapshotted_at",
        ["version"],
    ).select("name", F.col("version").alias("_version"), "_recorded")
    order = list(order_by) or [_DIGEST]
    narrow = list(dict.fromkeys(["name", *order, _DIGEST, _ROW]))
    loads = split_groups(loads.select(*narrow), ["name"], order)
    if not order_by:
        several = loads.groupBy("name").agg(F.min(_DIGEST).alias("a"), F.max(_DIGEST).alias("b")).where("a <> b")
        if not several.isEmpty():
            raise ValueError("several loads of one name have no order; give order_by")
    loads = previous_row(loads, ["name"], order, [_DIGEST], "_prev").join(last, "name", "left")
    before = F.when(F.col("_prev").isNotNull(), F.col("_prev._digest")).otherwise(F.col("_recorded"))
    known = F.col("_prev").isNotNull() | F.col("_version").isNotNull()
    changed = loads.where(~(known & F.col(_DIGEST).eqNullSafe(before)))
    version = F.coalesce(F.col("_version"), F.lit(0)).cast("long") + F.col("_step")
    return number_rows(changed, ["name"], order, "_step").select(_ROW, version.alias("version"))


def with_versions(loads: DataFrame, steps: DataFrame, now: dt.datetime | None = None) -> DataFrame:
    """The loads that ``steps`` names, with their version and time.

    A text is shuffled here only, by its row number and so evenly, and not at all where the steps are few.
    """
    at = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    columns = [c for c in loads.columns if c not in (_DIGEST, _ROW, "version", "snapshotted_at")]
    found = loads.select(*columns, _ROW).join(steps, _ROW)
    return found.select(*columns, "version", at.alias("snapshotted_at"))


def _digest(content: str) -> Column:
    return F.sha2(F.col(content).cast("string"), 256)


def version_history(loads: DataFrame, keys: Sequence[str], order_by: Sequence[str], content: str) -> DataFrame:
    """Versions from many loads at once: unchanged loads drop out, the rest count from 1.

    Contents are compared by digest, so the previous text is never carried along.
    """
    rows = loads.withColumn("_digest", _digest(content))
    rows = split_groups(rows, keys, order_by)
    rows = previous_row(rows, keys, order_by, ["_digest"], "_prev")
    changed = rows.where(
        F.col("_prev").isNull() | ~F.col("_digest").eqNullSafe(F.col("_prev._digest"))
    )
    return number_rows(changed, keys, order_by, "version").drop("_digest", "_prev", CHUNK)


def version_pairs(
    history: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    content: str = "content",
    version: str = "version",
) -> DataFrame:
    """Every version beside the one before it: keys, both version marks, both texts."""
    columns = list(dict.fromkeys([*keys, *order_by, version, content]))
    rows = split_groups(history.select(*columns), keys, order_by)
    paired = previous_row(rows, keys, order_by, [version, content], "_older")
    return paired.where(F.col("_older").isNotNull()).select(
        *keys,
        F.col(f"_older.{version}").alias("older_version"),
        F.col(version).alias("newer_version"),
        F.col(f"_older.{content}").alias("older"),
        F.col(content).alias("newer"),
    )


def last_two(
    history: DataFrame, keys: Sequence[str], order_col: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """The two latest versions of every key."""
    return top_n_per_key(history, keys, order_col, 2, tie_break)


def line_changes(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lines a version gained (positive) or lost (negative), counted with repeats."""
    differing = pairs.where(~F.col("older").eqNullSafe(F.col("newer")))

    def lines(side: str, step: int) -> Column:
        return F.transform(
            lines_of(F.coalesce(F.col(side), F.lit(""))),
            lambda line: F.struct(line.alias("line"), F.lit(step).alias("step")),
        )

    both = F.concat(lines("newer", 1), lines("older", -1))
    return (
        differing.select(*keys, F.inline(both))
        .groupBy(*keys, "line")
        .agg(F.sum("step").alias("net"))
        .where(F.col("net") != 0)
    )


def snapshot_label(version: Column, at: Column) -> Column:
    """Version and UTC time as printed in a diff header."""
    whole = F.date_format(utc(at), "yyyy-MM-dd HH:mm:ss")
    micros = F.date_format(at, "SSSSSS")
    stamp = F.concat(whole, F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros)))
    return F.concat(F.lit("v"), version.cast("string"), F.lit(" ("), stamp, F.lit("+00:00)"))


def diff_last_two(history: DataFrame, n_context: int = 5) -> DataFrame:
    """``name, diff``: unified diff of each name's two latest versions, or why there is none."""
    two = last_two(history, ["name"], "snapshotted_at", ["version"]).select(
        "name", F.struct("snapshotted_at", "version", "content").alias("snapshot")
    )
    ends = two.groupBy("name").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("snapshot").alias("older"),
        F.max("snapshot").alias("newer"),
    )
    differ = (F.col("n") == 2) & (F.col("older.content") != F.col("newer.content"))
    # Texts that need no diff are not sent to Python.
    text = unified_diff(
        F.when(differ, F.col("older.content")),
        F.when(differ, F.col("newer.content")),
        snapshot_label(F.col("older.version"), F.col("older.snapshotted_at")),
        snapshot_label(F.col("newer.version"), F.col("newer.snapshotted_at")),
        n_context,
    )
    too_few = F.when(F.col("n") < 2, F.format_string(TOO_FEW, F.col("name")))
    return ends.select("name", F.coalesce(too_few, text, F.lit(NO_CHANGE)).alias("diff"))


def history_list(history: DataFrame, limit: int = 20) -> DataFrame:
    """The latest ``limit`` versions of every name, without their texts."""
    listed = history.select("name", *HISTORY_COLUMNS)
    return top_n_per_key(listed, ["name"], "snapshotted_at", limit, ["version"])


def history_of(spark, table: str, name: str, limit: int = 20) -> DataFrame:
    """The latest versions of one name, newest first, with the name bound as a parameter."""
    return spark.sql(
        f"SELECT {', '.join(HISTORY_COLUMNS)} FROM {table} "
        "WHERE name = :name ORDER BY snapshotted_at DESC, version DESC LIMIT :limit",
        args={"name": name, "limit": limit},
    )
