"""What a landing run brought in, per key and in total."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.operators.ordering import CHUNK, number_rows, split_groups

LOADED, EMPTY, REJECTED, INCOMPLETE = "loaded", "empty", "rejected", "incomplete"


def empty_keys(keys_df: DataFrame, landed: DataFrame, key: str) -> DataFrame:
    """Keys for which nothing landed."""
    # One row per landed key goes into the shuffle, however many rows it has.
    return keys_df.select(key).join(landed.select(key).distinct(), key, "left_anti")


def run_report(
    keys_df: DataFrame, landed: DataFrame, rejected: DataFrame, key: str, incomplete: DataFrame | None = None
) -> DataFrame:
    """One row per key: rows landed and whether it was loaded, empty, rejected or incomplete.

    Keys that landed without being asked for are listed like the others.
    """
    counts = landed.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    turned_down = rejected.select(key).distinct().withColumn("_rejected", F.lit(True))
    report = keys_df.select(key).distinct().join(counts, key, "full").join(turned_down, key, "full")
    open_ = F.lit(None).cast("boolean")
    if incomplete is not None:
        report = report.join(incomplete.select(key).distinct().withColumn("_incomplete", F.lit(True)), key, "full")
        open_ = F.col("_incomplete")
    status = (
        F.when(F.col("_rejected"), REJECTED).when(open_, INCOMPLETE).when(F.col("rows") > 0, LOADED).otherwise(EMPTY)
    )
    return report.select(key, F.coalesce("rows", F.lit(0)).alias("rows"), status.alias("status"))


def run_verdict(report: DataFrame) -> DataFrame:
    """One row of totals and the verdict of the run.

    It failed only if keys were rejected or left incomplete and nothing landed at
    all; a run without new rows is fine.
    """
    totals = report.agg(
        F.count(F.lit(1)).alias("keys"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.count_if(F.col("status") == EMPTY).alias("empty_keys"),
        F.count_if(F.col("status") == REJECTED).alias("rejected_keys"),
        F.count_if(F.col("status") == INCOMPLETE).alias("incomplete_keys"),
    )
    nothing = F.col("total_rows") == 0
    turned_down, open_ = F.col("rejected_keys") > 0, F.col("incomplete_keys") > 0
    verdict = (
        F.when(nothing & (turned_down | open_), "failed")
        .when(turned_down, "loaded with rejected keys")
        .when(open_, "loaded with incomplete keys")
        .when(nothing, "nothing new")
        .otherwise("loaded")
    )
    return totals.withColumn("verdict", verdict)


def key_lists(report: DataFrame, key: str, per_line: int = 100) -> DataFrame:
    """Empty and rejected keys as joined lists, in key order, ``per_line`` keys a line.

    Every key is listed; long lists run over several lines, so no line grows
    with the number of keys.
    """
    listed = report.where(F.col("status") != LOADED).select("status", F.col(key).cast("string").alias("key"))
    rows = split_groups(listed, ["status"], ["key"])
    numbered = number_rows(rows, ["status"], ["key"], "n").drop(CHUNK)
    line = F.floor((F.col("n") - 1) / per_line).cast("long").alias("line")
    return numbered.groupBy("status", line).agg(
        F.array_join(F.array_sort(F.collect_list("key")), ", ").alias("keys")
    )
