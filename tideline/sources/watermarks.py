"""Watermarks kept beside a table: one row for each key, brought up to date by every append.

They stand in a hidden folder of the table, each state in a folder of its own that counts once it
is finished. An append leaves a mark before it writes rows and takes it away when
the new state is there. A mark that is found later on stands for an update that was lost,
and the state is worked out from the table again. What is kept are maxima, so an update that
is made twice changes nothing, and a state that lags behind only makes a plan ask for more.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.session import children, remove_folder, touch

#: Property of a table that names the keys, the date and the time of extraction its watermarks go by.
PROPERTY = "tideline.watermarks"
#: What is kept for each key: its newest date, and when its newest row was extracted.
MAX_DATE, NEWEST = "max_date", "newest"

_FOLDER, _STATE, _PENDING, _DONE = ".watermarks", "state-", "_pending-", "_SUCCESS"


def watermark_property(keys: Sequence[str], date_col: str = "date", at_col: str = "extracted_at") -> str:
    return ",".join([date_col, at_col, *keys])


def kept_columns(spark: SparkSession, table: str) -> tuple[list[str], str, str] | None:
    """Keys, date and time of extraction that a table's watermarks go by; None if it keeps none."""
    named = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == PROPERTY).collect()
    if not named:
        return None
    date_col, at_col, *keys = named[0]["value"].split(",")
    return keys, date_col, at_col


def _location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return described.where("col_name = 'Location'").first()["data_type"] + f"/{_FOLDER}"


def _newest(rows: DataFrame, keys: Sequence[str], date_col: str, at_col: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.max(date_col).alias(MAX_DATE), F.max(at_col).alias(NEWEST))


def _state(spark: SparkSession, folder: str) -> str | None:
    """The last finished state."""
    for name in sorted((n for n in children(spark, folder) if n.startswith(_STATE)), reverse=True):
        if _DONE in children(spark, f"{folder}/{name}"):
            return f"{folder}/{name}"
    return None


def _write(state: DataFrame, folder: str) -> str:
    """Write a new state; of those before it the last one stays for plans that still read it."""
    spark = state.sparkSession
    path = f"{folder}/{_STATE}{time.time_ns():020d}-{uuid.uuid4().hex}"
    state.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(path)
    older = sorted(n for n in children(spark, folder) if n.startswith(_STATE) and n < path.rsplit("/", 1)[1])
    for name in older[:-1]:
        remove_folder(spark, f"{folder}/{name}")
    return path


def begin_append(spark: SparkSession, table: str) -> str | None:
    """Mark that rows are about to come in; None for a table that keeps no watermarks."""
    if kept_columns(spark, table) is None:
        return None
    mark = f"{_location(spark, table)}/{_PENDING}{uuid.uuid4().hex}"
    touch(spark, mark)
    return mark


def end_append(rows: DataFrame, table: str, mark: str | None) -> None:
    """Take the appended ``rows`` into the watermarks and take the mark away.

    ``rows`` are read again, so they are those of a written table. Only their keys and dates are read, and one
    row for each key; with other marks about, or no state yet, the whole is left to the next reader.
    """
    if mark is None:
        return
    spark = rows.sparkSession
    keys, date_col, at_col = kept_columns(spark, table)
    folder = mark.rsplit("/", 1)[0]
    now = _state(spark, folder)
    if now is None:
        return
    fresh = _newest(rows, keys, date_col, at_col)
    both = spark.read.schema(fresh.schema).parquet(now).unionByName(fresh)
    _write(_newest(both.withColumnsRenamed({MAX_DATE: date_col, NEWEST: at_col}), keys, date_col, at_col), folder)
    remove_folder(spark, mark)


def kept_watermarks(spark: SparkSession, table: str) -> DataFrame:
    """``max_date`` and ``newest`` of each key of a table that keeps watermarks.

    They come from the kept state, and the table is not read; only where an update
    was lost, or none was made yet, they are worked out from the table first.
    """
    known = kept_columns(spark, table)
    if known is None:
        raise ValueError(f"{table} keeps no watermarks")
    keys, date_col, at_col = known
    folder = _location(spark, table)
    marks = [n for n in children(spark, folder) if n.startswith(_PENDING)]
    found = _state(spark, folder)
    fresh = _newest(spark.table(table), keys, date_col, at_col)
    if found is None or marks:
        found = _write(fresh, folder)
        for name in marks:
            remove_folder(spark, f"{folder}/{name}")
    return spark.read.schema(fresh.schema).parquet(found)
