"""Land page sets that arrive over several micro-batches: a set lands once, when it is whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.scalars import required
from tideline.session import children, remove_folder, setting, shared_folder
from tideline.sources.payloads import PAGE_LIMIT, decode_observations
from tideline.streaming.landing import OBSERVATION_PAGES, append_once

_PAGE = "page_offset long, at long, size long, payload string"
# Put down by Spark when all of a folder is written.
_WRITTEN = "_SUCCESS"


def measured_pages(pages: DataFrame, key: str) -> DataFrame:
    """Captures as ``key, page_offset, at, size, payload``: the time in microseconds, the number of observations.

    A page is parsed once to be measured, before it goes to its key. One without an offset or a time is an error.
    """
    parsed = F.from_json("payload", "observations ARRAY<STRUCT<date: STRING, value: STRING>>", {"mode": "FAILFAST"})
    return pages.select(
        F.col(key).cast("string").alias(key),
        required(F.col("page_offset").cast("long"), "page_offset", "long").alias("page_offset"),
        required(F.unix_micros("extracted_at"), "extracted_at", "long").alias("at"),
        F.coalesce(F.array_size(parsed["observations"]), F.lit(0)).cast("long").alias("size"),
        "payload",
    )


def whole_sets(pages: DataFrame, key: str, page_limit: int = PAGE_LIMIT) -> DataFrame:
    """The pages that count of ``key, page_offset, at, size, payload``, and whether they make a ``whole`` set.

    A set is whole when its offsets run 0, limit, 2 x limit ... without a gap, every page
    before the last is full, and the last one is short. Of a page
    captured twice the later capture counts, of equal times the larger payload. A run asks for pages in order, so a
    page captured before one in front of it belongs to a run that was broken off, and is dropped.

    One shuffle by key and one sort serve all windows; what a key holds is one set.
    """
    of_key = Window.partitionBy(key)
    captures = of_key.orderBy("page_offset", F.col("at").desc(), F.coalesce("payload", F.lit("")).desc())
    in_front = of_key.orderBy("page_offset").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.col("page_offset")
    last = pages.withColumn("_above", F.lag("page_offset").over(captures)).where(~offset.eqNullSafe(F.col("_above")))
    newest = last.withColumn("_newest", F.max("at").over(in_front))
    kept = newest.where(F.col("_newest").isNull() | (F.col("at") >= F.col("_newest")))
    end = F.max(offset).over(of_key)
    misplaced = F.count_if(F.pmod(offset, F.lit(page_limit)) != 0).over(of_key)
    contiguous = (F.min(offset).over(of_key) == 0) & (misplaced == 0) & (end == (F.count(F.lit(1)).over(of_key) - 1) * page_limit)
    first_short = F.min(F.when(F.col("size") < page_limit, offset)).over(of_key)
    whole = F.coalesce(contiguous & (first_short == end), F.lit(False))
    return kept.withColumn("whole", whole).select(key, "page_offset", "at", "size", "payload", "whole")


def land_page_sets(
    spark: SparkSession,
    captures: str,
    table: str,
    table_schema: T.StructType,
    key: str = "series_id",
    page_limit: int = PAGE_LIMIT,
    pages_schema: T.StructType = OBSERVATION_PAGES,
    cluster: Sequence[str] = (),
    checkpoint: str | None = None,
    max_files: int | None = None,
) -> None:
    """Take the parquet captures not seen before; append the sets that are whole by now, each once.

    Sets that are not whole yet wait beside the checkpoint for the captures of a later run, so a
    watermark never passes a page that has not come. Each batch puts its captures to the pages that wait and
    writes all of them, whole sets apart from the others, into a folder of its own; the next batch goes on from
    the others. A batch that is repeated after a lost driver takes the folder it has written, or writes it again from the
    one before, and appends what is not there yet, and nothing else.
    """
    place = checkpoint or f"{shared_folder(spark)}/page-sets/{table}"
    reader = spark.readStream.schema(pages_schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    schema = f"`{key}` string, {_PAGE}, whole boolean"

    def written(session: SparkSession, number: int) -> DataFrame:
        return session.read.schema(schema).parquet(f"{place}/held/{number}")

    def append(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        # Spark turns re-planning off for what a stream plans; the steps of a batch are plain queries.
        with setting(session, "spark.sql.adaptive.enabled", "true"):
            numbers = sorted(int(n) for n in children(session, f"{place}/held"))
            finished = [n for n in numbers if n <= number and _WRITTEN in children(session, f"{place}/held/{n}")]
            if number not in finished:
                pages = measured_pages(batch, key)
                if finished:
                    pages = pages.unionByName(written(session, finished[-1]).where("NOT whole").drop("whole"))
                marked = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "true"}
                sets = whole_sets(pages, key, page_limit).write.mode("overwrite").partitionBy("whole")
                sets.options(**marked).parquet(f"{place}/held/{number}")
            pages = written(session, number).where("whole").withColumn("extracted_at", F.timestamp_micros("at"))
            append_once(decode_observations(pages, key), number, place, table, table_schema, cluster)
            for old in numbers:
                if old < number:
                    remove_folder(session, f"{place}/held/{old}")

    query = (
        reader.parquet(captures)
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", place)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # Batches ran in a session of their own; this one still knows the old files.
    spark.catalog.refreshTable(table)
