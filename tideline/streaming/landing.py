"""Land payload captures as they arrive: every captured file is read once.

This is the extraction job's append as a Structured Streaming job.  It takes
what is new since the last run and stops; the checkpoint remembers which files
were read.  A batch repeated after a lost driver appends what is not there yet.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.session import children, discard, materialise, remove_folder, shared_folder, touch
from tideline.sources.tables import PERIOD_COLUMNS, append_rows, partition_column

OBSERVATION_PAGES = T.StructType(
    [
        T.StructField("series_id", T.StringType()),
        T.StructField("page_offset", T.LongType()),
        T.StructField("payload", T.StringType()),
        T.StructField("extracted_at", T.TimestampType()),
    ]
)


def append_once(
    rows: DataFrame, batch: int, checkpoint: str, table: str, schema: T.StructType, cluster: Sequence[str] = ()
) -> None:
    """Append the rows of a numbered micro-batch, also where the batch is run again.

    A mark beside the checkpoint is put down before rows are appended, another one after. With
    the second the batch is done. With the first alone some of its rows may be there: then
    the table's rows of the same periods and times are counted, and only what is missing is appended.
    """
    spark = rows.sparkSession
    folder = f"{checkpoint}/appended"
    marks = set(children(spark, folder))
    begun, done = f"begun-{batch}", f"done-{batch}"
    if done in marks:
        return
    staged = materialise(rows.select(*schema.fieldNames()), "batch")
    try:
        if begun not in marks:
            touch(spark, f"{folder}/{begun}")
            append_rows(staged, table, schema, cluster=cluster, written=True)
        else:
            spark.catalog.refreshTable(table)
            append_rows(missing_rows(staged, spark.table(table)), table, schema, cluster=cluster)
    finally:
        discard(staged)
    touch(spark, f"{folder}/{done}")
    for old in marks:
        if old not in (begun, done) and int(old.rsplit("-", 1)[1]) < batch:
            remove_folder(spark, f"{folder}/{old}")


def missing_rows(rows: DataFrame, table: DataFrame, date_col: str = "date", at_col: str = "extracted_at") -> DataFrame:
    """The ``rows`` that ``table`` does not hold yet, a row that occurs n times as often as it lacks it.

    Only the periods of the rows, and rows extracted when they were, are read of the table.
    """
    columns = rows.columns
    period_col = partition_column(table)
    bounds = rows.agg(F.min(date_col).alias("first"), F.max(date_col).alias("last"), F.min(at_col).alias("at"), F.max(at_col).alias("until"))
    first, last, since, until = bounds.first()
    if first is None:
        return rows
    held = table.where(F.col(date_col).between(first, last) & F.col(at_col).between(since, until))
    if period_col:
        unit = PERIOD_COLUMNS[period_col]
        held = held.where(F.col(period_col).between(F.trunc(F.lit(first), unit), F.lit(last)))
    signed = rows.withColumn("_n", F.lit(1)).unionByName(held.select(*columns).withColumn("_n", F.lit(-1)))
    lacking = signed.groupBy(*columns).agg(F.sum("_n").cast("int").alias("_n")).where("_n > 0")
    return lacking.select(*columns, F.explode(F.array_repeat(F.lit(0), F.col("_n"))).alias("_copy")).drop("_copy")


def land_captures(
    spark: SparkSession,
    captures: str,
    pages_schema: T.StructType,
    decode: Callable[[DataFrame], DataFrame],
    table: str,
    table_schema: T.StructType,
    cluster: Sequence[str] = (),
    checkpoint: str | None = None,
    max_files: int | None = None,
) -> None:
    """Decode the parquet captures not seen before and append them to a raw table.

    ``max_files`` bounds one batch, so a long backlog lands in several.
    """
    reader = spark.readStream.schema(pages_schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    place = checkpoint or f"{shared_folder(spark)}/landing/{table}"

    def append(batch: DataFrame, number: int) -> None:
        append_once(decode(batch), number, place, table, table_schema, cluster)

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
