"""Named tables: creation, scans, and partitioned writes."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.scalars import required
from tideline.session import children, discard, make_folder, materialise, remove_folder, setting, subfolders, table_root, touch
from tideline.sources.watermarks import PROPERTY, begin_append, end_append, watermark_property

# Layers of the pipeline and the database each one belongs to.
LAYERS = {
    "raw": "raw",
    "1_staging_warehouses": "stg_warehouses",
    "2_warehouses": "warehouses",
    "3_staging_marts": "stg_marts",
    "4_marts": "marts",
}

# Partition column to the unit its dates are cut to.
PERIOD_COLUMNS = {"date_month": "month", "date_year": "year"}
_COLUMN_OF = {period: column for column, period in PERIOD_COLUMNS.items()}

# Rows per file where a load is to be split like the batches of the source system.
LOAD_BATCH_ROWS = 50_000


def layer_table_name(layer: str, model: str, prefix: str = "") -> str:
    """``database.table`` of a model, with an optional prefix for a private copy."""
    return f"{prefix}{LAYERS[layer].strip()}.{model}"


def partition_column(df: DataFrame) -> str | None:
    """The period column of a table, if it has one."""
    return next((c for c in df.columns if c in PERIOD_COLUMNS), None)


def ensure_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    period: str | None = None,
    root: str | None = None,
    watermark_keys: Sequence[str] = (),
    at_col: str = "extracted_at",
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
) -> None:
    """Create a parquet table if there is none, partitioned by month or year of its date.

    The files live under ``root``, by default in the warehouse.  A new session
    finds files already there again.  With ``watermark_keys`` the table keeps its
    newest date and newest ``at_col`` for each key, and every append or merge brings them up to date.

    With ``bucket_by`` rows are dealt to ``buckets`` files of each period by these columns, so that
    ranking, grouping or joining by them, or by more, plans no shuffle. A scan that uses
    the buckets has as many tasks, so take as many as the whole table needs, and columns no
    one value of which holds much of it.
    """
    if spark.catalog.tableExists(name):
        return
    database = name.split(".")[0]
    root = root or table_root(spark)
    location = f"{root}/{name.replace('.', '/')}"
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields]
    layout = ""
    if period:
        columns.append(f"`{_COLUMN_OF[period]}` date")
        layout = f"PARTITIONED BY (`{_COLUMN_OF[period]}`)"
        # Appending no rows makes the folder, and leaves files already there alone.
        nothing = spark.createDataFrame([], ", ".join(columns)).write.mode("append")
        nothing.partitionBy(_COLUMN_OF[period]).parquet(location)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{root}/{database}'")
    if bucket_by:
        dealt = ", ".join(f"`{c}`" for c in bucket_by)
        layout += f" CLUSTERED BY ({dealt}) SORTED BY ({dealt}) INTO {buckets} BUCKETS"
    kept = ""
    if watermark_keys:
        kept = f"TBLPROPERTIES ('{PROPERTY}' = '{watermark_property(watermark_keys, at_col=at_col)}')"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}) USING parquet {layout} "
        f"LOCATION '{location}' {kept}"
    )
    if period:
        _recover(spark, name)


def source(spark: SparkSession, name: str) -> DataFrame:
    """A raw table."""
    return spark.table(name)


def ref(spark: SparkSession, name: str) -> DataFrame:
    """A model's table."""
    return spark.table(name)


def store_view(spark: SparkSession, name: str, sql: str, root: str | None = None) -> None:
    """Put a view of ``sql`` into the catalogue, in place of one that is there."""
    database = name.split(".")[0]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{root or table_root(spark)}/{database}'")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {sql}")


def view_name(table: str) -> str:
    """Name of the session view of a view-only model."""
    return table.replace(".", "__")


def append_rows(
    df: DataFrame,
    table: str,
    schema: T.StructType,
    date_col: str = "date",
    cluster: Sequence[str] = (),
    max_records_per_file: int | None = None,
    written: bool = False,
) -> None:
    """Append rows as they are, duplicates included; no rows is no change.

    A NULL in a column that ``schema`` declares as required stops the write.  A table that keeps
    watermarks has them brought up to date in the same run, for which the rows are
    written to the shared folder first unless ``written`` says that ``df`` reads such a folder.
    """
    columns = [
        F.col(f.name).cast(f.dataType)
        if f.nullable
        else required(F.col(f.name).cast(f.dataType), f.name, f.dataType.simpleString())
        for f in schema.fields
    ]
    spark = df.sparkSession
    rows = df.select(*[c.alias(f.name) for c, f in zip(columns, schema.fields, strict=True)])
    mark = begin_append(spark, table)
    staged = None
    if mark is not None and not written:
        rows = staged = materialise(rows, "append")
    period_col = partition_column(spark.table(table))
    dated = rows.withColumn(period_col, F.trunc(F.col(date_col), PERIOD_COLUMNS[period_col])) if period_col else rows
    insert_rows(dated, table, cluster, max_records_per_file)
    end_append(rows, table, mark)
    if staged is not None:
        discard(staged)


def insert_rows(
    rows: DataFrame,
    table: str,
    cluster: Sequence[str] = (),
    max_records_per_file: int | None = None,
) -> None:
    """Append rows to a table through the catalogue, which takes up new periods by itself."""
    spark = rows.sparkSession
    target = spark.table(table)
    buckets, columns = bucket_layout(spark, table)
    if buckets:
        laid_out = _dealt(rows.select(*target.columns), partition_column(target), buckets, columns)
    else:
        laid_out = _laid_out(rows, target, cluster)
    with setting(spark, "spark.sql.files.maxRecordsPerFile", str(max_records_per_file or 0)):
        laid_out.write.insertInto(table)


def _laid_out(rows: DataFrame, target: DataFrame, cluster: Sequence[str]) -> DataFrame:
    """Rows gathered by period and sorted by the cluster columns, so that files are few and can be skipped in part.

    The rebalance splits a period that holds much of the data over as many tasks as its size asks for.
    """
    period_col = partition_column(target)
    rows = rows.select(*target.columns)
    if period_col:
        rows = rows.hint("rebalance", period_col).sortWithinPartitions(period_col, *cluster)
    return rows


def bucket_layout(spark: SparkSession, table: str) -> tuple[int, list[str]]:
    """The number of a table's buckets, 0 without any, and the columns they go by."""
    said = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    columns = said.get("Bucket Columns", "[]").strip("[]").replace("`", "").split(", ")
    return int(said.get("Num Buckets") or 0), columns


def _dealt(rows: DataFrame, period_col: str | None, buckets: int, columns: list[str]) -> DataFrame:
    """Rows gathered by period and bucket, so that a task writes whole buckets."""
    bucket = F.pmod(F.hash(*columns), F.lit(buckets))
    return rows.repartition(*[F.col(c) for c in [period_col] if c], bucket)


def replace_periods(rows: DataFrame, table: str, periods: Sequence[dt.date], cluster: Sequence[str] = ()) -> None:
    """Put ``rows``, all rows of ``periods``, in place of what these periods hold.

    They are written to a folder of their own first, which Spark marks when all of it is
    there. From then on it counts: the catalogue is pointed at it, here or, if this run does
    not get that far, by whoever next merges into the table or finds it with a new catalogue. A
    folder without the mark never counts.
    """
    spark = rows.sparkSession
    target = spark.table(table)
    period_col = partition_column(target)
    location = table_location(spark, table)
    # After all that are there, also where this clock is behind the one that named them.
    last = max((int(n[len(_SWAP) :].split("-")[0]) for n in subfolders(spark, location) if n.startswith(_SWAP)), default=0)
    folder = f"{location}/{_SWAP}{max(time.time_ns(), last + 1):020d}-{uuid.uuid4().hex}"
    marked = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "true"}
    buckets, columns = bucket_layout(spark, table)
    if buckets:
        # Only tables have buckets, so the folder is one's for as long as it is written.
        scratch = f"{table.split('.')[0]}.swap_{uuid.uuid4().hex}"
        dealt = _dealt(rows.select(*target.columns), period_col, buckets, columns).write.format("parquet")
        dealt = dealt.partitionBy(period_col).bucketBy(buckets, *columns).sortBy(*columns)
        dealt.options(path=folder, **marked).saveAsTable(scratch)
        spark.sql(f"DROP TABLE {scratch}")
    else:
        for period in periods:
            # So that a period without rows is replaced as well.
            make_folder(spark, f"{folder}/{period_col}={period}")
        write = _laid_out(rows, target, cluster).write.mode("append").partitionBy(period_col)
        write.options(**marked).parquet(folder)
    settle_periods(spark, table)


# Folders of replaced periods, in the order in which they were written; Spark passes over such names by itself.
_SWAP = ".swap-"
# Marks in them: all is written; the catalogue points at it.
_WRITTEN, _POINTED = "_SUCCESS", "_POINTED"


def settle_periods(spark: SparkSession, table: str, everything: bool = False, writer: bool = True) -> None:
    """Point the catalogue at the replaced periods that are written but not pointed at yet, of one period the last.

    ``everything`` points at all of them, as a new catalogue needs. A ``writer`` also removes what does not
    count: folders whose write was never finished, and periods that a later folder holds. Two writers must not
    be at one table, or one takes the other's folder for a failed one.
    """
    period_col = partition_column(spark.table(table))
    location = table_location(spark, table)
    names = subfolders(spark, location)
    newest = {n: f"{location}/{n}" for n in names if n.startswith(f"{period_col}=")}
    stale: list[str] = []
    due: set[str] = set()
    unpointed: list[str] = []
    for swap in sorted(n for n in names if n.startswith(_SWAP)):
        inside = children(spark, f"{location}/{swap}")
        held = [n for n in inside if n.startswith(f"{period_col}=")]
        if _WRITTEN not in inside or not held:
            stale.append(f"{location}/{swap}")
            continue
        for name in held:
            if name in newest:
                stale.append(newest[name])
            newest[name] = f"{location}/{swap}/{name}"
        if everything or _POINTED not in inside:
            due.update(held)
            unpointed.append(f"{location}/{swap}")
    if due:
        _point(spark, table, period_col, {n.split("=", 1)[1]: newest[n] for n in sorted(due)})
        spark.catalog.refreshTable(table)
    for folder in unpointed:
        touch(spark, f"{folder}/{_POINTED}")
    if writer:
        for folder in stale:
            remove_folder(spark, folder)


def _point(spark: SparkSession, table: str, period_col: str, locations: dict[str, str]) -> None:
    """Point the catalogue at the periods' locations: new ones in one statement, each known one in its own."""
    known = {str(p) for p in table_periods(spark, table)}
    new = [f"PARTITION (`{period_col}` = DATE '{p}') LOCATION '{at}'" for p, at in locations.items() if p not in known]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(new)}")
    for period, at in locations.items():
        if period in known:
            spark.sql(f"ALTER TABLE {table} PARTITION (`{period_col}` = DATE '{period}') SET LOCATION '{at}'")


def _recover(spark: SparkSession, table: str) -> None:
    """Register the periods that files are there for, of one period the last written."""
    spark.catalog.recoverPartitions(table)
    settle_periods(spark, table, everything=True, writer=False)


def table_periods(spark: SparkSession, table: str) -> list[dt.date]:
    """The periods a partitioned table has, from the catalog alone."""
    named = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return sorted(dt.date.fromisoformat(r["partition"].split("=")[1]) for r in named)


def table_location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return described.where("col_name = 'Location'").first()["data_type"]
