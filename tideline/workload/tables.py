"""Merges, checks and run reports."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.checks import (
    check_expression,
    check_freshness,
    check_not_null,
    check_unique,
    summarise,
)
from tideline.operators.incremental import incremental_tail, merge_upsert, merged_view, with_load_time
from tideline.operators.latest import latest_per_key
from tideline.operators.report import empty_keys, key_lists, run_report, run_verdict
from tideline.sources.tables import ensure_table
from tideline.workload import inputs
from tideline.workload.catalogue import query, read
from tideline.workload.series import KEYS

FACT = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("value", T.DoubleType()),
    ]
)

# First load: what was landed before 20 January.  Second: a 7-day tail with every value revised.
_FIRST = (
    inputs.OBSERVATIONS + ", tgt AS (SELECT user_id, event_type, date, value FROM ("
    + inputs.ranked_first(
        "obs", "user_id, event_type, date", "extracted_at DESC, event_id DESC", "date < DATE '2024-01-20'"
    )
    + "))"
)
_SECOND = (
    _FIRST + ", src AS (SELECT user_id, event_type, date, value + 1 AS value FROM ("
    + inputs.ranked_first("obs", "user_id, event_type, date", "extracted_at DESC, event_id DESC")
    + ") WHERE date >= (SELECT max(date) - 7 FROM tgt)) "
)
_MERGED = (
    f"WITH {_SECOND} SELECT * FROM src UNION ALL SELECT * FROM tgt WHERE NOT EXISTS (SELECT 1 FROM src "
    "WHERE src.user_id = tgt.user_id AND src.event_type = tgt.event_type AND src.date = tgt.date)"
)


def _first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = inputs.observations(spark, sf_dir).where(F.col("date") < F.lit("2024-01-20").cast("date"))
    return latest_per_key(landed, KEYS, "extracted_at", ["event_id"]).select(*FACT.fieldNames())


def _revised(spark: SparkSession, sf_dir: str, target: DataFrame) -> DataFrame:
    everything = latest_per_key(inputs.observations(spark, sf_dir), KEYS, "extracted_at", ["event_id"])
    tail = incremental_tail(everything.select(*FACT.fieldNames()), target, days=7)
    return tail.withColumn("value", F.col("value") + 1)


@query("merged_view", _MERGED)
def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _first_load(spark, sf_dir)
    return merged_view(target, _revised(spark, sf_dir, target), KEYS)


def _fact_table(spark: SparkSession) -> str:
    name = f"facts_{uuid.uuid4().hex}.events"
    ensure_table(spark, name, FACT, "month")
    return name


@query(
    "merge_first_run",
    f"WITH {inputs.OBSERVATIONS} SELECT user_id, event_type, date, value FROM ("
    + inputs.ranked_first("obs", "user_id, event_type, date", "extracted_at DESC, event_id DESC")
    + ")",
)
def merge_first_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty table takes the whole source."""
    table = _fact_table(spark)
    source = latest_per_key(inputs.observations(spark, sf_dir), KEYS, "extracted_at", ["event_id"])
    tail = incremental_tail(source.select(*FACT.fieldNames()), spark.table(table), days=7)
    merge_upsert(spark, table, tail, KEYS, cluster=["user_id"])
    return spark.table(table).select(*FACT.fieldNames())


@query("merge_upsert", _MERGED)
def merge_second_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two merges into a written table, the second over a trailing window."""
    table = _fact_table(spark)
    merge_upsert(spark, table, _first_load(spark, sf_dir), KEYS, cluster=["user_id"], unique_source=True)
    revised = _revised(spark, sf_dir, spark.table(table))
    merge_upsert(spark, table, revised, KEYS, cluster=["user_id"])
    return spark.table(table).select(*FACT.fieldNames())


LOADED_FACT = T.StructType([*FACT.fields, T.StructField("_loaded_at", T.TimestampType())])


@query(
    "merge_load_time",
    f"WITH {_SECOND} SELECT *, TIMESTAMP '2024-02-02 06:00:00' AS _loaded_at FROM src UNION ALL "
    "SELECT *, TIMESTAMP '2024-02-01' AS _loaded_at FROM tgt WHERE NOT EXISTS (SELECT 1 FROM src "
    "WHERE src.user_id = tgt.user_id AND src.event_type = tgt.event_type AND src.date = tgt.date)",
)
def merge_load_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two merges under a fixed clock: a row bears the time of the merge that wrote it last."""
    table = f"facts_{uuid.uuid4().hex}.events"
    ensure_table(spark, table, LOADED_FACT, "month")
    first, second = (dt.datetime(2024, 2, *at, tzinfo=dt.timezone.utc) for at in ((1,), (2, 6)))
    merge_upsert(spark, table, with_load_time(_first_load(spark, sf_dir), first), KEYS, unique_source=True)
    revised = _revised(spark, sf_dir, spark.table(table).select(*FACT.fieldNames()))
    merge_upsert(spark, table, with_load_time(revised, second), KEYS)
    rows = spark.table(table)
    return rows.select(*FACT.fieldNames(), F.col("_loaded_at").cast("timestamp_ntz").alias("_loaded_at"))


def _orders_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderdate")).alias("ordered"),
    )


_GAPS = (
    "WITH gaps AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price, "
    "CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderdate END AS ordered FROM orders) "
)


@query(
    "check_not_null",
    _GAPS + "SELECT 'o_orderkey' AS \"column\", count(*) FILTER (o_orderkey IS NULL) AS violations FROM gaps "
    "UNION ALL SELECT 'price', count(*) FILTER (price IS NULL) FROM gaps "
    "UNION ALL SELECT 'ordered', count(*) FILTER (ordered IS NULL) FROM gaps",
)
def not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_not_null(_orders_with_gaps(spark, sf_dir), ["o_orderkey", "price", "ordered"])


@query(
    "check_unique",
    _GAPS + 'SELECT ordered, count(*) AS "count" FROM gaps WHERE ordered IS NOT NULL GROUP BY 1 '
    "HAVING count(*) > 1",
)
def unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_unique(_orders_with_gaps(spark, sf_dir), ["ordered"])


@query(
    "check_unique_combination",
    'SELECT l_orderkey, l_linenumber, count(*) AS "count" FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1',
)
def unique_combination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_unique(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "check_expression",
    _GAPS + "SELECT * FROM gaps WHERE NOT (price IS NULL OR (ordered IS NOT NULL AND price < 200000))",
)
def expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = "price IS NULL OR (ordered IS NOT NULL AND price < 200000)"
    return check_expression(_orders_with_gaps(spark, sf_dir), rule)


@query(
    "check_freshness",
    "SELECT max(ts) AS newest, CASE WHEN max(ts) IS NULL OR max(ts) < TIMESTAMP '2024-02-04' - INTERVAL 7 DAY "
    "THEN 'error' WHEN max(ts) < TIMESTAMP '2024-02-04' - INTERVAL 2 DAY THEN 'warn' ELSE 'pass' END AS status "
    "FROM events",
)
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = dt.datetime(2024, 2, 4, tzinfo=dt.timezone.utc)
    return check_freshness(read(spark, sf_dir, "events"), "ts", now=now)


@query(
    "check_summary",
    "WITH found AS (SELECT 'orders unique' AS name, (SELECT count(*) FROM (SELECT o_orderkey FROM orders "
    "GROUP BY 1 HAVING count(*) > 1)) AS violations UNION ALL SELECT 'lines unique', (SELECT count(*) FROM "
    "(SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) UNION ALL SELECT "
    "'lines not null', (SELECT count(*) FILTER (l_orderkey IS NULL) + count(*) FILTER (l_tax IS NULL) FROM "
    "lineitem) UNION ALL SELECT 'discount rule', (SELECT count(*) FROM lineitem WHERE NOT (l_discount < 0.09))) "
    "SELECT name, CAST(violations AS BIGINT) AS violations, CASE WHEN violations > 0 THEN 'fail' ELSE 'pass' END "
    "AS status FROM found",
)
def check_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = read(spark, sf_dir, "orders"), read(spark, sf_dir, "lineitem")
    return summarise(
        {
            "orders unique": check_unique(orders, ["o_orderkey"]),
            "lines unique": check_unique(lines, ["l_orderkey", "l_linenumber"]),
            "lines not null": check_not_null(lines, ["l_orderkey", "l_tax"]),
            "discount rule": check_expression(lines, F.col("l_discount") < 0.09),
        }
    )


# A run over all customers: all orders landed, customers in debt were turned down.
_RUN = (
    f"WITH landed AS (SELECT o_custkey FROM (SELECT {inputs.OTHER_CUSTOMER} AS o_custkey FROM orders) WHERE NOT EXISTS "
    "(SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal < 0)), "
    "counts AS (SELECT o_custkey, count(*) AS n FROM landed GROUP BY 1), "
    "report AS (SELECT coalesce(c_custkey, o_custkey) AS c_custkey, coalesce(n, 0) AS rows, "
    "CASE WHEN c_acctbal < 0 THEN 'rejected' WHEN n > 0 THEN 'loaded' ELSE 'empty' END AS status "
    "FROM customer FULL JOIN counts ON c_custkey = o_custkey) "
)


def _run(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    rejected = customers.where(F.col("c_acctbal") < 0).select("c_custkey")
    orders = read(spark, sf_dir, "orders").select(inputs.other_customer().alias("c_custkey"))
    return customers.select("c_custkey"), orders.join(rejected, "c_custkey", "left_anti"), rejected


@query("run_report", _RUN + "SELECT c_custkey, rows, status FROM report")
def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_report(*_run(spark, sf_dir), "c_custkey")


@query(
    "run_verdict",
    _RUN + ", totals AS (SELECT count(*) AS keys, CAST(sum(rows) AS BIGINT) AS total_rows, "
    "count(*) FILTER (status = 'empty') AS empty_keys, count(*) FILTER (status = 'rejected') AS rejected_keys, "
    "count(*) FILTER (status = 'incomplete') AS incomplete_keys FROM report) SELECT *, CASE WHEN total_rows = 0 AND rejected_keys > 0 THEN 'failed' WHEN rejected_keys > 0 "
    "THEN 'loaded with rejected keys' WHEN total_rows = 0 THEN 'nothing new' ELSE 'loaded' END AS verdict "
    "FROM totals",
)
def verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_verdict(run_report(*_run(spark, sf_dir), "c_custkey"))


@query(
    "run_key_lists",
    _RUN + ", numbered AS (SELECT status, CAST(c_custkey AS VARCHAR) AS key, row_number() OVER (PARTITION BY "
    "status ORDER BY CAST(c_custkey AS VARCHAR)) AS n FROM report WHERE status <> 'loaded') "
    "SELECT status, CAST((n - 1) // 100 AS BIGINT) AS line, string_agg(key, ', ' ORDER BY key) AS keys "
    "FROM numbered GROUP BY 1, 2",
)
def lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_lists(run_report(*_run(spark, sf_dir), "c_custkey"), "c_custkey")


@query("empty_keys", _RUN + "SELECT c_custkey FROM report WHERE rows = 0")
def without_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys, landed, _ = _run(spark, sf_dir)
    return empty_keys(keys, landed, "c_custkey")
