"""Compare queries with their SQL, value by value: python -m tests.compare <sf dir> [query ...]"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((type(v).__name__, plain(v)) for v in (row[i] for i in order)) for row in rows)


def compare(spark, connection, sf_dir: str, function, sql: str) -> str | None:
    """None where both give the same rows, otherwise what differs."""
    df = function(spark, sf_dir)
    mine = rows_of(df.columns, df.collect())
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    theirs = rows_of(names, result.fetchall())
    if mine == theirs:
        return None
    more, less = mine - theirs, theirs - mine
    return (
        f"{mine.total()} against {theirs.total()} rows; only here {sum(more.values())}: "
        f"{list(more)[:2]}; only in SQL {sum(less.values())}: {list(less)[:2]}"
    )


def main() -> None:
    from tests.conftest import local_session
    from tideline.workload import ORACLES, QUERIES

    sf_dir, *names = sys.argv[1:]
    spark = local_session()
    connection = connect(sf_dir)
    bad = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            if name in ORACLES:
                found = compare(spark, connection, sf_dir, QUERIES[name], ORACLES[name])
            else:
                found = f"no SQL, {len(QUERIES[name](spark, sf_dir).collect())} rows"
        except Exception as error:  # noqa: BLE001 - shown and counted
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += found is not None
        print(f"{name:32s} {time.time() - start:6.2f}s {found or 'same'}", flush=True)
    print(f"{bad} of {len(names or QUERIES)} not the same")


if __name__ == "__main__":
    main()
