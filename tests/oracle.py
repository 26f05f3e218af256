"""Compare a query with its SQL: names, row count and values in any order.

Run as ``python -m tests.oracle FOLDER [NAME ...]`` for a table of results and times.
"""

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def _plain(value):
    if value is None or isinstance(value, str):
        return (value is not None, str(value))
    if isinstance(value, float) and not math.isnan(value):
        return (True, f"{value:.9g}")
    return (True, str(value))


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, connection, sql):
    """None if equal, else what differs."""
    spark_rows = [tuple(row) for row in df.collect()]
    result = connection.execute(sql)
    columns = [c[0] for c in result.description]
    sql_rows = result.fetchall()
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} and {sorted(columns)}"
    if len(spark_rows) != len(sql_rows):
        return f"{len(spark_rows)} and {len(sql_rows)} rows"
    types = {type(v) for row in sql_rows[:1] for v in row}
    kinds = [type(v).__name__ for v in (spark_rows[0] if spark_rows else ())]
    left, right = _rows(df.columns, spark_rows), _rows(columns, sql_rows)
    for a, b in zip(left, right):
        if a != b:
            return f"{str(a)[:300]} and {str(b)[:300]} ({kinds}, {types})"
    if spark_rows and sql_rows:
        a = dict(zip(df.columns, map(type, spark_rows[0])))
        b = dict(zip(columns, map(type, sql_rows[0])))
        odd = {c: (a[c].__name__, b[c].__name__) for c in a
               if a[c] is not b[c] and type(None) not in (a[c], b[c])}
        if odd:
            return f"types {odd}"
    return None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    from tallyfit.catalog import ORACLES, QUERIES

    folder, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    database = connect(folder)
    for name in names:
        start = time.time()
        try:
            frame = QUERIES[name](session, folder)
            if name in ORACLES:
                state = compare(frame, database, ORACLES[name]) or "equal"
            else:
                state = f"rows only: {len(frame.collect())}"
        except Exception as error:  # noqa: BLE001
            state = f"FAILED {str(error)[:1500]}"
        print(f"{name:28s} {time.time() - start:6.2f}s {state}", flush=True)
    session.stop()
