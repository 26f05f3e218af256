"""Names of queries, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function ``(spark, folder) -> DataFrame``, with equivalent SQL if any."""

    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def sql_hash(key: str, salt: str = "") -> str:
    """SQL twin of ``functions.hash_number``."""
    return f"('0x' || substr(md5('{salt}' || {key}::varchar), 1, 8))::bigint"


def sql_percent(key: str, salt: str = "") -> str:
    """SQL twin of ``functions.hash_percent``."""
    return f"({sql_hash(key, salt)} % 100)"
