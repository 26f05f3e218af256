"""Profiles of a table: missing values, class shares, schema, first rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..fixed_values import MISSING


def _counts_as_rows(df: DataFrame, counts: dict[str, Column], name: str) -> DataFrame:
    """One row per column from one aggregate over ``df``, so one pass for all columns."""
    wide = df.agg(*[count.cast("bigint").alias(c) for c, count in counts.items()])
    return wide.unpivot([], list(counts), "column", name)


def _is_number(text: str) -> bool:
    try:
        float(text)
    except ValueError:
        return False
    return True


def missing_profile(df: DataFrame, missing: str = MISSING) -> DataFrame:
    """``(column, Total)``: rows per column that hold the text ``missing``.

    Columns are compared as strings, since a number column cannot be compared with text
    in ANSI mode. No number prints as a text like ``NA``, so number columns count 0 without
    being read.
    """
    skip_numbers = not _is_number(missing)
    counts = {
        f.name: F.lit(0)
        if skip_numbers and isinstance(f.dataType, NumericType)
        else F.count_if(F.col(f.name).cast("string") == missing)
        for f in df.schema.fields
    }
    return _counts_as_rows(df, counts, "Total")


def value_counts_per_column(df: DataFrame) -> DataFrame:
    """``(column, rows)``: rows per column that are not null."""
    return _counts_as_rows(df, {c: F.count(c) for c in df.columns}, "rows")


def drop_columns_missing_in(
    profiled: DataFrame,
    *tables: DataFrame,
    always: Sequence[str] = (),
    missing: str = MISSING,
) -> list[DataFrame]:
    """Drop from all ``tables`` the columns with missing values in ``profiled``.

    Only names come to the driver, at most one per column. Names a table does not have
    are ignored.
    """
    found = missing_profile(profiled, missing).where("Total > 0").select("column").collect()
    names = [row["column"] for row in found] + list(always)
    return [table.drop(*names) for table in tables]


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """``(label, rows, share)`` per class, in one pass over ``df``.

    The window runs over one row per class, not over the data.
    """
    counts = df.groupBy(label).agg(F.count("*").alias("rows"))
    return counts.withColumn("share", F.col("rows") / F.sum("rows").over(Window.partitionBy()))


def schema_report(df: DataFrame) -> DataFrame:
    """``(column, type)`` of every field, from metadata alone."""
    rows = [(field.name, field.dataType.simpleString()) for field in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column string, type string")


def preview(df: DataFrame, n: int, *order_by: Column | str) -> DataFrame:
    """The first ``n`` rows in a stated order. End the order with a key to break ties."""
    return df.orderBy(*order_by).limit(n)
