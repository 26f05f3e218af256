"""Filters, null fills and casts that come before features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_below(df: DataFrame, column: str, bound: float) -> DataFrame:
    """Drop outliers: rows at or above ``bound``, and rows without a value."""
    return df.where(F.col(column) < bound)


def fill_text(df: DataFrame, value: str = "") -> DataFrame:
    """Replace nulls in string columns only. Comes before tokenising, which needs text."""
    return df.na.fill(value)


def fill_numbers(
    df: DataFrame, value: float = 0, columns: Sequence[str] | None = None
) -> DataFrame:
    """Replace nulls in numeric columns only: in all of them, or in those of ``columns``."""
    return df.na.fill(value, None if columns is None else list(columns))


def cast_label(df: DataFrame, source: str, label: str = "label") -> DataFrame:
    """Rename ``source`` to ``label`` as a double; what is no number becomes 0.

    ``try_cast`` keeps this working in ANSI mode, where a plain cast of ``""`` fails.
    """
    renamed = df.withColumnRenamed(source, label)
    return renamed.withColumn(label, F.col(label).try_cast("double")).na.fill(0, [label])
