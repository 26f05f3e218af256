"""Positions and running totals over a whole table, without a one-task window.

The table is sorted over all tasks and written down with the number of the sort partition
and the place inside it. What lies before a partition is then a total over one row per
partition, a table small enough to broadcast by construction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import write_once

PLACE = "_place"
PART = "_part"
PLACE_BITS = 33  # monotonically_increasing_id keeps the partition number above these bits


def _sorted_once(df: DataFrame, order_by: Sequence[Column | str]) -> DataFrame:
    placed = df.orderBy(*order_by).withColumn(PLACE, F.monotonically_increasing_id())
    saved = write_once(placed, "sorted")
    return saved.withColumn(PART, F.shiftright(PLACE, PLACE_BITS))


def _before_each_part(saved: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """Per sort partition the totals of all partitions before it."""
    per_part = saved.groupBy(PART).agg(*[t.alias(name) for name, t in totals.items()])
    earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    return per_part.select(
        PART, *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(name) for name in totals]
    )


def with_position(
    df: DataFrame, order_by: Sequence[Column | str], name: str = "position"
) -> DataFrame:
    """Add the position of each row, from 0, in the given order of the whole table."""
    saved = _sorted_once(df, order_by)
    before = _before_each_part(saved, {"_before": F.count("*")})
    inside = F.col(PLACE).bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return (
        saved.join(F.broadcast(before), PART)
        .withColumn(name, F.col("_before") + inside)
        .drop(PART, PLACE, "_before")
    )


def with_earlier_totals(
    df: DataFrame, order_by: Sequence[Column | str], columns: dict[str, str]
) -> DataFrame:
    """Add, for each ``name: column`` pair, the sum of ``column`` over all earlier rows."""
    saved = _sorted_once(df, order_by)
    before = _before_each_part(saved, {f"_before_{c}": F.sum(c) for c in columns.values()})
    inside = (
        Window.partitionBy(PART).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, -1)
    )
    within = saved.select(
        "*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(n) for n, c in columns.items()]
    )
    joined = within.join(F.broadcast(before), PART)
    for name, column in columns.items():
        joined = joined.withColumn(name, F.col(name) + F.col(f"_before_{column}"))
    return joined.drop(PART, PLACE, *[f"_before_{c}" for c in columns.values()])
