"""Where a row of a file scan comes from, and row numbers that follow from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import write_once

FILE, RANGE, ORDER = "_file", "_range", "_order"


def with_places(scan: DataFrame) -> DataFrame:
    """Add the file of each row, the byte at which its input split begins, and a number that
    grows along the split. ``scan`` must come straight from files."""
    return scan.select(
        "*", F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(RANGE),
        F.monotonically_increasing_id().alias(ORDER),
    )


def with_row_numbers(scan: DataFrame, name: str = "row_number") -> DataFrame:
    """Add the number of each row, from 0, in order of file path, place of the input split in
    the file, and place in the split.

    ``scan`` must come straight from files, whose rows are written down once with their places.
    Numbers do not depend on how the files are cut into splits, nor on the order of tasks.
    What is summed up and broadcast has one row for each split.
    """
    saved = write_once(with_places(scan), "places")
    splits = saved.groupBy(FILE, RANGE).agg(
        F.count("*").alias("_rows"), F.min(ORDER).alias("_first")
    )
    earlier = Window.orderBy(FILE, RANGE).rowsBetween(Window.unboundedPreceding, -1)
    before = splits.select(
        FILE, RANGE, "_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")
    )
    number = F.col("_before") + F.col(ORDER) - F.col("_first")
    joined = saved.join(F.broadcast(before), [FILE, RANGE])
    return joined.withColumn(name, number).drop(FILE, RANGE, ORDER, "_first", "_before")
