"""Keep what a fit sends to the driver within bounds when a table has very many partitions, and
what one of its tasks holds when a table has few.

A fit adds up one partial result per partition in a tree. The last level goes to the driver:
about the n-th root of the partition count for a tree of depth n, all of them for depth 1.
Trees hold every row as a dense row of bins, which may be a hundred times what is stored, so a
partition of a usual size on disk can be too large for a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import limits

MAX_DEPTH = 8

# Bytes of a row that trees hold: a bin for each feature, and about this much beside them.
BIN_BYTES = 4
POINT_BYTES = 256


def tree_depth(df: DataFrame, partial_bytes: int) -> int:
    """The depth at which the last level fits ``limits.DRIVER_BYTES``; 2, the usual, or more."""
    partitions = df.rdd.getNumPartitions()
    depth = 2
    while depth < MAX_DEPTH and partitions ** (1 / depth) * partial_bytes > limits.DRIVER_BYTES:
        depth += 1
    return depth


def merge_partitions(df: DataFrame, partial_bytes: int, depth: int = 2) -> DataFrame:
    """For fits of fixed depth: fewer and longer tasks, without a shuffle, if there are too
    many partitions for the last level to fit."""
    most = int(max(1.0, limits.DRIVER_BYTES / partial_bytes) ** depth)
    return df.coalesce(min(most, 2**31 - 1))


def bound_partitions(df: DataFrame, features: int) -> DataFrame:
    """For fits of trees on a written table: more and shorter tasks if the binned rows of a
    partition exceed ``limits.TASK_BYTES``; else ``df`` as it is. All rows stay."""
    most = max(1, limits.TASK_BYTES // (features * BIN_BYTES + POINT_BYTES))
    sizes = df.groupBy(F.spark_partition_id().alias("part")).count()
    found = sizes.agg(F.max("count").alias("longest"), F.sum("count").alias("rows")).first()
    if (found["longest"] or 0) <= most:
        return df
    return df.repartition(-(-found["rows"] // most))
