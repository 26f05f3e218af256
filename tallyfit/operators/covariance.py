"""Covariance matrix of an array column."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import limits


def covariance_matrix(df: DataFrame, column: str) -> DataFrame:
    """``(i, j, covariance)``: the sample covariance of every pair of array positions.

    The first pass takes the means. In the second each task multiplies its centred rows and
    hands on one half matrix, however many rows it read; these are added up by position.
    Arrays wider than ``limits.COVARIANCE_WIDTH`` are cut into column blocks of that width,
    with one scan per pair of blocks, so that no task holds more than one block product.
    A table without arrays has no covariances.
    """
    arrays = df.where(F.col(column).isNotNull()).select(F.col(column).cast("array<double>"))
    summary = Summarizer.metrics("mean", "count").summary(array_to_vector(column))
    # One group: no rows give no summary, where a summary without a group is an error.
    head = arrays.groupBy(F.lit("all")).agg(summary.alias("s")).select("s.mean", "s.count").first()
    if head is None:
        return df.sparkSession.createDataFrame([], "i bigint, j bigint, covariance double")
    rows, mean = head["count"], head["mean"].toArray()
    starts = range(0, len(mean), limits.COVARIANCE_WIDTH)
    pairs = [(a, b) for a in starts for b in starts if a <= b]
    parts = reduce(DataFrame.union, [_block_products(arrays, column, mean, *p) for p in pairs])
    half = parts.groupBy("i", "j").agg((F.sum("product") / (rows - 1)).alias("covariance"))
    below = F.when(F.col("i") < F.col("j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j")))
    places = F.array_compact(F.array(F.struct("i", "j"), below))
    return half.select(F.inline(places), "covariance")


def _block_products(
    arrays: DataFrame, column: str, mean: np.ndarray, first: int, second: int
) -> DataFrame:
    """``(i, j, product)`` per task, for ``i <= j`` in the column blocks that start there."""
    means = [mean[start : start + limits.COVARIANCE_WIDTH] for start in (first, second)]
    blocks = arrays.select(
        F.slice(column, first + 1, len(means[0])).alias("a"),
        F.slice(column, second + 1, len(means[1])).alias("b"),
    )

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(means[0]), len(means[1])))
        for batch in batches:
            a, b = (
                batch.column(side).flatten().to_numpy().reshape(-1, len(means[side])) - means[side]
                for side in (0, 1)
            )
            total += a.T @ b
        i, j = np.indices(total.shape).reshape(2, -1)
        half = i + first <= j + second
        i, j = i[half], j[half]
        yield pa.RecordBatch.from_pydict(
            {"i": i + first, "j": j + second, "product": total[i, j]}
        )

    return blocks.mapInArrow(products, "i bigint, j bigint, product double")
