"""Choosing features by how much they tell about a label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .attaching import attach_lookup


def chi_squared(entries: DataFrame, labels: DataFrame, feature: str, label: str) -> DataFrame:
    """``(feature, rows, chi_squared)`` of the table present/absent by label, for each feature.

    ``entries`` has a row for each feature that a row of data has, with the row's label;
    ``labels`` a row for each row of data. Rows without a label count nowhere. A feature that
    all rows have says nothing: 0.

    With ``p`` of ``n`` rows that have the feature, ``p_c`` of the ``n_c`` rows of a class, and
    ``q`` the sum of ``p_c * p_c / n_c``, the statistic is ``n (n q - p p) / (p (n - p))``. So
    one count for each feature and class is all that is shuffled, and absent features are
    never listed.
    """
    known = labels.where(F.col(label).isNotNull())
    classes = known.groupBy(label).agg(F.count("*").alias("_class_rows"))
    total = F.lit(float(known.count()))
    counts = entries.where(F.col(label).isNotNull()).groupBy(feature, label).agg(
        F.count("*").alias("_n"))
    weighed = attach_lookup(counts, classes, label, "_class_rows")
    p, q = F.col("rows").cast("double"), F.col("_q")
    found = weighed.groupBy(feature).agg(
        F.sum("_n").alias("rows"),
        F.sum(F.col("_n").cast("double") * F.col("_n") / F.col("_class_rows")).alias("_q"))
    statistic = F.when(p < total, total * (total * q - p * p) / (p * (total - p))).otherwise(0.0)
    return found.select(feature, "rows", statistic.alias("chi_squared"))


def best_features(scored: DataFrame, feature: str, count: int) -> DataFrame:
    """The ``count`` features with the largest statistic, ties in order of the feature; each
    task keeps that many rows, which are then merged."""
    return scored.orderBy(F.desc("chi_squared"), feature).limit(count)
