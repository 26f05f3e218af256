"""The loss and gradient of a logistic regression, computed from tables.

A fitted model holds its weights in one array on the driver and in every task. Here weights are
a table, joined to the entries of the rows by feature, so they may be too many to broadcast; and
what a fit reports can be checked against the data it was fitted on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.attaching import attach_lookup
from ..sources.scratch import write_once


@dataclass
class Objective:
    """``loss`` is the mean log loss plus the penalty; ``gradient (position, gradient)`` that of
    the mean log loss by each weight whose feature some row has, ``intercept`` by the
    intercept."""

    loss: float
    penalty: float
    gradient: DataFrame
    intercept: float


def model_weights(spark: SparkSession, model: LogisticRegressionModel) -> DataFrame:
    """``(position, weight)`` of a two-class model, without weights of zero."""
    weights = model.coefficients
    pairs = [(int(i), float(weights[int(i)])) for i in weights.toArray().nonzero()[0]]
    return spark.createDataFrame(pairs, "position int, weight double")


def feature_scales(entries: DataFrame, rows: int) -> DataFrame:
    """``(position, scale)``: the sample standard deviation of each feature, absent entries
    being zeros."""
    square = F.sum(F.col("value") * F.col("value"))
    variance = (square - F.sum("value") * F.sum("value") / rows) / max(1, rows - 1)
    return entries.groupBy("position").agg(
        F.sqrt(F.greatest(variance, F.lit(0.0))).alias("scale"))


def logistic_objective(
    entries: DataFrame,
    labels: DataFrame,
    weights: DataFrame,
    intercept: float,
    key: str,
    reg_param: float = 0.0,
    elastic_net: float = 0.0,
) -> Objective:
    """Evaluate weights ``(position, weight)`` on rows given as ``entries (key, position,
    value)`` and ``labels (key, label)`` with labels 0 and 1; a row without entries has the
    intercept alone, a feature without a weight counts nothing.

    The penalty is that of a fit with standardised features: it acts on weight times standard
    deviation. Rows and features are joined by shuffles unless one side is small; a feature that
    very many rows have is joined without moving them.
    """
    known = labels.where(F.col("label").isNotNull())
    rows = known.count()
    if not rows:
        raise ValueError("no labelled rows")
    weighed = attach_lookup(entries, weights, "position", "weight", 0.0)
    sums = weighed.groupBy(key).agg(F.sum(F.col("value") * F.col("weight")).alias("_sum"))
    margin = F.coalesce(F.col("_sum"), F.lit(0.0)) + F.lit(float(intercept))
    scored = known.join(sums, key, "left").select(key, "label", margin.alias("margin"))
    residual = 1 / (1 + F.exp(-F.col("margin"))) - F.col("label")
    scored = write_once(scored.withColumn("residual", residual), "margins")
    m = F.col("margin")
    row_loss = F.greatest(m, F.lit(0.0)) - m * F.col("label") + F.log1p(F.exp(-F.abs(m)))
    total = scored.agg(F.avg(row_loss).alias("loss"), F.avg("residual").alias("r")).first()
    moved = entries.join(scored.select(key, "residual"), key)
    gradient = moved.groupBy("position").agg(
        (F.sum(F.col("value") * F.col("residual")) / rows).alias("gradient"))
    penalty = 0.0
    if reg_param:
        kept = entries.join(known.select(key), key, "left_semi")
        scaled = weights.join(feature_scales(kept, rows), "position")
        step = F.col("weight") * F.col("scale")
        parts = elastic_net * F.abs(step) + (1 - elastic_net) / 2 * step * step
        penalty = reg_param * (scaled.agg(F.sum(parts)).first()[0] or 0.0)
    return Objective(float(total["loss"]) + penalty, penalty, gradient, float(total["r"]))
