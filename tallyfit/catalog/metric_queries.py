"""Quality metrics. The predictions come from rules or lines that SQL can compute too."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import (
    area_under_roc,
    confusion_matrix,
    per_label_metrics,
    rmse,
    test_error,
    weighted_metrics,
)
from ..sources import load
from .registry import query

_RULE = """WITH p AS (SELECT l_returnflag AS label, CASE WHEN l_quantity < 15 THEN 'A'
                             WHEN l_quantity < 35 THEN 'N' ELSE 'R' END AS prediction
                      FROM lineitem)"""
_LABELS = _RULE + """,
    t AS (SELECT count(*) AS total FROM p),
    c AS (SELECT l.label, total, (SELECT count(*) FROM p WHERE p.label = l.label) AS rows,
                 (SELECT count(*) FROM p WHERE p.prediction = l.label) AS predicted,
                 (SELECT count(*) FROM p WHERE p.label = l.label AND p.prediction = l.label) AS tp
          FROM (SELECT DISTINCT label FROM p) l, t),
    r AS (SELECT label, rows, total,
                 coalesce((predicted - tp) / nullif(total - rows, 0), 0) AS fpr,
                 tp / rows AS tpr, coalesce(tp / nullif(predicted, 0), 0) AS precision,
                 tp / rows AS recall FROM c),
    m AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0)
                    AS f_measure FROM r)"""


def rule_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """The return flag of each line, guessed from its quantity."""
    return load(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("label"),
        F.when(F.col("l_quantity") < 15, "A")
        .when(F.col("l_quantity") < 35, "N")
        .otherwise("R")
        .alias("prediction"),
    )


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 9) for n in names})


@query(
    "confusion_matrix",
    f"{_RULE} SELECT label, prediction, count(*) AS rows FROM p GROUP BY label, prediction",
)
def confusion(spark: SparkSession, folder: str) -> DataFrame:
    return confusion_matrix(rule_predictions(spark, folder))


@query(
    "per_label_metrics",
    f"""{_LABELS} SELECT label, rows, total, round(fpr, 9) AS fpr, round(tpr, 9) AS tpr,
                         round(precision, 9) AS precision, round(recall, 9) AS recall,
                         round(f_measure, 9) AS f_measure FROM m""",
)
def label_metrics(spark: SparkSession, folder: str) -> DataFrame:
    metrics = per_label_metrics(rule_predictions(spark, folder))
    return _rounded(metrics, "fpr", "tpr", "precision", "recall", "f_measure")


@query(
    "weighted_metrics",
    f"""{_LABELS} SELECT round(sum(tpr * rows / total), 9) AS accuracy,
                         round(sum(fpr * rows / total), 9) AS fpr,
                         round(sum(tpr * rows / total), 9) AS tpr,
                         round(sum(f_measure * rows / total), 9) AS f_measure,
                         round(sum(precision * rows / total), 9) AS precision,
                         round(sum(recall * rows / total), 9) AS recall FROM m""",
)
def overall_metrics(spark: SparkSession, folder: str) -> DataFrame:
    metrics = weighted_metrics(rule_predictions(spark, folder))
    return _rounded(metrics, *metrics.columns)


@query(
    "test_error",
    f"""{_RULE} SELECT round(avg((label = prediction)::int), 9) AS accuracy,
                       round(1 - avg((label = prediction)::int), 9) AS test_error FROM p""",
)
def rule_error(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(test_error(rule_predictions(spark, folder)), "accuracy", "test_error")


@query(
    "regression_rmse",
    """WITH line AS (SELECT regr_slope(l_extendedprice, l_quantity) AS slope,
                            regr_intercept(l_extendedprice, l_quantity) AS start FROM lineitem)
       SELECT round(sqrt(avg(power(l_extendedprice - start - slope * l_quantity, 2))), 4) AS rmse
       FROM lineitem, line""",
)
def line_rmse(spark: SparkSession, folder: str) -> DataFrame:
    rows = load(spark, folder, "lineitem").select("l_quantity", "l_extendedprice")
    rows = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(rows)
    model = LinearRegression(labelCol="l_extendedprice").fit(rows)
    return rmse(model.transform(rows), "l_extendedprice").withColumn("rmse", F.round("rmse", 4))


@query(
    "binary_auc",
    """WITH s AS (SELECT l_extendedprice AS score, count(*) FILTER (l_linestatus = 'F') AS np,
                         count(*) FILTER (l_linestatus <> 'F') AS nn
                  FROM lineitem GROUP BY l_extendedprice),
            r AS (SELECT *, coalesce(sum(nn) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING
                                                   AND 1 PRECEDING), 0) AS below FROM s)
       SELECT round(sum(np::double * (below::double + nn / 2))
                    / (sum(np)::double * sum(nn)::double), 9) AS area_under_roc FROM r""",
)
def binary_auc(spark: SparkSession, folder: str) -> DataFrame:
    rows = load(spark, folder, "lineitem").select(
        (F.col("l_linestatus") == "F").cast("int").alias("label"),
        F.col("l_extendedprice").alias("score"),
    )
    area = area_under_roc(rows)
    return area.withColumn("area_under_roc", F.round("area_under_roc", 9))
