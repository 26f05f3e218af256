"""Metrics against pyspark's own and against hand counts."""

import pytest
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.sql import functions as F

from tallyfit.operators import (
    area_under_roc,
    confusion_matrix,
    per_label_metrics,
    rmse,
    test_error,
    weighted_metrics,
)
from tallyfit.sources import literal_table


@pytest.fixture
def guesses(spark):
    h = F.pmod(F.xxhash64("id"), F.lit(10))
    return spark.range(500).select(
        (F.col("id") % 3).cast("double").alias("label"),
        F.when(h < 6, F.col("id") % 3).otherwise(h % 3).cast("double").alias("prediction"),
    )


def test_against_multiclass_evaluator(guesses):
    ours = weighted_metrics(guesses).first()
    names = {"accuracy": "accuracy", "fpr": "weightedFalsePositiveRate",
             "tpr": "weightedTruePositiveRate", "f_measure": "weightedFMeasure",
             "precision": "weightedPrecision", "recall": "weightedRecall"}
    for name, spark_name in names.items():
        assert ours[name] == pytest.approx(
            MulticlassClassificationEvaluator(metricName=spark_name).evaluate(guesses))
    labels = {r.label: r for r in per_label_metrics(guesses).collect()}
    for label in (0.0, 1.0, 2.0):
        for name, spark_name in {"fpr": "falsePositiveRateByLabel",
                                 "tpr": "truePositiveRateByLabel",
                                 "precision": "precisionByLabel", "recall": "recallByLabel",
                                 "f_measure": "fMeasureByLabel"}.items():
            evaluator = MulticlassClassificationEvaluator(metricName=spark_name, metricLabel=label)
            assert labels[label][name] == pytest.approx(evaluator.evaluate(guesses))
    error = test_error(guesses).first()
    assert error.accuracy == pytest.approx(ours["accuracy"])
    assert error.test_error == pytest.approx(1 - ours["accuracy"])


def test_class_that_is_never_predicted(spark):
    df = literal_table(spark, [(0.0, 0.0)] * 9 + [(1.0, 0.0)], "label double, prediction double")
    labels = {r.label: r for r in per_label_metrics(df).collect()}
    assert (labels[1.0].precision, labels[1.0].recall, labels[1.0].f_measure) == (0, 0, 0)
    assert labels[0.0].fpr == 1.0 and labels[0.0].precision == pytest.approx(0.9)


def test_one_class_only(spark):
    df = literal_table(spark, [(0.0, 0.0)] * 3, "label double, prediction double")
    row = per_label_metrics(df).first()
    assert (row.fpr, row.tpr, row.precision, row.f_measure) == (0, 1, 1, 1)


def test_predicted_class_without_a_label_is_no_row(spark):
    df = literal_table(spark, [("a", "a"), ("a", "z")], "label string, prediction string")
    assert [r.label for r in per_label_metrics(df).collect()] == ["a"]
    assert confusion_matrix(df).count() == 2


@pytest.mark.parametrize("distinct", [5, 900])
def test_auc_against_evaluator(spark, distinct):
    df = spark.range(2000).select(
        F.when(F.pmod(F.xxhash64("id"), F.lit(9)) < 3, 1.0).otherwise(0.0).alias("label"),
        (F.pmod(F.xxhash64(F.col("id") + 1), F.lit(distinct)) / 7.0).alias("score"),
    )
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    assert area_under_roc(df).first()[0] == pytest.approx(evaluator.evaluate(df))


def test_auc_without_positives_is_null(spark):
    df = literal_table(spark, [(0.0, 0.3)], "label double, score double")
    assert area_under_roc(df).first()[0] is None


def test_rmse_against_evaluator(spark):
    df = spark.range(100).select(
        F.col("id").cast("double").alias("label"), F.sqrt("id").alias("prediction"))
    assert rmse(df).first()[0] == pytest.approx(RegressionEvaluator().evaluate(df))
