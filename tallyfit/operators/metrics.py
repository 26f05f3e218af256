"""Quality metrics as DataFrames, all derived from one aggregate over the predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .positions import with_earlier_totals


def confusion_matrix(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """``(label, prediction, rows)``."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("rows")
    )


def _share(part: Column, whole: Column) -> Column:
    """``part / whole``, and 0 where there is nothing to divide by."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)


def per_label_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """One row per true label: its rows and total, false and true positive rate, precision,
    recall and F-measure. A class that is never predicted has precision and F-measure 0."""
    confusion = confusion_matrix(df, label, prediction)
    hit = F.col("label") == F.col("prediction")
    # Each cell of the matrix counts for the class it belongs to and the class predicted.
    sides = F.array(
        F.struct(
            F.col("label").alias("label"),
            F.col("rows").alias("actual"),
            F.lit(0).cast("bigint").alias("predicted"),
            F.when(hit, F.col("rows")).otherwise(0).alias("tp"),
        ),
        F.struct(
            F.col("prediction").alias("label"),
            F.lit(0).cast("bigint").alias("actual"),
            F.col("rows").alias("predicted"),
            F.lit(0).cast("bigint").alias("tp"),
        ),
    )
    classes = confusion.select(F.inline(sides)).groupBy("label").agg(
        F.sum("actual").alias("actual"),
        F.sum("predicted").alias("predicted"),
        F.sum("tp").alias("tp"),
    )
    # The window runs over one row per class.
    classes = classes.withColumn("total", F.sum("actual").over(Window.partitionBy()))
    wrong = F.col("predicted") - F.col("tp")
    rates = classes.where("actual > 0").select(
        "label",
        F.col("actual").alias("rows"),
        "total",
        _share(wrong, F.col("total") - F.col("actual")).alias("fpr"),
        _share(F.col("tp"), F.col("actual")).alias("tpr"),
        _share(F.col("tp"), F.col("predicted")).alias("precision"),
        _share(F.col("tp"), F.col("actual")).alias("recall"),
    )
    harmonic = _share(2 * F.col("precision") * F.col("recall"),
                      F.col("precision") + F.col("recall"))
    return rates.withColumn("f_measure", harmonic)


def weighted_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """One row: accuracy and the per-label metrics weighted by the share of each label."""
    labels = per_label_metrics(df, label, prediction)

    def weighted(metric: str) -> Column:
        return F.sum(F.col(metric) * F.col("rows") / F.col("total")).alias(metric)

    return labels.agg(
        F.sum(F.col("tpr") * F.col("rows") / F.col("total")).alias("accuracy"),
        *[weighted(m) for m in ("fpr", "tpr", "f_measure", "precision", "recall")],
    )


def test_error(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: accuracy and ``1 - accuracy``."""
    accuracy = F.avg((F.col(label) == F.col(prediction)).cast("double"))
    return df.agg(accuracy.alias("accuracy"), (1 - accuracy).alias("test_error"))


test_error.__test__ = False  # the name is a metric, not a test case


def rmse(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: root of the mean squared difference."""
    gap = F.col(label) - F.col(prediction)
    return df.agg(F.sqrt(F.avg(gap * gap)).alias("rmse"))


def area_under_roc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row: area under the ROC curve of ``score`` for labels 0 and 1, ties counted half.

    Every positive counts the negatives scored below it. Rows are first summed up per
    score; the running count over scores is spread over all tasks.
    """
    positive = (F.col(label) == 1).cast("bigint")
    per_score = df.groupBy(F.col(score).alias("score")).agg(
        F.sum(positive).alias("positives"), F.sum(1 - positive).alias("negatives")
    )
    ranked = with_earlier_totals(per_score, ["score"], {"below": "negatives"})
    won = F.sum(F.col("positives").cast("double") * (F.col("below") + F.col("negatives") / 2))
    pairs = F.sum("positives").cast("double") * F.sum("negatives").cast("double")
    return ranked.agg((won / F.nullif(pairs, F.lit(0.0))).alias("area_under_roc"))
