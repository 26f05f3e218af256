"""What a fitted model says about itself, as DataFrames.

All of it is model state, which the driver holds already and whose size does not depend
on the number of rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegressionModel, RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession

from .linear_grid import TunedLinear
from .text_tuning import TunedLogistic


def coefficients(spark: SparkSession, model: LogisticRegressionModel) -> DataFrame:
    """``(class, feature, value)``; feature -1 is the intercept of the class."""
    weights = model.coefficientMatrix.toArray()
    table = np.column_stack([model.interceptVector.toArray(), weights])
    classes, width = table.shape
    rows = pd.DataFrame({
        "class": np.repeat(np.arange(classes), width),
        "feature": np.tile(np.arange(-1, width - 1), classes),
        "value": table.ravel(),
    })
    return spark.createDataFrame(rows, "class bigint, feature bigint, value double")


def loss_history(spark: SparkSession, model: LogisticRegressionModel) -> DataFrame:
    """``(iteration, loss)`` of the fit, on the training rows."""
    losses = enumerate(float(x) for x in model.summary.objectiveHistory)
    return spark.createDataFrame(list(losses), "iteration bigint, loss double")


def forest_summary(spark: SparkSession, model: RandomForestClassificationModel) -> DataFrame:
    """``(tree, nodes, depth, description)`` for each tree of the forest."""
    rows = [(i, t.numNodes, t.depth, t.toDebugString) for i, t in enumerate(model.trees)]
    return spark.createDataFrame(
        rows, "tree bigint, nodes bigint, depth bigint, description string"
    )


def tuning_results(spark: SparkSession, model: TunedLinear | TunedLogistic) -> DataFrame:
    """``(combination, parameter, setting, metric)`` for each tried parameter combination."""
    rows = [
        (i, name, str(setting).lower(), float(metric))
        for i, (settings, metric) in enumerate(zip(model.combinations, model.metrics))
        for name, setting in settings.items()
    ]
    return spark.createDataFrame(
        rows, "combination bigint, parameter string, setting string, metric double"
    )
