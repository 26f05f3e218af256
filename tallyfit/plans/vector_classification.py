"""Classification of number vectors through their principal components."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame

from ..fixed_values import COMPONENTS, TABULAR_LOGISTIC


def with_vector(df: DataFrame, array: str, name: str = "features") -> DataFrame:
    """Replace an array column by a vector column."""
    return df.withColumn(name, array_to_vector(df[array])).drop(array)


def project_components(df: DataFrame, vector: str, k: int = COMPONENTS) -> PCAModel:
    """Fit the first ``k`` principal components; the model adds ``pcaFeatures``."""
    return PCA(k=k, inputCol=vector, outputCol="pcaFeatures").fit(df)


def fit_component_logistic(
    train: DataFrame,
    vector: str = "features",
    label: str = "label",
    k: int = COMPONENTS,
    settings: dict = TABULAR_LOGISTIC,
) -> PipelineModel:
    """Principal components, then logistic regression on them."""
    return Pipeline(stages=[
        PCA(k=k, inputCol=vector, outputCol="pcaFeatures"),
        LogisticRegression(featuresCol="pcaFeatures", labelCol=label, **settings),
    ]).fit(train)
