"""User-defined text functions, for what the built-in functions do not offer."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def register_text_udf(
    spark: SparkSession, name: str, function: Callable[[pd.Series], pd.Series]
):
    """Register ``function`` (a series of texts to another) under ``name``, for columns too.

    Batches travel as Arrow columns and are handed over whole; null stays null. Prefer a built-in
    expression where one exists, as the optimiser cannot see into a user function.
    """

    @F.pandas_udf("string")
    def apply(texts: pd.Series) -> pd.Series:
        return function(texts).where(texts.notna(), None)

    return spark.udf.register(name, apply)
