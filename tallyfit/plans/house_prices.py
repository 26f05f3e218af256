"""Price regression on mixed columns: profile, drop, encode, assemble, tune."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml import PipelineModel, Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..fixed_values import (
    HOUSE_CATEGORIES,
    HOUSE_DROPPED,
    HOUSE_KEY,
    HOUSE_OUTLIER_BOUND,
    HOUSE_OUTLIER_COLUMN,
    HOUSE_TARGET,
    LINEAR_GRID,
    LINEAR_MAX_ITER,
    LINEAR_TRAIN_RATIO,
    TABULAR_SEED,
    TUNING_PARALLELISM,
)
from ..functions.text import hash_percent
from ..operators.cleaning import fill_numbers, keep_below
from ..operators.encoding import CategoryIndex
from ..operators.profiling import drop_columns_missing_in
from ..operators.splitting import split_by_key
from ..sources.scratch import write_once
from .fit_size import tree_depth
from .linear_grid import GRAM_WIDTH, LinearWeights, TunedLinear, combinations_of, tune_linear


@dataclass
class HousePrices:
    """What was fitted: category indexes, vector stages and the tuned regression."""

    key: str
    numbers: list[str]
    index: CategoryIndex
    vectors: PipelineModel
    tuned: TunedLinear

    def features(self, df: DataFrame) -> DataFrame:
        return self.vectors.transform(fill_numbers(self.index.transform(df), columns=self.numbers))


def house_columns(
    train: DataFrame,
    test: DataFrame,
    always: Sequence[str] = HOUSE_DROPPED,
    outlier: tuple[str, float] | None = (HOUSE_OUTLIER_COLUMN, HOUSE_OUTLIER_BOUND),
) -> tuple[DataFrame, DataFrame]:
    """Drop outlier rows of ``train``, and from both tables every column with missing values
    in ``test``."""
    if outlier is not None:
        train = keep_below(train, *outlier)
    train, test = drop_columns_missing_in(test, train, test, always=always)
    return train, test


def fit_house_prices(
    train: DataFrame,
    key: str = HOUSE_KEY,
    target: str = HOUSE_TARGET,
    categories: Sequence[str] = HOUSE_CATEGORIES,
    grid: dict = LINEAR_GRID,
    train_ratio: float = LINEAR_TRAIN_RATIO,
    seed: int = TABULAR_SEED,
    parallelism: int = TUNING_PARALLELISM,
) -> HousePrices:
    """Encode categories, put them beside all number columns, and tune a linear regression.

    Everything is fitted on the rows of ``train`` that have a target. Categories that a dropped
    column took away are left out, and values seen only later get an index of their own. Each
    combination of ``grid`` is fitted on about ``train_ratio`` of the rows and measured on the
    rest, a split that follows from the key and ``seed`` alone; the best is fitted on all rows.
    Up to ``GRAM_WIDTH`` features all of this takes one scan and ends at the optimum; wider
    rows are fitted once for each combination, with ``LINEAR_MAX_ITER`` iterations.
    If no row is left for measuring, or none for fitting, there is nothing to tune: an error.
    """
    train = train.where(F.col(target).isNotNull() & ~F.isnan(F.col(target).cast("double")))
    kept = [c for c in categories if c in train.columns]
    numbers = [
        f.name
        for f in train.schema.fields
        if isinstance(f.dataType, NumericType) and f.name not in {key, target, *kept}
    ]
    index = CategoryIndex(kept).fit(train)
    encoder = OneHotEncoder(
        inputCols=index.output_columns,
        outputCols=[c + "Vec" for c in kept],
        handleInvalid="keep",
    )
    assembler = VectorAssembler(
        inputCols=encoder.getOutputCols() + numbers, outputCol="features"
    )
    indexed = fill_numbers(index.transform(train), columns=numbers)
    vectors = Pipeline(stages=[encoder, assembler]).fit(indexed)
    rows = vectors.transform(indexed).select(key, F.col(target).alias("label"), "features")
    rows = write_once(rows, "house-vectors")
    percent = round(100 * train_ratio)
    first = rows.first()
    if first is None:
        raise ValueError(f"no row has a value for {target}")
    if first["features"].size <= GRAM_WIDTH:
        held_out = hash_percent(key, str(seed)) >= percent
        tuned = tune_linear(rows, held_out, grid)
    else:
        parts = split_by_key(rows, key, percent, salt=str(seed))
        tuned = _fit_each(rows, *parts, grid, first["features"].size, parallelism)
    return HousePrices(key, numbers, index, vectors, tuned)


def _fit_each(
    rows: DataFrame, train: DataFrame, rest: DataFrame, grid: dict, width: int, parallelism: int
) -> TunedLinear:
    """What ``tune_linear`` does, by one fit for each combination; tasks hold vectors only."""
    if train.isEmpty() or rest.isEmpty():
        raise ValueError("tuning needs rows to fit and rows to measure on")
    regression = LinearRegression(
        maxIter=LINEAR_MAX_ITER, solver="l-bfgs", aggregationDepth=tree_depth(rows, 48 * width))
    evaluator = RegressionEvaluator(metricName="rmse")
    combinations = combinations_of(grid)

    def fit(part: DataFrame, settings: dict) -> LinearRegressionModel:
        return regression.copy({regression.getParam(k): v for k, v in settings.items()}).fit(part)

    def measure(settings: dict) -> float:
        return evaluator.evaluate(fit(train, settings).transform(rest))

    with ThreadPool(min(parallelism, len(combinations))) as pool:
        metrics = pool.map(measure, combinations)
    best = fit(rows, combinations[min(range(len(metrics)), key=metrics.__getitem__)])
    weights = LinearWeights(best.coefficients.toArray(), best.intercept)
    return TunedLinear(combinations, metrics, weights)


def predict_house_prices(
    model: HousePrices, test: DataFrame, target: str = HOUSE_TARGET
) -> DataFrame:
    """``(key, target)``: the predicted price beside the key of its row."""
    scored = model.tuned.transform(model.features(test).select(model.key, "features"))
    return scored.select(model.key, scored["prediction"].alias(target))
