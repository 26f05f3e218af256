"""Linear regressions for a whole grid of settings from one scan of the rows.

What a linear regression needs to know of its rows is the matrix of their second moments.
Each task adds up the matrix of its rows for both parts of a split, the matrices are added
by row, and every combination is solved and measured from them: a fit on one part, its error
on the other, and the final fit on the sum of both read no row again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import product
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Features up to which two matrices of moments are held by a task and by the driver.
GRAM_WIDTH = 2048

_SLICE_BYTES = 16 * 1024 * 1024  # rows made dense at once in a task
_TOLERANCE = 1e-9
_SWEEPS = 10_000
_PROBE = 10  # sweeps between attempts to solve for the weights that are not zero


@dataclass
class Moments:
    """Second moments of ``(1, features - origin, label - origin)``, summed over rows."""

    matrix: np.ndarray
    origin: np.ndarray

    @property
    def rows(self) -> float:
        return self.matrix[0, 0]

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.matrix + other.matrix, self.origin)


@dataclass
class LinearWeights:
    coefficients: np.ndarray
    intercept: float

    def prediction(self, features: str = "features") -> Column:
        """The prediction for a vector column; of a sparse one only the stored entries count."""
        vector = F.unwrap_udt(features)
        weights = F.lit(self.coefficients)
        entries = F.zip_with(
            vector["values"], vector["indices"], lambda v, i: v * F.get(weights, i)
        )
        dense = F.zip_with(vector["values"], weights, lambda v, w: v * w)
        terms = F.when(vector["type"] == 0, entries).otherwise(dense)
        return F.aggregate(terms, F.lit(float(self.intercept)), lambda total, t: total + t)


@dataclass
class TunedLinear:
    """Tried settings, the validation error of each, and the best one fitted on all rows."""

    combinations: list[dict[str, Any]]
    metrics: list[float]
    best: LinearWeights

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        return df.withColumn("prediction", self.best.prediction(features))


def combinations_of(grid: dict[str, Sequence]) -> list[dict[str, Any]]:
    """Every combination of the values in ``grid``."""
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def part_moments(
    rows: DataFrame, part: Column, features: str = "features", label: str = "label"
) -> dict[int, Moments]:
    """The moments of the rows in each part, in one scan; ``part`` is a small integer.

    Sums are taken about the first row found, so that large means do not cost digits. A task
    takes only the stored entries of sparse vectors, holds one matrix for each part and a
    bounded slice of dense rows, and hands on one row of numbers for each matrix row; these are
    added before and after the shuffle.
    """
    vector, target = F.unwrap_udt(features), F.col(label).cast("double")
    first = rows.select(vector_to_array(features).alias("x"), target.alias("y")).first()
    if first is None:
        return {}
    origin = np.array([0.0, *first["x"], first["y"]])
    places = F.when(vector["type"] == 0, vector["indices"]).otherwise(
        F.sequence(F.lit(0), F.size(vector["values"]) - 1))
    whole = rows.select(
        part.cast("int").alias("part"), places.alias("places"), vector["values"].alias("x"),
        target.alias("y"))
    width = len(origin)
    step = max(1, _SLICE_BYTES // (8 * width))

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                piece = batch.slice(start, step)
                numbers = piece.column("part").to_numpy()
                z = np.zeros((piece.num_rows, width))
                z[:, 0] = 1.0
                entries = piece.column("x")
                row = np.repeat(np.arange(piece.num_rows), entries.value_lengths().to_numpy())
                z[row, 1 + piece.column("places").flatten().to_numpy()] = (
                    entries.flatten().to_numpy())
                z[:, -1] = piece.column("y").to_numpy()
                z -= origin
                for n in np.unique(numbers):
                    chosen = z[numbers == n]
                    total = totals.setdefault(int(n), np.zeros((width, width)))
                    total += chosen.T @ chosen
        for n, total in totals.items():
            for i in range(0, width, 256):
                some = total[i:i + 256]
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([n] * len(some), pa.int32()),
                    "i": pa.array(range(i, i + len(some)), pa.int32()),
                    "sums": pa.array(list(some), pa.list_(pa.float64())),
                })

    partial = whole.mapInArrow(moments, "part int, i int, sums array<double>")
    added = partial.groupBy("part", "i").agg(
        Summarizer.metrics("sum").summary(array_to_vector(F.col("sums"))).alias("s"))
    found: dict[int, Moments] = {}
    for row in added.select("part", "i", vector_to_array("s.sum").alias("sums")).toLocalIterator():
        of_part = found.setdefault(row["part"], Moments(np.zeros((width, width)), origin))
        of_part.matrix[row["i"]] = row["sums"]
    return found


def solve_linear(
    moments: Moments,
    regParam: float = 0.0,
    elasticNetParam: float = 0.0,
    fitIntercept: bool = True,
) -> LinearWeights:
    """The weights with the least squared error and elastic-net penalty.

    The objective is that of Spark's regression with standardised features and label: the
    penalty is on weights of features in units of their standard deviation. Where Spark stops
    after a number of iterations, this one ends at the optimum. Features that never change get
    no weight.
    """
    n, origin = moments.rows, moments.origin
    mean = moments.matrix[0, 1:] / n
    spread = moments.matrix[1:, 1:] / n - np.outer(mean, mean)
    scale = np.sqrt(np.maximum(np.diag(spread), 0.0))
    # What rounding leaves of a column that never changes is no spread.
    noise = 1e-7 * np.sqrt(np.maximum(np.diag(moments.matrix)[1:] / n, 0.0))
    scale[scale <= noise] = 0.0
    center = mean + origin[1:]
    label_scale = scale[-1]
    coefficients = np.zeros(len(scale) - 1)
    if label_scale == 0.0 and not fitIntercept:
        label_scale = abs(center[-1])
    used = np.flatnonzero(scale[:-1])
    if label_scale > 0 and len(used):
        second = spread if fitIntercept else spread + np.outer(center, center)
        units = scale[used]
        q = second[np.ix_(used, used)] / np.outer(units, units)
        c = second[used, -1] / (units * label_scale)
        penalty = regParam / label_scale
        weights = _elastic_net(q, c, penalty * elasticNetParam, penalty * (1 - elasticNetParam))
        coefficients[used] = weights * label_scale / units
    intercept = float(center[-1] - center[:-1] @ coefficients) if fitIntercept else 0.0
    return LinearWeights(coefficients, intercept)


def _elastic_net(q: np.ndarray, c: np.ndarray, first: float, second: float) -> np.ndarray:
    """The ``w`` with the least ``w'qw/2 - c'w + first |w| + second w'w/2``.

    Coordinate descent finds which weights are not zero and their signs; for these the optimum
    is the solution of linear equations, taken once it meets the conditions of an optimum.
    """
    ridge = q + second * np.eye(len(c))
    if first == 0.0:
        return np.linalg.lstsq(ridge, c, rcond=1e-12)[0]
    w = np.zeros(len(c))
    slope = -c  # of the smooth part at w
    diagonal = np.diag(ridge)
    for sweep in range(1, _SWEEPS + 1):
        moved = 0.0
        for j in range(len(w)):
            free = diagonal[j] * w[j] - slope[j]
            new = np.sign(free) * max(abs(free) - first, 0.0) / diagonal[j]
            change = new - w[j]
            if change:
                slope = slope + ridge[:, j] * change
                w[j] = new
                moved = max(moved, abs(change))
        if moved < 1e-12:
            return w
        if sweep % _PROBE == 0:
            exact = _with_signs(ridge, c, first, np.sign(w))
            if exact is not None:
                return exact
    return w


def _with_signs(
    ridge: np.ndarray, c: np.ndarray, first: float, signs: np.ndarray
) -> np.ndarray | None:
    """The optimum if its weights have these signs, else none."""
    kept = np.flatnonzero(signs)
    w = np.zeros(len(c))
    w[kept] = np.linalg.lstsq(
        ridge[np.ix_(kept, kept)], c[kept] - first * signs[kept], rcond=1e-12)[0]
    slope = ridge @ w - c
    inside = np.abs(slope) <= first + _TOLERANCE
    at_edge = np.abs(slope[kept] + first * signs[kept]) <= _TOLERANCE
    return w if inside.all() and at_edge.all() and (w * signs >= 0).all() else None


def squared_error(moments: Moments, weights: LinearWeights) -> float:
    """The sum of squared errors of ``weights`` on the rows behind ``moments``."""
    origin = moments.origin[1:]
    at_origin = weights.intercept + origin[:-1] @ weights.coefficients - origin[-1]
    direction = np.concatenate([[-at_origin], -weights.coefficients, [1.0]])
    return max(0.0, float(direction @ moments.matrix @ direction))


def tune_linear(
    rows: DataFrame,
    held_out: Column,
    grid: dict[str, Sequence],
    features: str = "features",
    label: str = "label",
) -> TunedLinear:
    """Fit every combination of ``grid`` where ``held_out`` is false, measure its root mean
    squared error where it is true, and fit the best, the first among equals, on all rows.

    ``grid`` maps arguments of ``solve_linear`` to values. One scan serves all; features are at
    most ``GRAM_WIDTH`` and rows have neither a null label nor a null vector. An error if one
    of the parts has no row.
    """
    parts = part_moments(rows, held_out, features, label)
    if set(parts) != {0, 1}:
        raise ValueError("tuning needs rows to fit and rows to measure on")
    combinations = combinations_of(grid)
    metrics = []
    for settings in combinations:
        weights = solve_linear(parts[0], **settings)
        metrics.append(float(np.sqrt(squared_error(parts[1], weights) / parts[1].rows)))
    best = combinations[min(range(len(metrics)), key=metrics.__getitem__)]
    return TunedLinear(combinations, metrics, solve_linear(parts[0] + parts[1], **best))
