"""Principal components of vectors of any width."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import limits

OVERSAMPLE = 12  # directions beyond those asked for
ROUNDS = 60
TOLERANCE = 1e-10
BLOCK = 4096  # columns that a task hands on at once


@dataclass
class Components:
    """``axes`` has a column for each component, ``variances`` fall; ``rounds`` are the passes
    over the table that the last digits took."""

    mean: np.ndarray
    axes: np.ndarray
    variances: np.ndarray
    rows: int
    rounds: int


def _entries(df: DataFrame, vector: str, *more: str) -> DataFrame:
    """Places and values of each vector as stored, so a wide sparse vector stays sparse."""
    parts = df.where(F.col(vector).isNotNull()).select(*more, F.unwrap_udt(vector).alias("_v"))
    sparse = F.col("_v.type") == 0
    places = F.when(sparse, F.col("_v.indices")).otherwise(
        F.sequence(F.lit(0), F.size("_v.values") - 1))
    size = F.when(sparse, F.col("_v.size")).otherwise(F.size("_v.values"))
    return parts.select(*more, places.alias("places"), F.col("_v.values").alias("values"),
                        size.alias("size"))


def _projected(batch: pd.DataFrame, axes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row numbers, places and values of all entries, and each row times ``axes``."""
    counts = batch["values"].map(len).to_numpy()
    row = np.repeat(np.arange(len(batch)), counts)
    place = np.concatenate(batch["places"].to_numpy()).astype(np.int64)
    value = np.concatenate(batch["values"].to_numpy()).astype(float)
    if (counts == axes.shape[0]).all():
        out = value.reshape(len(batch), -1) @ axes
    else:
        out = np.stack([np.bincount(row, value * axes[place, j], len(batch))
                        for j in range(axes.shape[1])], 1)
    return row, place, value, out


def _products(mean: np.ndarray, axes: np.ndarray):
    """Per task the sum over its centred rows of row times projected row: its size follows from
    the axes, not from the rows."""
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        width, count = axes.shape
        total, shifts = np.zeros((width, count)), np.zeros(count)
        for batch in batches:
            if not len(batch):
                continue
            row, place, value, out = _projected(batch, axes)
            out = out - mean @ axes
            if len(place) == len(batch) * width:
                total += value.reshape(len(batch), width).T @ out
            else:
                for j in range(count):
                    total[:, j] += np.bincount(place, value * out[row, j], width)
            shifts += out.sum(0)
        total -= np.outer(mean, shifts)
        for start in range(0, width, BLOCK):
            rows = total[start:start + BLOCK]
            yield pd.DataFrame({"column": np.arange(start, start + len(rows)),
                                "sums": list(rows)})

    return add


def _covariance_times(entries: DataFrame, mean: np.ndarray, axes: np.ndarray, rows: int):
    """The covariance matrix times ``axes``, which is never built itself."""
    count = axes.shape[1]
    parts = entries.mapInPandas(_products(mean, axes), "column int, sums array<double>")
    found = parts.groupBy("column").agg(
        F.array(*[F.sum(F.col("sums")[j]) for j in range(count)]).alias("sums")).toPandas()
    out = np.zeros_like(axes)
    out[found["column"].to_numpy()] = np.stack(found["sums"].to_numpy())
    return out / (rows - 1)


def _means(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total, rows = np.zeros(0), 0
    for batch in batches:
        if not len(batch):
            continue
        rows += len(batch)
        width = int(batch["size"].max())
        total = np.pad(total, (0, max(0, width - len(total))))
        place = np.concatenate(batch["places"].to_numpy()).astype(np.int64)
        total += np.bincount(place, np.concatenate(batch["values"].to_numpy()), len(total))
    yield pd.DataFrame({"column": [-1, *range(len(total))], "total": [float(rows), *total]})


def principal_components(
    df: DataFrame, vector: str, k: int, seed: int = 0, exact_width: int = limits.COVARIANCE_WIDTH
) -> Components:
    """The ``k`` directions of largest variance of a vector column, dense or sparse.

    Vectors of at most ``exact_width`` dimensions take one pass for the means and one for the
    covariances. For wider ones the matrix of covariances, which has the square of the width,
    is never built: a few more random directions than asked for are multiplied by it, pass by
    pass, and made orthogonal again until the variances along them settle. The driver and each
    task hold arrays of the width times those directions; more than ``limits.DRIVER_BYTES`` of
    that is refused. Null vectors do not count; fewer than two rows have no variances: an error.
    Signs are such that the largest entry of each component is positive.
    """
    entries = _entries(df, vector)
    totals = entries.mapInPandas(_means, "column int, total double").groupBy("column").agg(
        F.sum("total").alias("total")).toPandas().set_index("column")["total"]
    rows = int(totals.get(-1, 0))
    if rows < 2:
        raise ValueError("components need two rows or more")
    width = int(totals.index.max()) + 1
    mean = totals.reindex(range(width), fill_value=0.0).to_numpy() / rows
    k = min(k, width)
    if width <= exact_width:
        matrix = _covariance_times(entries, mean, np.eye(width), rows)
        values, axes = np.linalg.eigh((matrix + matrix.T) / 2)
        order = np.argsort(-values)[:k]
        return Components(mean, _signed(axes[:, order]), values[order], rows, 1)
    count = min(width, k + OVERSAMPLE)
    if 8 * width * count > limits.DRIVER_BYTES:
        raise ValueError(f"{width} x {count} numbers exceed limits.DRIVER_BYTES")
    axes = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, count)))[0]
    before = np.zeros(k)
    for passes in range(1, ROUNDS + 1):
        moved = _covariance_times(entries, mean, axes, rows)
        # Within the directions at hand, the best ones are eigenvectors of a small matrix.
        small = axes.T @ moved
        values, turn = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(-values)
        variances, best = values[order][:k], axes @ turn[:, order[:k]]
        settled = np.abs(variances - before).max() <= TOLERANCE * max(variances[0], 1e-300)
        before = variances
        if settled:
            break
        axes = np.linalg.qr(moved)[0]
    return Components(mean, _signed(best), variances, rows, passes)


def _signed(axes: np.ndarray) -> np.ndarray:
    largest = np.abs(axes).argmax(0)
    return axes * np.where(axes[largest, np.arange(axes.shape[1])] < 0, -1, 1)


def project(df: DataFrame, key: str, vector: str, found: Components) -> DataFrame:
    """``(key, projected)``: centred vectors along the components; a null vector has no row."""
    axes, shift = found.axes, found.mean @ found.axes
    kind = df.select(key).schema[0].dataType.simpleString()

    def along(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                out = _projected(batch, axes)[3] - shift
                yield pd.DataFrame({key: batch[key], "projected": list(out)})

    return _entries(df, vector, key).mapInPandas(
        along, f"`{key}` {kind}, projected array<double>")

