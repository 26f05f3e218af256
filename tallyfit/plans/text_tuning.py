"""Cross-validation of a text classifier from one pass over the text.

The pass hashes the words of each row to every width of the grid and writes the counts down
with the fold of the row. Document frequencies are counted for each fold; those of a training
part are the total less the fold that is held out. No text is cleaned, split or hashed again.
"""

from __future__ import annotations

from dataclasses import dataclass
from multiprocessing.pool import ThreadPool
from typing import Any

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import ElementwiseProduct, HashingTF
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import (
    SPARSE_LOGISTIC,
    TEXT_FOLDS,
    TEXT_GRID_FEATURES,
    TEXT_GRID_REG,
    TUNING_PARALLELISM,
)
from ..operators.splitting import fold_by_key
from ..sources.scratch import write_once
from .fit_size import tree_depth
from .linear_grid import combinations_of
from .text_classification import SUMMARY_BYTES, word_stages


@dataclass
class TunedLogistic:
    """Tried settings, the mean area under the ROC curve of each, and what they left behind.

    ``best`` turns text into predictions and is fitted on all rows. ``fold_models`` holds, for
    each fold, the weighing and the regression of the best settings fitted without that fold,
    and ``counts`` the hashed rows that they apply to.
    """

    combinations: list[dict[str, Any]]
    metrics: list[float]
    best: PipelineModel
    fold_models: list[PipelineModel]
    counts: DataFrame

    def transform(self, df: DataFrame) -> DataFrame:
        return self.best.transform(df)


def _counts(width: int) -> str:
    return f"counts{width}"


def _weighing(width: int, rows: int, frequencies: np.ndarray) -> ElementwiseProduct:
    """Multiplies counts by ``ln((m + 1) / (df + 1))`` for ``m`` rows."""
    return ElementwiseProduct(
        inputCol=_counts(width), outputCol="features",
        scalingVec=Vectors.dense(np.log((rows + 1) / (frequencies + 1))))


def fold_frequencies(
    counts: DataFrame, widths: list[int], folds: int
) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Rows per fold, and for each width the rows per fold that hold each hashed term.

    One aggregate for all folds and widths; its groups are as many as there are folds.
    """
    summaries = [Summarizer.metrics("numNonZeros").summary(F.col(_counts(w))).alias(_counts(w))
                 for w in widths]
    rows = np.zeros(folds)
    found = {w: np.zeros((folds, w)) for w in widths}
    for row in counts.groupBy("fold").agg(F.count("*").alias("rows"), *summaries).collect():
        rows[row["fold"]] = row["rows"]
        for w in widths:
            found[w][row["fold"]] = row[_counts(w)]["numNonZeros"].toArray()
    return rows, found


def tune_text_logistic(
    train: DataFrame,
    key: str,
    text: str = "text",
    label: str = "label",
    clean: bool = False,
    num_features: list[int] = TEXT_GRID_FEATURES,
    reg_params: list[float] = TEXT_GRID_REG,
    folds: int = TEXT_FOLDS,
    parallelism: int = TUNING_PARALLELISM,
    settings: dict = SPARSE_LOGISTIC,
) -> TunedLogistic:
    """Cross-validate width and penalty by area under the ROC curve.

    Document frequencies belong to what is fitted, so a fold is weighed by those of the other
    folds. Folds follow the key and do not depend on the layout of the table. Every fold must
    hold a row, and others besides.
    """
    widths = list(dict.fromkeys(num_features))
    hashing = {w: HashingTF(inputCol="words", outputCol=_counts(w), numFeatures=w)
               for w in widths}
    stages = word_stages(text, clean)
    words = PipelineModel([*stages, *hashing.values()]).transform(fold_by_key(train, key, folds))
    counts = words.select(key, F.col(label).cast("double").alias(label), "fold",
                          *[_counts(w) for w in widths])
    counts = write_once(counts, "fold-counts")
    rows, frequencies = fold_frequencies(counts, widths, folds)
    if folds < 2 or not rows.all():
        raise ValueError(f"cross-validation needs rows in each of several folds: {rows.tolist()}")

    evaluator = BinaryClassificationEvaluator(labelCol=label)
    combinations = combinations_of({"numFeatures": num_features, "regParam": reg_params})
    depth = tree_depth(counts, max(widths) * SUMMARY_BYTES)

    def fit(some: DataFrame, width: int, reg: float, held_out: int | None) -> PipelineModel:
        chosen = np.arange(folds) != held_out
        weighing = _weighing(width, rows[chosen].sum(), frequencies[width][chosen].sum(axis=0))
        logistic = LogisticRegression(
            labelCol=label, **{"aggregationDepth": depth, **settings, "regParam": reg})
        model: LogisticRegressionModel = logistic.fit(
            weighing.transform(some).select(label, "features"))
        return PipelineModel([weighing, model])

    def measure(task: tuple[int, int]) -> tuple[float, PipelineModel]:
        tried = combinations[task[0]]
        model = fit(counts.where(F.col("fold") != task[1]), tried["numFeatures"],
                    tried["regParam"], task[1])
        held_out = counts.where(F.col("fold") == task[1])
        return evaluator.evaluate(model.transform(held_out)), model

    tasks = [(c, f) for c in range(len(combinations)) for f in range(folds)]
    with ThreadPool(min(parallelism, len(tasks))) as pool:
        measured = dict(zip(tasks, pool.map(measure, tasks, chunksize=1)))
    metrics = [sum(measured[c, f][0] for f in range(folds)) / folds
               for c in range(len(combinations))]
    best = max(range(len(metrics)), key=metrics.__getitem__)
    width = combinations[best]["numFeatures"]
    final = fit(counts, width, combinations[best]["regParam"], None)
    return TunedLogistic(
        combinations, metrics, PipelineModel([*stages, hashing[width], *final.stages]),
        [measured[best, f][1] for f in range(folds)], counts)


def out_of_fold(tuned: TunedLogistic) -> DataFrame:
    """Every row once, with the ``fold`` it was in and what the model fitted without that fold
    says of it: ``rawPrediction``, ``probability`` and ``prediction``."""
    parts = [
        model.transform(tuned.counts.where(F.col("fold") == fold)).drop("features")
        for fold, model in enumerate(tuned.fold_models)
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.drop(*{_counts(c["numFeatures"]) for c in tuned.combinations})
