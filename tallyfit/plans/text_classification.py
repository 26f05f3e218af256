"""Text classification: clean, tokenise, weigh terms, fit a classifier.

Training text is read once. The stages before the document frequencies need no fit, so
their result, one sparse count vector per row, is written down; the document frequencies
and every iteration of the classifier read that table. The returned model holds all
stages, so new text passes through exactly what the training text did.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import (
    IDF,
    HashingTF,
    IDFModel,
    IndexToString,
    SQLTransformer,
    StopWordsRemover,
    StringIndexer,
    Tokenizer,
    VectorSlicer,
)
from pyspark.sql import DataFrame

from .. import limits
from ..fixed_values import (
    MAX_CATEGORIES,
    REMOVED_CHARACTERS,
    SPARSE_LOGISTIC,
    TEXT_FEATURES,
    TEXT_SEED,
)
from ..functions.text import stop_words
from ..operators.encoding import vector_positions
from ..operators.selection import best_features, chi_squared
from ..operators.vector_categories import fit_vector_indexer
from ..sources.scratch import write_once
from .fit_size import bound_partitions, merge_partitions, tree_depth
from .wide_forest import fit_wide_forest

# Bytes per feature in one partial result: a count, and the moments of a feature summary.
COUNT_BYTES = 8
SUMMARY_BYTES = 48


def word_stages(text: str, clean: bool) -> list[Transformer]:
    """From text to ``words``; ``clean`` removes punctuation and stop words."""
    if not clean:
        return [
            SQLTransformer(statement=f"SELECT *, coalesce(`{text}`, '') AS _text FROM __THIS__"),
            Tokenizer(inputCol="_text", outputCol="words"),
        ]
    removed = REMOVED_CHARACTERS.replace("\\", "\\\\")
    return [
        SQLTransformer(
            statement=f"SELECT *, regexp_replace(coalesce(`{text}`, ''), '{removed}', '') "
            "AS _text FROM __THIS__"
        ),
        Tokenizer(inputCol="_text", outputCol="_tokens"),
        StopWordsRemover(inputCol="_tokens", outputCol="words", stopWords=stop_words()),
    ]


def text_counts_stages(
    text: str = "text", clean: bool = True, num_features: int = TEXT_FEATURES
) -> list[Transformer]:
    """The stages from text to hashed term counts in ``rawFeatures``; none needs a fit."""
    hashing = HashingTF(inputCol="words", outputCol="rawFeatures", numFeatures=num_features)
    return [*word_stages(text, clean), hashing]


def _fit_idf(counts: DataFrame, num_features: int) -> IDFModel:
    idf = IDF(inputCol="rawFeatures", outputCol="features")
    return idf.fit(merge_partitions(counts, num_features * COUNT_BYTES))


def _counted(train: DataFrame, stages: list[Transformer], label: str) -> DataFrame:
    counts = PipelineModel(stages).transform(train).select(label, "rawFeatures")
    return write_once(counts, "text-counts")


def fit_text_logistic(
    train: DataFrame,
    text: str = "text",
    label: str = "label",
    clean: bool = True,
    num_features: int = TEXT_FEATURES,
    settings: dict = SPARSE_LOGISTIC,
) -> PipelineModel:
    """TF-IDF and logistic regression. ``stages[-1]`` of the result is the regression."""
    stages = text_counts_stages(text, clean, num_features)
    counts = _counted(train, stages, label)
    idf = _fit_idf(counts, num_features)
    depth = tree_depth(counts, num_features * SUMMARY_BYTES)
    logistic = LogisticRegression(labelCol=label, **{"aggregationDepth": depth, **settings})
    logistic = logistic.fit(idf.transform(counts))
    return PipelineModel([*stages, idf, logistic])


def fit_text_forest(
    train: DataFrame,
    text: str = "text",
    label: str = "label",
    clean: bool = False,
    num_features: int = TEXT_FEATURES,
    terms: int | None = None,
    seed: int = TEXT_SEED,
) -> PipelineModel:
    """TF-IDF, label and vector indexing, random forest and the label name of a prediction.

    Columns added: ``indexedLabel``, ``prediction`` and ``predictedLabel``; ``stages[-2]`` of
    the result is the forest. Text is hashed as widely as for regression, and the forest draws
    from all hashed terms. If ``terms`` is given it draws only from that many, whose presence has
    the largest chi-squared statistic with the label; a vector slicer carries the choice to new
    text. Up to ``limits.FOREST_WIDTH`` terms a task holds at most ``limits.TASK_BYTES`` of binned
    rows; wider rows stay sparse.
    """
    stages = text_counts_stages(text, clean, num_features)
    counts = _counted(train, stages, label)
    idf = _fit_idf(counts, num_features)
    weighed, used = idf.transform(counts).drop("rawFeatures"), "features"
    chosen: list[Transformer] = []
    if terms is not None:
        used = "keptFeatures"
        chosen = [VectorSlicer(inputCol="features", outputCol=used,
                               indices=_telling_terms(counts, label, num_features, terms))]
        weighed = chosen[0].transform(weighed).drop("features")
    vectors = write_once(weighed, "text-vectors")
    labels = StringIndexer(inputCol=label, outputCol="indexedLabel", handleInvalid="keep")
    labels = labels.fit(vectors)
    forest = RandomForestClassifier(
        labelCol="indexedLabel", featuresCol="indexedFeatures", seed=seed
    )
    width = num_features if terms is None else len(chosen[0].getIndices())
    if width <= limits.FOREST_WIDTH:
        indexer = fit_vector_indexer(vectors, used, "indexedFeatures", MAX_CATEGORIES)
        vectors = bound_partitions(vectors, indexer.numFeatures)
        forest = forest.fit(indexer.transform(labels.transform(vectors)))
    else:
        indexer, forest = fit_wide_forest(
            forest, labels.transform(vectors), used, len(labels.labels) + 1, MAX_CATEGORIES)
    names = IndexToString(
        inputCol="prediction",
        outputCol="predictedLabel",
        labels=[*labels.labels, "__unknown"],
    )
    return PipelineModel([*stages, idf, *chosen, labels, indexer, forest, names])


def _telling_terms(counts: DataFrame, label: str, width: int, terms: int) -> list[int]:
    """The hashed terms with the largest statistic; all of them where no more are asked for."""
    if width <= terms:
        return list(range(width))
    entries = vector_positions(counts, label, "rawFeatures")
    scored = chi_squared(entries, counts.select(label), "position", label)
    found = best_features(scored, "position", terms).collect()
    return sorted(r["position"] for r in found) or [0]
