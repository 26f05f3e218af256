"""Quality classifier: random-indexing word vectors, pooled per document, under a small network.

A word's index vector is sparse and follows from its hash; its word vector adds up the index
vectors of the words around it in the training sample. A word that the sample does not know
keeps its index vector. Words and their shapes (letter case, digits, marks, repeats) are pooled
apart. A network of two layers scores the pooled vectors, and a temperature that fits held-back
rows of the sample makes its scores probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .texts import remainder, shuffled_place

SAMPLE_ROWS = 4000  # labelled rows that the fit gathers, in expectation; the bound of the fit
WIDTH = 48
ENTRIES = 4  # non-zero entries of an index vector
REACH = 2  # words on either side that make a word's context
LEAST_COUNT = 3  # rarer words of the sample keep their index vector
COMMON = 1e-3  # a word with this share of all words counts half
HIDDEN = 24
EPOCHS = 400
RATE = 0.01
DECAY = 1e-4
HELD_BACK = 5  # one in so many rows of the sample sets the temperature
PARTITIONS = 3
SLICE_BYTES = 6 << 20  # of text whose words are in memory at once
GATHER = 100_000  # word vectors in memory at once
SEED = 10

_SHAPE = regex.compile(r"(\p{Lu}+)|(\p{L}+)|(\p{N}+)|(.)\4*+", regex.S)


def _shape(word: str) -> str:
    """A word with its runs of capitals, letters and digits as one character each, and runs of
    one mark as that mark."""
    return _SHAPE.sub(
        lambda m: "A" if m[1] else "a" if m[2] else "0" if m[3] else m[4], word
    )


def _hashes(words: list[str]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w, SEED) for w in words), np.uint64, len(words))


def index_entries(hashes: np.ndarray, width: int = WIDTH) -> list[tuple[np.ndarray, ...]]:
    """Place and sign of each non-zero entry of the index vectors."""
    entries = []
    for n in range(ENTRIES):
        bits = hashes >> np.uint64(16 * n)
        place = ((bits & np.uint64(0x7FFF)) % np.uint64(width)).astype(np.int32)
        sign = np.where(bits >> np.uint64(15) & np.uint64(1), 1, -1).astype(np.float32)
        entries.append((place, sign))
    return entries


def index_vectors(hashes: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """The sparse index vector of each hash: a few entries of plus or minus one."""
    vectors = np.zeros((len(hashes), width), np.float32)
    rows = np.arange(len(hashes))
    for place, sign in index_entries(hashes, width):
        vectors[rows, place] += sign
    return vectors


@dataclass
class Words:
    """The words of many texts end to end: distinct words, and for each place its number; and
    where each text begins. Shapes likewise, with a mark on a word that repeats the last one."""

    distinct: list[str]
    word: np.ndarray
    shapes: list[str]
    shape: np.ndarray
    starts: np.ndarray


def slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Consecutive parts of about ``SLICE_BYTES`` each; a longer text is a part of its own."""
    sizes = pc.coalesce(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(sizes, dtype=np.int64), 0
    while start < len(texts):
        room = (ends[start - 1] if start else 0) + SLICE_BYTES
        stop = max(start + 1, int(np.searchsorted(ends, room, "right")))
        yield texts.slice(start, stop - start)
        start = stop


def split_words(texts: pa.Array) -> Words:
    lists = pc.ascii_split_whitespace(pc.coalesce(texts, "").cast(pa.large_string()))
    parent, flat = pc.list_parent_indices(lists), lists.flatten()
    full = pc.not_equal(flat, "")
    parent, flat = parent.filter(full).to_numpy(), flat.filter(full)
    told = flat.dictionary_encode()
    distinct, word = told.dictionary.to_pylist(), told.indices.to_numpy()
    starts = np.searchsorted(parent, np.arange(len(texts) + 1))
    seen: dict[str, int] = {}
    of_word = [seen.setdefault(_shape(w), len(seen)) for w in distinct]
    shape = np.array(of_word, np.int32)[word] * 2
    again = np.flatnonzero((word[1:] == word[:-1]) & (parent[1:] == parent[:-1])) + 1
    shape[again] += 1
    both = [s + mark for s in seen for mark in ("\n", "\n=")]
    return Words(distinct, word, both, shape, starts)


def _pooled(vectors: np.ndarray, places: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The mean vector of each text, zero for one without words; gathers few at a time."""
    sums = np.zeros((len(starts) - 1, vectors.shape[1]), np.float64)
    row = 0
    while row < len(sums):
        last = max(row + 1, int(np.searchsorted(starts, starts[row] + GATHER, "right")) - 1)
        last = min(last, len(sums))
        if last == row + 1:  # possibly a very long text
            for at in range(starts[row], starts[last], GATHER):
                part = places[at:min(at + GATHER, starts[last])]
                sums[row] += vectors[part].sum(0, dtype=np.float64)
        else:
            full = np.flatnonzero(starts[row + 1:last + 1] > starts[row:last]) + row
            if len(full):
                part = vectors[places[starts[row]:starts[last]]]
                sums[full] = np.add.reduceat(part, starts[full] - starts[row], axis=0)
        row = last
    return sums / np.maximum(1, np.diff(starts))[:, None]


class QualityModel:
    """A fitted model; ``score`` maps an Arrow array of texts to probabilities of label 1."""

    def __init__(self, texts: pa.Array, labels: np.ndarray):
        self.known = np.zeros(0, np.uint64)
        self.vectors = np.zeros((0, WIDTH), np.float32)
        self.share = np.zeros(0)
        self.net = None
        labels = np.asarray(labels, np.float64)
        # Without labels there is nothing to tell, with one label only its share.
        self.prior = float((labels.sum() + 1) / (len(labels) + 2))
        if len(set(labels.tolist())) < 2:
            return
        self._learn_words(texts)
        features = np.vstack([self._features(split_words(part)) for part in slices(texts)])
        self.mean, self.scale = features.mean(0), features.std(0) + 1e-3
        inputs = (features - self.mean) / self.scale
        back = np.arange(len(labels)) % HELD_BACK == HELD_BACK - 1
        fit = ~back if len(set(labels[~back].tolist())) == 2 else np.ones(len(labels), bool)
        self._learn_net(inputs[fit], labels[fit])
        back = back if back.any() else fit
        self.temperature = self._best_temperature(self._logits(inputs[back]), labels[back])

    def _learn_words(self, texts: pa.Array) -> None:
        """Two passes over the sample, some texts at a time: counts, then contexts."""
        seen = []
        for part in slices(texts):
            words = split_words(part)
            counts = np.bincount(words.word, minlength=len(words.distinct))
            seen.append((_hashes(words.distinct), counts))
        hashes, place = np.unique(np.concatenate([h for h, _ in seen]), return_inverse=True)
        counts = np.bincount(place, np.concatenate([c for _, c in seen]), len(hashes))
        keep = counts >= LEAST_COUNT
        self.known = hashes[keep]
        self.share = counts[keep] / max(1, counts.sum())
        context = index_vectors(self.known) * counts[keep, None].astype(np.float32)
        for part in slices(texts):
            self._add_contexts(split_words(part), context)
        length = np.linalg.norm(context, axis=1, keepdims=True)
        # On the scale of index vectors, so that known and unknown words weigh alike.
        self.vectors = context * (np.sqrt(ENTRIES) / np.where(length > 0, length, 1)).astype(
            np.float32)

    def _add_contexts(self, words: Words, context: np.ndarray) -> None:
        """Add to each known word's vector the index vectors of the words around it."""
        hashes = _hashes(words.distinct)
        entries = index_entries(hashes)
        row = self._row_of(hashes)
        text = np.repeat(np.arange(len(words.starts) - 1, dtype=np.int32), np.diff(words.starts))
        for step in range(1, REACH + 1):
            same = text[step:] == text[:-step]
            left, right = words.word[:-step][same], words.word[step:][same]
            for a, b in ((left, right), (right, left)):
                for at in range(0, len(a), GATHER):
                    cell, near = row[a[at:at + GATHER]], b[at:at + GATHER]
                    known = cell >= 0
                    cell, near = cell[known] * WIDTH, near[known]
                    for place, sign in entries:
                        np.add.at(context.reshape(-1), cell + place[near],
                                  sign[near])

    def _row_of(self, hashes: np.ndarray) -> np.ndarray:
        """The row of each hash among the known words, -1 for an unknown one."""
        if not len(self.known):
            return np.full(len(hashes), -1)
        place = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[place] == hashes, place, -1)

    def _word_vectors(self, words: list[str]) -> np.ndarray:
        hashes = _hashes(words)
        vectors = index_vectors(hashes)
        row = self._row_of(hashes)
        known = row >= 0
        weight = COMMON / (COMMON + self.share[row[known]])
        vectors[known] = self.vectors[row[known]] * weight[:, None]
        return vectors

    def _features(self, words: Words) -> np.ndarray:
        by_word = _pooled(self._word_vectors(words.distinct), words.word, words.starts)
        shapes = index_vectors(_hashes(words.shapes))
        by_shape = _pooled(shapes, words.shape, words.starts)
        return np.hstack([by_word, by_shape, np.log1p(np.diff(words.starts))[:, None]])

    def _logits(self, inputs: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.net
        return np.tanh(inputs @ w1 + b1) @ w2 + b2

    def _learn_net(self, inputs: np.ndarray, labels: np.ndarray) -> None:
        random = np.random.default_rng(SEED)
        wide = inputs.shape[1]
        net = [random.standard_normal((wide, HIDDEN)) / np.sqrt(wide), np.zeros(HIDDEN),
               random.standard_normal(HIDDEN) / np.sqrt(HIDDEN), np.zeros(())]
        first, second = [np.zeros_like(p) for p in net], [np.zeros_like(p) for p in net]
        for step in range(1, EPOCHS + 1):
            hidden = np.tanh(inputs @ net[0] + net[1])
            error = (_sigmoid(hidden @ net[2] + net[3]) - labels) / len(labels)
            below = error[:, None] * net[2] * (1 - hidden**2)
            slopes = [inputs.T @ below + DECAY * net[0], below.sum(0),
                      hidden.T @ error + DECAY * net[2], error.sum()]
            for n, slope in enumerate(slopes):
                first[n] = 0.9 * first[n] + 0.1 * slope
                second[n] = 0.999 * second[n] + 0.001 * slope**2
                move = first[n] / (1 - 0.9**step)
                net[n] = net[n] - RATE * move / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)
        self.net = net

    @staticmethod
    def _best_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
        def loss(temperature: float) -> float:
            scaled = logits / temperature
            return float(np.mean(np.logaddexp(0, scaled) - labels * scaled))

        return float(min(np.geomspace(0.25, 8, 101), key=loss))

    def score(self, texts: pa.Array) -> np.ndarray:
        if self.net is None:
            return np.full(len(texts), self.prior)
        scores = [np.zeros(0)]
        for part in slices(texts):
            inputs = (self._features(split_words(part)) - self.mean) / self.scale
            scores.append(_sigmoid(self._logits(inputs) / self.temperature))
        return np.concatenate(scores)


def _sigmoid(values: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(values, -500, 500)))


def fit_quality(
    documents: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> QualityModel:
    """Fit on a sample of about ``sample_rows`` labelled rows outside the held-out third, taken
    by a hash of the key; fewer are all taken. The sample is the only thing the driver sees.

    Several labels of one key count by their mean, from a half up as 1; null labels and labels
    of other keys count for nothing, null texts as empty. Of a key's texts the smallest counts.
    """
    named = labels.select(F.col(key).alias("_key"), F.col(label).alias("_label"))
    known = named.where(
        F.col("_key").isNotNull() & F.col("_label").isNotNull()
        & (remainder("_key", PARTITIONS) != 1)
    ).groupBy("_key").agg((F.avg("_label") >= 0.5).cast("int").alias("_label"))
    total = known.count()
    part = min(1.0, sample_rows / max(1, total))
    known = known.withColumn("_at", shuffled_place(SEED, "_key"))
    taken = known.where(F.col("_at") <= int(part * ((1 << 63) - 1024)))
    # Never more than about ``sample_rows`` texts: one for each key, however often it occurs.
    found = documents.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(
        F.broadcast(taken), "_key")
    rows = found.groupBy("_key", "_at", "_label").agg(F.min("_text").alias("_text")).select(
        "_at", "_text", "_label").toArrow()
    rows = rows.sort_by([("_at", "ascending"), ("_text", "ascending")]).combine_chunks()
    texts = rows.column("_text").combine_chunks()
    return QualityModel(texts, rows.column("_label").to_numpy())


def _scores(model: QualityModel):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # The text travels last; all other columns pass through as they are.
            found = pa.array(model.score(batch.column(batch.num_columns - 1)), pa.float64())
            columns = [batch.column(n) for n in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*columns, found], names=[*batch.schema.names[:-1], "_score"]
            )

    return score


def score_quality(
    documents: DataFrame, model: QualityModel, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, held_out, score, predicted)`` for every row: the probability of label 1, from
    the whole text alone, and 1 where it is at least a half.

    Null texts count as empty; an empty text gets the score of a document without words. Rows
    that repeat get equal scores; other columns are not read; an empty table gives an empty
    result. Without labelled rows of both kinds every score is the share of label 1, smoothed.
    """
    narrow = documents.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    kind = dict(narrow.dtypes)["_key"]
    scored = narrow.mapInArrow(_scores(model), f"_key {kind}, _score double")
    return scored.select(
        F.col("_key").alias(key), (remainder("_key", PARTITIONS) == 1).alias("held_out"),
        F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_quality(documents: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """The documents that the model does not reject, with all their columns and no shuffle."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(texts), pa.float64())

    return documents.where(score(F.col(text)) >= 0.5)
