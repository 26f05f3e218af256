"""Near copies among vectors: spherical-cap filters decoded from a random product code.

A filter is a direction; a vector passes it if their inner product exceeds a threshold. The
directions are all sums of one code word from each half of the rotated space, so a vector finds
the filters it passes from two short lists instead of testing every direction. Vectors that
share a filter are compared exactly, in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import write_once
from .graphs import components, smallest_labels

SIMILARITY = 0.93
RECALL = 0.99  # share of pairs exactly at the threshold that pass a filter together
CODES = 8
CODE_WORDS = 128  # for each half of a code, at most
TRIALS = 2000  # simulated pairs that the filter threshold is set by
BLOCK = 256  # vectors that one side of a comparison holds at most
SEED = 20


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length > 0, length, 1)


class ProductCode:
    """Directions that are sums of a random word for each half of a randomly turned space."""

    def __init__(self, size: int, words: int, seed: list[int]):
        random = np.random.default_rng(seed)
        self.turn = np.linalg.qr(random.standard_normal((size, size)))[0]
        self.split = (size + 1) // 2
        halves = [self.split, size - self.split]
        self.words = [_unit(random.standard_normal((words, width))) for width in halves]
        self.count = words * words

    def lists(self, unit: np.ndarray) -> list[np.ndarray]:
        """Per half, the inner products with its words."""
        turned = unit @ self.turn
        halves = [turned[:, :self.split], turned[:, self.split:]]
        return [half @ words.T for half, words in zip(halves, self.words)]

    def best_shared(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The highest threshold at which each pair of rows shares a direction."""
        sums = [one[:, :, None] + two[:, None, :] for one, two in map(self.lists, (x, y))]
        return np.minimum(*sums).reshape(len(x), -1).max(1)

    def decode(self, unit: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """``(row, direction)`` wherever an inner product reaches the threshold. A word of the
        first half is dropped for all rows that its best partner cannot lift that far."""
        first, second = self.lists(unit)
        need = threshold - second.max(1)
        rows, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for word in range(first.shape[1]):
            able = np.flatnonzero(first[:, word] >= need)
            r, w = np.nonzero(first[able, word, None] + second[able] >= threshold)
            rows.append(able[r])
            found.append(word * second.shape[1] + w)
        return np.concatenate(rows), np.concatenate(found)


class CapFilters:
    """Filters for vectors of one length, fixed by a seed; nothing is learned from data.

    The threshold is the highest one at which ``recall`` of random pairs exactly ``similarity``
    apart share a filter, found by simulation; closer pairs share one more often. Several codes
    with turns of their own even out the number of filters that a vector passes.
    """

    def __init__(self, size: int, words: int, similarity: float, recall: float, seed: int):
        self.codes = [ProductCode(size, words, [seed, size, words, n]) for n in range(CODES)]
        random = np.random.default_rng([seed, size])
        x, z = _unit(random.standard_normal((TRIALS, size))), random.standard_normal(
            (TRIALS, size))
        z = _unit(z - (z * x).sum(1, keepdims=True) * x) if size > 1 else x
        y = similarity * x + np.sqrt(max(0.0, 1 - similarity**2)) * z
        best = [np.max([code.best_shared(x[at:at + 50], y[at:at + 50]) for code in self.codes],
                       axis=0) for at in range(0, TRIALS, 50)]
        self.threshold = float(np.quantile(np.concatenate(best), 1 - recall))

    def decode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(row, filter)`` for every filter that each unit vector passes."""
        lists = [code.decode(unit, self.threshold) for code in self.codes]
        rows = np.concatenate([row for row, _ in lists])
        return rows, np.concatenate(
            [found + n * code.count for n, (code, (_, found)) in enumerate(zip(self.codes, lists))]
        )


def _matrix(vectors: pd.Series) -> np.ndarray:
    """Rows in the type of the column, which loses nothing."""
    return np.array([np.asarray(v) for v in vectors])


def _scaled(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by their largest component first, so nothing overflows."""
    rows = rows.astype(np.float64)
    return _unit(rows / np.abs(rows).max(1, keepdims=True))


def _decode(filters: dict[int, CapFilters]):
    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, part in batch.groupby(batch["vector"].map(len)):
                rows = _matrix(part["vector"])
                row, found = filters[size].decode(_scaled(rows))
                order = np.lexsort([found, row])
                row, found = row[order], found[order].astype(np.int32)
                ends = np.searchsorted(row, np.arange(len(part) + 1))
                lists = [found[s:e].tobytes() for s, e in zip(ends, ends[1:])]
                yield pd.DataFrame({
                    "label": part["label"].to_numpy()[row],
                    "size": np.full(len(row), size, np.int32),
                    "filter": found,
                    "node": part["node"].to_numpy()[row],
                    "copies": part["copies"].to_numpy()[row],
                    "vector": [rows[r].tobytes() for r in row],
                    "passed": [lists[r] for r in row],
                })

    return decode


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Consecutive vectors of one filter as blocks of bounded size."""
    for batch in batches:
        key = batch[["label", "size", "filter"]]
        changed = (key != key.shift()).any(axis=1).to_numpy()
        starts = np.append(np.flatnonzero(changed), len(batch))
        rows = []
        for start, end in zip(starts, starts[1:]):
            for at in range(start, end, BLOCK):
                part = batch.iloc[at:min(at + BLOCK, end)]
                passed = part["passed"].tolist()
                rows.append((
                    part["label"].iat[0], int(part["size"].iat[0]), int(part["filter"].iat[0]),
                    int(part["node"].iat[0]), part["node"].to_numpy(np.int64).tobytes(),
                    part["copies"].to_numpy(np.int64).tobytes(), b"".join(part["vector"]),
                    np.array([len(p) // 4 for p in passed], np.int32).tobytes(),
                    b"".join(passed),
                ))
        yield pd.DataFrame(
            rows, columns=["label", "size", "filter", "first", *_BLOCK_COLUMNS]
        )


_BLOCK_COLUMNS = ["nodes", "copies", "vectors", "lengths", "passed"]
_BLOCK = ", ".join(f"{c} binary" for c in _BLOCK_COLUMNS)


def _smaller_filters(
    lengths: bytes, passed: bytes, rows: np.ndarray, below: int
) -> tuple[np.ndarray, np.ndarray]:
    """``(row, filter)`` of the filters under ``below`` that the given rows pass."""
    lengths = np.frombuffer(lengths, np.int32)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    filters = np.frombuffer(passed, np.int32)
    take = (filters < below) & np.isin(owner, rows)
    return np.searchsorted(rows, owner[take]), filters[take]


def _share_smaller(x: tuple, y: tuple, i: np.ndarray, j: np.ndarray, below: int) -> np.ndarray:
    """Whether the pairs of rows ``i`` of ``x`` and ``j`` of ``y`` share a smaller filter, in
    which they are counted already."""
    rows_x, at_x = np.unique(i, return_inverse=True)
    rows_y, at_y = np.unique(j, return_inverse=True)
    own_x, filters_x = _smaller_filters(*x, rows_x, below)
    own_y, filters_y = _smaller_filters(*y, rows_y, below)
    common = np.intersect1d(filters_x, filters_y)
    if not len(common):
        return np.zeros(len(i), bool)
    tables = []
    for own, filters, rows in ((own_x, filters_x, rows_x), (own_y, filters_y, rows_y)):
        table = np.zeros((len(rows), len(common)), np.float32)
        keep = np.isin(filters, common)
        table[own[keep], np.searchsorted(common, filters[keep])] = 1
        tables.append(table)
    return (tables[0] @ tables[1].T)[at_x, at_y] > 0


def _compare(similarity: float, kind: str):
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            nodes, links, parents = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
            parents.append(nodes[0])
            for row in batch.itertuples(index=False):
                same = row.first == row.other_first
                a = np.frombuffer(row.nodes, np.int64)
                x = np.frombuffer(row.vectors, kind).reshape(len(a), -1)
                b = a if same else np.frombuffer(row.other_nodes, np.int64)
                y = x if same else np.frombuffer(row.other_vectors, kind).reshape(
                    len(b), -1)
                near = _scaled(x) @ _scaled(y).T >= similarity
                i, j = np.nonzero(np.triu(near, 1) if same else near)
                if not len(i):
                    continue
                new = ~_share_smaller((row.lengths, row.passed), (row.other_lengths,
                                      row.other_passed), i, j, row.filter)
                i, j = i[new], j[new]
                if not len(i):
                    continue
                copies_a = np.frombuffer(row.copies, np.int64)
                copies_b = np.frombuffer(row.other_copies, np.int64)
                both = a if same else np.concatenate([a, b])
                shift = 0 if same else len(a)
                count = np.zeros(len(both), np.int64)
                np.add.at(count, i, copies_b[j])
                np.add.at(count, j + shift, copies_a[i])
                labels = smallest_labels(len(both), i, j + shift)
                linked = np.flatnonzero(count)
                nodes.append(both[linked])
                links.append(count[linked])
                parents.append(both[labels[linked]])
            yield pd.DataFrame({"node": np.concatenate(nodes), "links": np.concatenate(links),
                                "parent": np.concatenate(parents)})

    return compare


def cosine_links(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    code_words: int = CODE_WORDS,
) -> DataFrame:
    """``(key, n_links, component_id)`` for every row: how many other rows of the same label
    have a cosine of at least ``similarity``, and the smallest key that such links reach.

    Rows whose label is null, and vectors that are null, empty, zero or hold null or non-finite
    components, link with nothing and are their own component; so do vectors of different
    length with each other. Rows with equal vectors are one node that carries its number, so
    copies are linked whatever the filters do and are never paired one by one. Rows that repeat
    a key each get their row; a null key names a component only where no other does. Other
    columns of ``df`` are not read; an empty table gives an empty result.

    No link is false. Every pair that shares a filter is found, counted in the smallest filter
    it shares. The number of filters follows the largest label, up to ``CODES`` times
    ``code_words`` squared.
    """
    rows = df.select(
        F.col(key).alias("_key"), F.col(label).alias("label"), F.col(vector).alias("vector")
    )
    if dict(rows.dtypes)["vector"] != "array<float>":
        rows = rows.withColumn("vector", F.col("vector").cast("array<double>"))
    good = F.col("label").isNotNull() & F.col("vector").isNotNull() & ~F.exists(
        "vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    ) & F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("_good", F.coalesce(good, F.lit(False)))
    grouped = rows.where("_good").groupBy("label", "vector").agg(
        F.count("*").alias("copies"), F.min("_key").alias("first")
    )
    classes = write_once(grouped.withColumn("node", F.monotonically_increasing_id()), "vectors")
    sizes = [r[0] for r in classes.select(F.size("vector")).distinct().collect()]
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    words = int(np.clip(np.ceil(np.sqrt(largest / (4 * CODES))), 4, code_words))
    filters = {n: CapFilters(n, words, similarity, recall, SEED) for n in sizes}
    kind = dict(classes.dtypes)["label"]
    number = "f4" if dict(classes.dtypes)["vector"] == "array<float>" else "f8"
    decoded = write_once(
        classes.select("node", "label", "copies", "vector").mapInPandas(
            _decode(filters),
            f"label {kind}, size int, filter int, node long, copies long, vector binary, "
            "passed binary",
        ),
        "filtered",
    )
    order = ["label", "size", "filter", "node"]
    blocks = write_once(
        decoded.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(
            _pack, f"label {kind}, size int, filter int, first long, {_BLOCK}"
        ),
        "blocks",
    )
    others = blocks.select(
        "label", "size", "filter",
        *[F.col(c).alias(f"other_{c}") for c in ("first", *_BLOCK_COLUMNS)],
    )
    pairs = blocks.join(others, ["label", "size", "filter"]).where("first <= other_first")
    found = write_once(
        pairs.drop("label", "size").mapInPandas(
            _compare(similarity, number), "node long, links long, parent long"
        ),
        "links",
    )
    joined = write_once(
        components(found.select(F.col("node").alias("a"), F.col("parent").alias("b"))), "found"
    )
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    placed = classes.join(counts, "node", "left").join(joined, "node", "left").select(
        "label", "vector", "first", F.coalesce("component", "node").alias("component"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    smallest = write_once(
        placed.groupBy("component").agg(F.min("first").alias("component_id")), "smallest"
    )
    placed = write_once(placed.join(smallest, "component"), "placed")
    linked = rows.where("_good").join(placed, ["label", "vector"]).select(
        "_key", "n_links", "component_id"
    )
    alone = rows.where("NOT _good").select(
        "_key", F.lit(0).cast("long").alias("n_links"), F.col("_key").alias("component_id")
    )
    return linked.unionByName(alone).withColumnRenamed("_key", key)
