"""Forests over vectors too wide for dense rows of bins.

The library's forest holds each row as a bin for every feature: a megabyte for hashed text of the
usual width. Here rows stay sparse. A level of all trees is one scan: a task walks its rows to
the open nodes and hands on the class weights of the values found there, for the features that a
node has drawn; whatever is not stored is zero, so zeros follow from the totals of a node. Every
cut between two values of a feature is tried, without bins. The best split of a node is found in
a task of its own, and the driver holds the trees alone.

The rules are those of the library at its defaults: Poisson weights, features drawn anew for each
node, Gini gain, all ways to part few categories, and leaves that say the same merged. Rows that
are equal get the sum of their weights at once, drawn from their values, so a forest does not
depend on the layout of its table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorIndexerModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.vector_categories import categories_of, indexer_of
from ..sources.scratch import new_folder, write_once

# Rows that a task walks at a time; it holds a number for each of them and each split so far.
ROWS_AT_ONCE = 2048

_EMPTY = float(np.finfo(float).eps)
_FOUND = "slot int, feature int, value double, y int, weight long"
_BEST = "slot int, counts array<long>, feature int, threshold double, left array<int>, " \
    "gain double, left_counts array<long>"
_NODE = "treeID int, nodeData struct<id int, prediction double, impurity double, " \
    "impurityStats array<double>, rawCount long, gain double, leftChild int, rightChild int, " \
    "split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>"


@dataclass
class _Node:
    """A node of a growing tree; ``left`` and ``right`` are numbers of nodes of the same tree."""

    depth: int
    counts: np.ndarray | None = None
    feature: int = -1
    threshold: float = 0.0
    categories: list[int] | None = None
    gain: float = -1.0
    left: int = -1
    right: int = -1


def gini(counts: np.ndarray) -> np.ndarray:
    """The impurity of each row of class weights; 0 for a row without any."""
    total = counts.sum(-1, keepdims=True)
    return np.where(total[..., 0] > 0, 1 - ((counts / np.maximum(total, 1)) ** 2).sum(-1), 0.0)


def _weighed(seed: int, trees: int, bootstrap: bool, arity: np.ndarray, named: np.ndarray):
    """Per row its values, those of dimensions with categories as numbers of these, and one
    weight for each tree: what as many Poisson draws as the row has copies add up to."""
    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [batch.column(n).to_numpy().view(np.uint64) for n in ("a", "b")]
            copies = batch.column("copies").to_numpy()
            weights = np.repeat(copies[:, None], trees, axis=1)
            if bootstrap:
                for n, (a, b) in enumerate(zip(*(k.tolist() for k in keys))):
                    weights[n] = np.random.default_rng([seed, a, b]).poisson(copies[n], trees)
            places, values = batch.column("places"), batch.column("values").flatten().to_numpy()
            place, indexed = places.flatten().to_numpy(), values.copy()
            few = arity[place] > 0
            indexed[few] = 0
            for number in range(1, named.shape[1]):
                indexed[few & (named[place, number] == values)] = number
            offsets = places.offsets.to_numpy()
            offsets = pa.array(offsets - offsets[0])
            each = pa.array(np.arange(len(weights) + 1, dtype=np.int32) * trees)
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), pa.ListArray.from_arrays(offsets, pa.array(place)),
                 pa.ListArray.from_arrays(offsets, pa.array(indexed)),
                 pa.ListArray.from_arrays(each, pa.array(weights.ravel()))],
                ["y", "places", "values", "weights"])

    return draw


def weighed_rows(
    rows: DataFrame, label: str, vector: str, seed: int, trees: int, bootstrap: bool,
    arity: np.ndarray, named: np.ndarray,
) -> DataFrame:
    """``(y, places, values, weights)``, one row for all rows that are equal, written down."""
    parts = rows.select(F.col(label).cast("int").alias("y"), F.unwrap_udt(vector).alias("v"))
    places = F.when(F.col("v.type") == 0, F.col("v.indices")).otherwise(
        F.sequence(F.lit(0), F.size("v.values") - 1))
    parts = parts.select("y", places.alias("places"), F.col("v.values").alias("values"))
    marks = [F.xxhash64(F.lit(n), "y", "places", "values").alias(n) for n in "ab"]
    equal = parts.select(*marks, F.struct("*").alias("row")).groupBy("a", "b").agg(
        F.first("row").alias("row"), F.count("*").alias("copies"))
    drawn = equal.select("a", "b", "copies", "row.*").mapInArrow(
        _weighed(seed, trees, bootstrap, arity, named),
        "y int, places array<int>, values array<double>, weights array<long>")
    return write_once(drawn, "weighed-rows")


@dataclass
class _Level:
    """What a task needs to walk rows to the open nodes of all trees, which are numbered as
    slots, and to tell the features that these have drawn."""

    width: int
    features: np.ndarray  # those that the trees split by
    trees: list[dict[str, np.ndarray]]
    keys: list[np.ndarray]  # for each tree, slot * width + feature of all that was drawn
    slots: int
    classes: int


def _walked(tree: dict[str, np.ndarray], table: np.ndarray, depth: int) -> np.ndarray:
    """The slot that each row ends in, -1 for a leaf."""
    node, each = np.zeros(len(table), np.int64), np.arange(len(table))
    for _ in range(depth):
        column = tree["column"][node]
        value = table[each, column] if table.shape[1] else np.zeros(len(table))
        category = np.clip(value, 0, 62).astype(np.int64)
        goes_left = np.where(tree["mask"][node] >= 0, (tree["mask"][node] >> category) & 1 == 1,
                             value <= tree["threshold"][node])
        following = np.where(goes_left, tree["left"][node], tree["right"][node])
        node = np.where(column >= 0, following, node)
    return tree["slot"][node]


def _found(level: _Level, depth: int):
    """Per task the class weights that its rows add to each slot, feature and value other than
    zero, and to each slot as a whole (feature -1)."""
    width = level.width

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((level.slots, level.classes), np.int64)
        column = np.full(width, -1, np.int32)  # of each feature that is split by
        column[level.features] = np.arange(len(level.features))
        drawn = np.zeros((len(level.trees), width), bool)  # by any open node of each tree
        for t, keys in enumerate(level.keys):
            drawn[t, keys % width] = True
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                y = batch.column("y").to_numpy()
                lists = batch.column("places")
                lengths = np.diff(lists.offsets.to_numpy())
                row = np.repeat(np.arange(len(y)), lengths)
                place = lists.flatten().to_numpy()
                value = batch.column("values").flatten().to_numpy()
                weights = batch.column("weights").flatten().to_numpy().reshape(len(y), -1)
                stored = value != 0
                row, place, value = row[stored], place[stored], value[stored]
                table = np.zeros((len(y), len(level.features)))
                split = np.flatnonzero(column[place] >= 0)
                table[row[split], column[place[split]]] = value[split]
                out = []
                for t, tree in enumerate(level.trees):
                    if not len(level.keys[t]):
                        continue
                    slot = _walked(tree, table, depth)
                    slot = np.where(weights[:, t] > 0, slot, -1)
                    here = slot >= 0
                    np.add.at(totals, (slot[here], y[here]), weights[here, t])
                    some = np.flatnonzero(drawn[t][place])
                    some = some[slot[row[some]] >= 0]
                    key = slot[row[some]] * width + place[some]
                    at = np.searchsorted(level.keys[t], key)
                    at = np.minimum(at, len(level.keys[t]) - 1)
                    some = some[level.keys[t][at] == key]
                    own = row[some]
                    out.append((slot[own], place[some], value[some], y[own], weights[own, t]))
                if out:
                    yield _batch(*(np.concatenate(part) for part in zip(*out)))
        slot, y = np.nonzero(totals)
        yield _batch(slot, np.full(len(slot), -1), np.zeros(len(slot)), y, totals[slot, y])

    return collect


def _batch(slot, feature, value, y, weight) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(slot.astype(np.int32)), pa.array(feature.astype(np.int32)),
         pa.array(value.astype(float)), pa.array(y.astype(np.int32)),
         pa.array(weight.astype(np.int64))],
        ["slot", "feature", "value", "y", "weight"])


def best_split(found: pd.DataFrame, classes: int, arity: np.ndarray) -> tuple | None:
    """``(feature, threshold, left categories, gain, left counts)`` of one node, from its rows of
    :func:`_found`; None if no split gains. Ties go to the first feature and cut."""
    totals = np.zeros(classes, np.int64)
    whole = found[found["feature"] < 0]
    totals[whole["y"]] = whole["weight"]
    found = found[found["feature"] >= 0]
    if not len(found):
        return None
    cells, cell = np.unique(found[["feature", "value"]].to_numpy(float), axis=0,
                            return_inverse=True)
    counts = np.zeros((len(cells), classes), np.int64)
    np.add.at(counts, (cell.ravel(), found["y"]), found["weight"])
    features, first = np.unique(cells[:, 0], return_index=True)
    zeros = totals - np.add.reduceat(counts, first, axis=0)
    kept = zeros.sum(1) > 0
    cells = np.vstack([cells, np.column_stack([features, np.zeros(len(features))])[kept]])
    counts = np.vstack([counts, zeros[kept]])
    order = np.lexsort((cells[:, 1], cells[:, 0]))
    cells, counts = cells[order], counts[order]
    few = arity[cells[:, 0].astype(int)] > 0

    ways = []  # (feature, place among its cuts, threshold, mask, left counts)
    c, n = cells[~few], counts[~few]
    if len(c) > 1:
        start = np.flatnonzero(np.r_[True, c[1:, 0] != c[:-1, 0]])
        upto = np.cumsum(n, axis=0)
        before = np.repeat(upto[start] - n[start], np.diff(np.r_[start, len(c)]), axis=0)
        cut = np.flatnonzero(c[1:, 0] == c[:-1, 0])
        ways.append((c[cut, 0], cut, (c[cut, 1] + c[cut + 1, 1]) / 2, np.full(len(cut), -1),
                     (upto - before)[cut]))
    c, n = cells[few], counts[few]
    if len(c):
        owners, place = np.unique(c[:, 0], return_inverse=True)
        sizes = arity[owners.astype(int)].astype(np.int64)
        by_category = np.zeros((len(owners), int(sizes.max()), classes), np.int64)
        by_category[place.ravel(), c[:, 1].astype(int)] = n
        for mask in range(1, 1 << (int(sizes.max()) - 1)):
            asked = np.flatnonzero(mask < 1 << (sizes - 1))
            held = [i for i in range(int(sizes.max())) if mask >> i & 1]
            ways.append((owners[asked], np.full(len(asked), mask), np.zeros(len(asked)),
                         np.full(len(asked), mask), by_category[asked][:, held].sum(1)))
    if not ways:
        return None
    feature, place, threshold, mask, left = (np.concatenate(w) for w in zip(*ways))
    right, total = totals - left, totals.sum()
    share = left.sum(1) / total
    gain = gini(totals) - share * gini(left) - (1 - share) * gini(right)
    gain = np.where((left.sum(1) > 0) & (right.sum(1) > 0), gain, 0.0)
    order = np.lexsort((place, feature))
    best = order[np.argmax(gain[order])]
    if gain[best] <= 0:
        return None
    held = None if mask[best] < 0 else [i for i in range(int(mask[best]).bit_length())
                                        if mask[best] >> i & 1]
    return int(feature[best]), float(threshold[best]), held, float(gain[best]), left[best]


def _best(classes: int, arity: np.ndarray):
    def choose(found: pd.DataFrame) -> pd.DataFrame:
        totals = np.zeros(classes, np.int64)
        whole = found[found["feature"] < 0]
        totals[whole["y"]] = whole["weight"]
        best = best_split(found, classes, arity)
        feature, threshold, left, gain, counts = best or (-1, 0.0, None, -1.0, totals * 0)
        return pd.DataFrame({
            "slot": [int(found["slot"].iloc[0])], "counts": [totals.tolist()],
            "feature": [feature], "threshold": [threshold], "left": [left], "gain": [gain],
            "left_counts": [counts.tolist()]})

    return choose


def _level(
    trees: list[list[_Node]], slots: list[tuple[int, int]], drawn: list[np.ndarray],
    width: int, classes: int
) -> _Level:
    features = np.array(
        sorted({n.feature for tree in trees for n in tree if n.feature >= 0}), np.int64)
    column = {f: n for n, f in enumerate(features.tolist())}
    number = {at: n for n, at in enumerate(slots)}
    tables, keys = [], []
    for t, tree in enumerate(trees):
        tables.append({
            "column": np.array([column.get(n.feature, -1) for n in tree]),
            "threshold": np.array([n.threshold for n in tree]),
            "mask": np.array([-1 if n.categories is None else sum(1 << c for c in n.categories)
                              for n in tree], np.int64),
            "left": np.array([n.left for n in tree]), "right": np.array([n.right for n in tree]),
            "slot": np.array([number.get((t, i), -1) for i in range(len(tree))]),
        })
        own = [n for n, at in enumerate(slots) if at[0] == t]
        keys.append(np.concatenate([n * width + drawn[n] for n in own] or [np.zeros(0, np.int64)]))
    return _Level(width, features, tables, keys, len(slots), classes)


def _merged(tree: list[_Node], at: int = 0) -> list[_Node]:
    """The subtree as a list in preorder; two leaves with the same prediction become one."""
    node = tree[at]
    leaf = _Node(node.depth, node.counts)
    if node.feature < 0:
        return [leaf]
    left, right = _merged(tree, node.left), _merged(tree, node.right)
    if len(left) == len(right) == 1 and left[0].counts.argmax() == right[0].counts.argmax():
        return [leaf]
    return [node, *left, *right]


def _saved(tree: int, nodes: list[_Node], arity: np.ndarray) -> list[tuple]:
    """Rows of the library's format for the nodes of a tree in preorder."""
    children, rows = {}, []

    def walk(at: int) -> int:
        """The place after the subtree."""
        if nodes[at].feature < 0:
            return at + 1
        right = walk(at + 1)
        children[at] = (at + 1, right)
        return walk(right)

    walk(0)
    for i, n in enumerate(nodes):
        left, right = children.get(i, (-1, -1))
        split = (-1, [], -1)
        if n.feature >= 0 and n.categories is None:
            split = (n.feature, [n.threshold], -1)
        elif n.feature >= 0:  # one category more: what the fit has not seen goes right
            split = (n.feature, [float(c) for c in n.categories], int(arity[n.feature]) + 1)
        rows.append((tree, (i, float(n.counts.argmax()), float(gini(n.counts)),
                            n.counts.astype(float).tolist(), int(n.counts.sum()),
                            n.gain if n.feature >= 0 else -1.0, left, right, split)))
    return rows


def grow(
    rows: DataFrame, trees: int, depth: int, width: int, classes: int, arity: np.ndarray,
    features: int, seed: int
) -> list[list[_Node]]:
    """The trees, each a list of nodes that starts with the root, from :func:`weighed_rows`."""
    grown = [[_Node(0)] for _ in range(trees)]
    slots = [(t, 0) for t in range(trees)]
    for level in range(depth):
        drawn = [np.sort(np.random.default_rng([seed, t, level, i]).choice(
            width, features, replace=False)).astype(np.int64) for t, i in slots]
        task = _level(grown, slots, drawn, width, classes)
        found = rows.mapInArrow(_found(task, level), _FOUND).groupBy(
            "slot", "feature", "value", "y").agg(F.sum("weight").alias("weight"))
        best = found.groupBy("slot").applyInPandas(_best(classes, arity), _BEST).collect()
        opened = []
        for r in sorted(best, key=lambda r: r["slot"]):
            t, i = slots[r["slot"]]
            node, counts = grown[t][i], np.array(r["counts"], np.int64)
            node.counts = counts
            if r["feature"] < 0:
                continue
            node.feature, node.threshold, node.gain = r["feature"], r["threshold"], r["gain"]
            node.categories = r["left"]
            left = np.array(r["left_counts"], np.int64)
            node.left, node.right = len(grown[t]), len(grown[t]) + 1
            for part in (left, counts - left):
                if level + 1 < depth and gini(part) >= _EMPTY:
                    opened.append((t, len(grown[t])))
                grown[t].append(_Node(level + 1, part))
        slots = opened
        if not slots:
            break
    for tree in grown:  # a tree whose weights are all 0
        if tree[0].counts is None:
            tree[0].counts = np.zeros(classes, np.int64)
    return grown


def fit_wide_forest(
    estimator: RandomForestClassifier, rows: DataFrame, vector: str, classes: int, most: int
) -> tuple[VectorIndexerModel, RandomForestClassificationModel]:
    """What ``estimator`` would fit on the column ``vector`` of ``rows``, indexed for at most
    ``most`` categories, with its trees, depth, seed, choice of features (``auto`` or ``all``)
    and ``bootstrap``; its other settings count as the defaults. Labels are 0 to ``classes - 1``.

    All dimensions are indexed for the fit. The indexer that is returned has the categories of
    those that trees split by, as no other is looked at later, and one with maps of all of them
    would be copied into every task. The forest is one of the library: its fit of two rows
    without entries gives the frame, which is saved, gets the trees, and is loaded.
    """
    spark, label, output = rows.sparkSession, estimator.getLabelCol(), estimator.getFeaturesCol()
    arity, named = categories_of(rows, vector, most)
    width, trees, seed = len(arity), estimator.getNumTrees(), estimator.getSeed()
    strategy = estimator.getFeatureSubsetStrategy()
    whole = strategy == "all" or (strategy == "auto" and trees == 1)
    features = width if whole else int(np.ceil(np.sqrt(width)))
    weighed = weighed_rows(
        rows, label, vector, seed, trees, estimator.getBootstrap(), arity, named)
    grown = grow(weighed, trees, estimator.getMaxDepth(), width, classes, arity, features, seed)
    merged = [_merged(tree) for tree in grown]
    asked = {n.feature for tree in merged for n in tree if n.categories is not None}
    indexer = indexer_of(spark, {d: named[d, :arity[d]].tolist() for d in sorted(asked)},
                         width, vector, output, most)
    names = {"ml_attr": {"type": "nominal", "vals": [str(c) for c in range(classes)]}}
    empty = spark.createDataFrame([(0.0, Vectors.sparse(width, {}))] * 2, [label, output])
    path = new_folder(spark, "wide-forest")
    estimator.fit(empty.withMetadata(label, names)).write().save(path)
    nodes = [r for t, tree in enumerate(merged) for r in _saved(t, tree, arity)]
    spark.createDataFrame(nodes, _NODE).write.mode("overwrite").parquet(f"{path}/data")
    return indexer, RandomForestClassificationModel.load(path)
