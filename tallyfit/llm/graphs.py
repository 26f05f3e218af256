"""Connected components: inside a task over arrays, and over a table of links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import write_once


def smallest_labels(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For nodes 0 to ``count - 1`` and links ``left[i]``-``right[i]``: the smallest node that
    each node reaches."""
    labels = np.arange(count)
    while True:
        a, b = labels[left], labels[right]
        low = np.minimum(a, b)
        lower = labels.copy()
        np.minimum.at(lower, a, low)
        np.minimum.at(lower, b, low)
        while not np.array_equal(lower, hop := lower[lower]):
            lower = hop
        if np.array_equal(lower, labels):
            return labels
        labels = lower


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links (a, b)``; the component is named after
    its smallest node. Nodes are integers without null; repeated links and links from a node
    to itself do no harm, and an empty table gives an empty one.

    Star contraction: every node hands its larger neighbours to its smallest one, then every
    node hands its smaller neighbours on. Rounds grow with the logarithm of the longest chain.
    Each half round aggregates a minimum, combined before the shuffle, and joins it back from a
    written table, so that a node with very many neighbours is split by the skew join. Rounds
    are written to the shared folder; a lost executor costs no earlier round.
    """
    down = write_once(_downward(links), "links")
    state = _state(down)
    while True:
        down = _smaller_to_smallest(_larger_to_smallest(down))
        after = _state(down)
        if after == state:
            break
        state = after
    children = down.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = down.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return children.unionByName(roots)


def _downward(links: DataFrame) -> DataFrame:
    """Each link once, from its larger node ``a`` to its smaller one ``b``."""
    ends = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return ends.where("a <> b").distinct()


def _state(down: DataFrame) -> tuple:
    return tuple(down.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _larger_to_smallest(down: DataFrame) -> DataFrame:
    both = down.unionByName(down.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = write_once(both.groupBy("a").agg(F.min("b").alias("low")), "lowest")
    # A node's larger neighbours are those of which it is the lower end.
    upward = down.select(F.col("b").alias("a"), F.col("a").alias("up"))
    moved = upward.join(lowest, "a").select(
        F.col("up").alias("a"), F.least("a", "low").alias("b")
    )
    return write_once(_downward(moved), "links")


def _smaller_to_smallest(down: DataFrame) -> DataFrame:
    lowest = write_once(down.groupBy("a").agg(F.min("b").alias("low")), "lowest")
    moved = down.join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    kept = lowest.select("a", F.col("low").alias("b"))
    return write_once(_downward(moved.unionByName(kept)), "links")
