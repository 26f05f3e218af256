"""Merkle manifest of a dataset: a tree of digests per group, a tree over the groups' roots, and
the siblings of every leaf.

A tree is cut into aligned subtrees of ``HEIGHT`` levels. Each subtree is one row that holds all
of its digests in van Emde Boas order: the order splits a tree at half of its height, puts the
top part first and then each bottom part, and goes on like this inside every part, so that a
walk from a leaf to the root touches few stretches of memory whatever the size of a cache line.
Where a node stands follows from arithmetic alone. The roots of subtrees are the leaves of the
next tree, cut in the same way, until one root is left. Siblings are read the other way round:
each subtree takes the siblings above it and hands them on, with its own, to those below.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import write_once
from .texts import remainder

ARITY = 3
HEIGHT = 7  # levels between the root of a subtree and its leaves: 2,187 leaves at most
HEX = 64

_NODE = "grp string, tree int, position long"
_BLOCK = "grp string, tree int, block long, n long, layout binary, root string"


def nodes_of(levels: int) -> int:
    """Number of nodes of a full tree with so many levels."""
    return (ARITY ** levels - 1) // (ARITY - 1)


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Place of the nodes ``index`` at ``depth`` in the van Emde Boas order of a full tree: the
    top half of the levels comes first, then one bottom tree after the other."""
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    if depth < top:
        return address(top, depth, index)
    below = ARITY ** (depth - top)
    inside = address(levels - top, depth - top, index % below)
    return nodes_of(top) + index // below * nodes_of(levels - top) + inside


@cache
def _addresses(levels: int) -> list[np.ndarray]:
    """Places of all nodes of a full tree, by depth."""
    return [address(levels, d, np.arange(ARITY ** d)) for d in range(levels)]


def height_of(leaves: int) -> int:
    """Levels between the root and the leaves of a tree that holds so many."""
    height = 0
    while ARITY ** height < leaves:
        height += 1
    return height


def joined(digests: Sequence[str]) -> str:
    """The digest of digests, concatenated as lowercase hexadecimal text."""
    return sha256("".join(digests).encode()).hexdigest()


class Subtree:
    """All digests of an aligned subtree with ``count`` leaves, in one array."""

    def __init__(self, count: int, height: int, layout: np.ndarray | None = None):
        self.height = height
        self.counts = [-(-count // ARITY ** (height - d)) for d in range(height + 1)]
        self.places = _addresses(height + 1)
        self.layout = layout
        if layout is None:
            self.layout = np.zeros(nodes_of(height + 1), f"S{HEX}")

    @classmethod
    def built(cls, leaves: Sequence[str], height: int) -> Subtree:
        tree = cls(len(leaves), height)
        row = list(leaves)
        for depth in range(height, -1, -1):
            tree.layout[tree.places[depth][:len(row)]] = row
            if depth:
                row = [joined(row[n:n + ARITY]) for n in range(0, len(row), ARITY)]
        return tree

    @property
    def root(self) -> str:
        return self.layout[0].decode()

    def siblings(self, leaf: int) -> list[tuple[list[str], list[str]]]:
        """Per level, from the leaf up, the other nodes of its run: those before and after."""
        steps = []
        for depth in range(self.height, 0, -1):
            index = leaf // ARITY ** (self.height - depth)
            start = index - index % ARITY
            end = min(start + ARITY, self.counts[depth])
            run = [self.layout[p].decode() for p in self.places[depth][start:end]]
            steps.append((run[:index - start], run[index - start + 1:]))
        return steps


def folded(digest: str, steps: Sequence[tuple[list[str], list[str]]]) -> str:
    """The root that a leaf and its siblings lead to."""
    for before, after in steps:
        digest = joined([*before, digest, *after])
    return digest


def written_steps(steps) -> str:
    """Siblings per level as text: ``before|after`` lists, levels split by ``;``."""
    return ";".join(f"{','.join(b)}|{','.join(a)}" for b, a in steps)


def read_steps(text: str) -> list[tuple[list[str], list[str]]]:
    found = []
    for level in text.split(";") if text else []:
        before, after = level.split("|")
        found.append((before.split(",") if before else [], after.split(",") if after else []))
    return found


def field_text(column: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, ``:`` and the value."""
    text = column.cast("string")
    whole = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(whole, F.lit("-"))


def row_digest(columns: Sequence[Column]) -> Column:
    """SHA-256 of a row's fields, in lowercase hexadecimal."""
    return F.sha2(F.concat(*[field_text(c) for c in columns]).cast("binary"), 256)


@dataclass
class Manifest:
    """``leaves (grp, position, n, leaf, ...)``, a row per leaf with its place inside its group;
    ``blocks``, the subtrees of all levels (``tree`` 0 to ``trees - 1`` for those of groups,
    from ``trees`` on for those over the groups' roots, ``tops`` of them); ``roots (grp, n,
    subroot, place)``; and the ``root``, null if there are no rows."""

    leaves: DataFrame
    blocks: DataFrame
    roots: DataFrame
    trees: int
    tops: int
    root: str | None


def _positions(rows: DataFrame) -> DataFrame:
    """Add ``position``, from 0 inside each group, and ``n``, the rows of the group.

    Rows are sorted over all tasks and written; a group's rows inside a sort partition lie side
    by side, so their places follow from one row for each group and sort partition.
    """
    part, row = F.shiftright("_place", 33), F.col("_place")
    placed = rows.orderBy("grp", "ordinal", "leaf").withColumn(
        "_place", F.monotonically_increasing_id())
    saved = write_once(placed, "leaves").withColumn("_part", part)
    runs = saved.groupBy("grp", "_part").agg(F.min("_place").alias("_first"),
                                             F.count("*").alias("_rows"))
    earlier = Window.partitionBy("grp").orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    runs = runs.withColumns({
        "_before": F.coalesce(F.sum("_rows").over(earlier), F.lit(0)),
        "n": F.sum("_rows").over(Window.partitionBy("grp")),
    }).drop("_rows")
    return saved.join(write_once(runs, "runs"), ["grp", "_part"]).withColumn(
        "position", F.col("_before") + row - F.col("_first")
    ).drop("_place", "_part", "_first", "_before")


def _built(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Subtrees of ``(grp, tree, block, n, position, leaf)``, sorted, one after the other."""
    own: list[tuple] = []
    held: list[str] = []

    def settle(first: tuple) -> tuple:
        grp, tree, block, n = first
        height = HEIGHT if n > ARITY ** HEIGHT else height_of(n)
        made = Subtree.built(held, height)
        return grp, tree, block, n, made.layout.tobytes(), made.root

    last = None
    for frame in rows:
        for grp, tree, block, n, leaf in zip(frame["grp"], frame["tree"], frame["block"],
                                             frame["n"], frame["leaf"]):
            if last is not None and last[:3] != (grp, tree, block):
                own.append(settle(last))
                held.clear()
                if len(own) >= 16:
                    yield pd.DataFrame(own, columns=_names(_BLOCK))
                    own.clear()
            last = (grp, tree, block, n)
            held.append(leaf)
    if last is not None:
        own.append(settle(last))
    if own:
        yield pd.DataFrame(own, columns=_names(_BLOCK))


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _subtrees(leaves: DataFrame, tree: int) -> DataFrame:
    """Written subtrees of ``leaves (grp, position, n, leaf)``; a group's blocks spread over
    all tasks, whatever its size."""
    block = F.floor(F.col("position") / ARITY ** HEIGHT).cast("long")
    cut = leaves.select("grp", F.lit(tree).alias("tree"), block.alias("block"), "n",
                        "position", "leaf")
    # Groups differ in size, but a block has 2,187 rows at most.
    dealt = cut.repartition("grp", "block").sortWithinPartitions("grp", "block", "position")
    return write_once(dealt.drop("position").mapInPandas(_built, _BLOCK), "subtrees")


def _tree(leaves: DataFrame, first: int) -> tuple[DataFrame, DataFrame, int]:
    """All subtrees over ``leaves``, the roots ``(grp, subroot)``, and the number of rounds."""
    size = ARITY ** HEIGHT
    rounds = [_subtrees(leaves, first)]
    roots = rounds[0].where(F.col("n") <= size)
    above = rounds[0].where(F.col("n") > size)
    while above.take(1):
        upper = above.select("grp", F.col("block").alias("position"),
                             F.ceil(F.col("n") / size).cast("long").alias("n"), F.col("root").alias("leaf"))
        rounds.append(_subtrees(upper, first + len(rounds)))
        roots = roots.unionByName(rounds[-1].where(F.col("n") <= size))
        above = rounds[-1].where(F.col("n") > size)
    blocks = rounds[0]
    for more in rounds[1:]:
        blocks = blocks.unionByName(more)
    return blocks, roots.select("grp", F.col("root").alias("subroot")), len(rounds)


def build_manifest(leaves: DataFrame) -> Manifest:
    """The manifest of ``leaves (grp, ordinal, leaf, ...)``, other columns carried along.

    Inside a group leaves ascend by ``ordinal``, null first, rows with equal ones by digest;
    groups ascend bytewise, null first. Every three consecutive nodes become one until one is
    left; a lone leaf is a root itself. An empty table has no root.
    """
    named = leaves.withColumn("grp", group_text(F.col("grp")))
    placed = write_once(_positions(named), "placed")
    blocks, roots, trees = _tree(placed.select("grp", "position", "n", "leaf"), 0)
    roots = write_once(roots, "subroots")
    tops = roots.select(F.lit("").alias("grp"), F.col("grp").alias("ordinal"),
                        F.col("subroot").alias("leaf"))
    top = write_once(_positions(tops), "tops")
    over, ends, rounds = _tree(top.select("grp", "position", "n", "leaf"), trees)
    found = ends.first()
    groups = top.select(F.col("ordinal").alias("grp"), F.col("leaf").alias("subroot"),
                        F.col("position").alias("place"))
    return Manifest(placed, blocks.unionByName(over), groups, trees, rounds,
                    found["subroot"] if found else None)


def group_text(group: Column) -> Column:
    """A group's name behind a mark that keeps null apart from every text, and first."""
    return F.coalesce(F.concat(F.lit("1"), group.cast("string")), F.lit("0"))


def _handed_down(layout: bytes, n: int, block: int, positions: Sequence[int], above: str):
    """Siblings of the given leaves of a subtree, with those above it."""
    size = ARITY ** HEIGHT
    height = HEIGHT if n > size else height_of(n)
    here = min(n - block * size, size)
    tree = Subtree(here, height, np.frombuffer(layout, f"S{HEX}"))
    upper = read_steps(above)
    return [tree.siblings(p - block * size) + upper for p in positions]


def _paths_below(key: tuple, leaves: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
    row = next(block.itertuples(index=False))
    steps = _handed_down(row.layout, row.n, row.block, leaves["position"], row.above)
    return pd.DataFrame({"grp": leaves["grp"], "position": leaves["position"],
                         "above": [written_steps(s) for s in steps]})


def _proofs(key: tuple, leaves: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
    row = next(block.itertuples(index=False))
    steps = _handed_down(row.layout, row.n, row.block, leaves["position"], row.above)
    flat = [[d for before, after in s for d in before + after] for s in steps]
    return leaves[["id", "leaf"]].assign(
        proof=[joined(f) for f in flat],
        folded=[folded(d, s) for d, s in zip(leaves["shown"], steps)],
        subroot=row.subroot,
    )


def _asked(leaves: DataFrame, blocks: DataFrame, function, schema: str) -> DataFrame:
    """Cogroup leaves with the subtree that holds them."""
    block = F.floor(F.col("position") / ARITY ** HEIGHT).cast("long")
    return leaves.withColumn("block", block).groupBy("grp", "block").cogroup(
        blocks.groupBy("grp", "block")).applyInPandas(function, schema)


def _paths(blocks: DataFrame, first: int, rounds: int, start: DataFrame) -> DataFrame:
    """Subtrees of round ``first`` with ``above``, the siblings from their root upwards.
    ``start (grp, above)`` holds what stands above each group's root."""
    def of(tree: int) -> DataFrame:
        return blocks.where(F.col("tree") == tree).drop("tree", "root")

    size = ARITY ** HEIGHT
    below = None
    for tree in range(first + rounds - 1, first - 1, -1):
        own = of(tree)
        tops = own.where(F.col("n") <= size).join(start, "grp")
        if below is not None:
            # Each subtree of this round is a leaf of the round above.
            asked = own.where(F.col("n") > size).select("grp", F.col("block").alias("position"))
            paths = _asked(asked, below, _paths_below, "grp string, position long, above string")
            paths = paths.withColumnRenamed("position", "block")
            tops = tops.unionByName(own.where(F.col("n") > size).join(paths, ["grp", "block"]))
        below = write_once(tops, "paths")
    return below


def prove(manifest: Manifest) -> DataFrame:
    """``(id, leaf, subroot, proof, folded)`` for every leaf, from its columns ``id`` and
    ``shown``: the digest of its siblings, and the root that the digest ``shown`` leads to with
    them.

    Only digests move: leaves meet the subtree that holds them, 2,187 at a time.
    """
    spark = manifest.leaves.sparkSession
    nothing = spark.createDataFrame([("", "")], "grp string, above string")
    top = _paths(manifest.blocks, manifest.trees, manifest.tops, nothing)
    asked = manifest.roots.select(F.lit("").alias("grp"), F.col("place").alias("position"))
    paths = _asked(asked, top, _paths_below, "grp string, position long, above string")
    start = write_once(
        manifest.roots.join(paths.select(F.col("position").alias("place"), "above"), "place")
        .select("grp", "above", "subroot"), "starts")
    lowest = _paths(manifest.blocks, 0, manifest.trees, start.drop("subroot"))
    lowest = lowest.join(start.select("grp", "subroot"), "grp")
    leaves = manifest.leaves.select("grp", "position", "id", "leaf", "shown")
    return _asked(leaves, lowest, _proofs, "id string, leaf string, subroot string, "
                  "proof string, folded string")


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def audited(df: DataFrame, key: str = "doc_id", group: str = "source",
            fields: Sequence[str] = FIELDS, text: str = "text") -> DataFrame:
    """``(key, leaf, subroot, root, proof_sha256, folded_root, verified)`` for every row, folded
    from a tampered row where 2 divides the CRC-32 of the key.

    Tampering deletes the line ends of the text; a text without any stays as it is and verifies.
    Nulls count as fields of their own; null groups come first, null keys first in their group,
    and rows with equal keys go by digest. Rows that repeat are leaves each. Other columns of
    ``df`` are not read, whatever their names. An empty table gives an empty result. Texts are
    read whole and never shuffled.
    """
    bare = F.translate(F.col(text), "\n", "")
    chosen = remainder(key, 2) == 0
    shown = [F.when(chosen, bare).otherwise(F.col(c)) if c == text else F.col(c) for c in fields]
    rows = df.select(
        F.col(group).alias("grp"), F.col(key).alias("ordinal"),
        F.col(key).cast("string").alias("id"),
        row_digest([F.col(c) for c in fields]).alias("leaf"), row_digest(shown).alias("shown"),
    )
    manifest = build_manifest(write_once(rows, "digests"))
    kind = dict(rows.dtypes)["ordinal"]
    found = prove(manifest)
    root = F.lit(manifest.root).cast("string")
    return found.select(
        F.col("id").cast(kind).alias(key), "leaf", "subroot", root.alias("root"),
        F.col("proof").alias("proof_sha256"), F.col("folded").alias("folded_root"),
        (F.col("folded") == root).alias("verified"),
    )
