"""Mixing sources to target weights: exact block quotas, split among shards by a random tree.

The documents of a source are in a shuffled order that their values fix, cut into blocks. A
target above the size of its source takes whole passes over it and then the first part of one
more. The end of that part is found from word counts per slice of the order and a second look
into one slice, so no source is sorted as a whole. What the next document is too long for is
filled with shorter ones from further on, chosen from counts of their sizes. Which shard gets which block is drawn down a
binary tree: each half gets a multivariate-hypergeometric share of its parent's quotas.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import write_once
from .texts import shuffled_place, word_count

WEIGHTS = (1.0, 2.0, 3.0)
MOST_PASSES = 3
SHARDS = 16
BLOCKS = 4096  # of the whole mix, about; a source has one more at most for each pass
SLICE_BITS = 12
SEED = 8


def capped_targets(
    sizes: Sequence[int], weights: Sequence[float], most: float = MOST_PASSES
) -> list[float]:
    """Shares of the total by weight, none above ``most`` times its size; what is cut off is
    shared by weight among the rest until nothing is above."""
    total, cap = float(sum(sizes)), [most * s for s in sizes]
    capped: set[int] = set()
    while True:
        room = total - sum(cap[i] for i in capped)
        weight = sum(w for i, w in enumerate(weights) if i not in capped)
        unit = room / weight if weight else 0.0
        over = {i for i, w in enumerate(weights) if i not in capped and unit * w > cap[i]}
        if not over:
            return [float(cap[i]) if i in capped else unit * w for i, w in enumerate(weights)]
        capped |= over


def split_quotas(quotas: Sequence[int], shards: int, seed: int = SEED) -> np.ndarray:
    """``share[shard][source]``: blocks of each source that each shard gets. Rows differ by at
    most one block in total, columns add up to the quotas, and every way of dealing the blocks
    to the shards is equally likely."""
    random = np.random.default_rng([seed, shards, len(quotas)])
    share = np.zeros((shards, len(quotas)), np.int64)

    def split(left: np.ndarray, first: int, count: int) -> None:
        if count == 1:
            share[first] = left
            return
        half = count // 2
        total = int(left.sum())
        # Shard k of n ends at block total * (k + 1) // n of its parent, halves likewise.
        take = total * half // count
        part = random.multivariate_hypergeometric(left, take, method="marginals")
        split(part, first, half)
        split(left - part, first + half, count - half)

    split(np.array(quotas, np.int64), 0, shards)
    return share


def deal_blocks(quotas: Sequence[int], shards: int, seed: int = SEED) -> list[list[int]]:
    """Per source the shard of each of its blocks, in a permuted order of the blocks."""
    if not quotas:
        return []
    share = split_quotas(quotas, shards, seed)
    dealt = []
    for source, quota in enumerate(quotas):
        order = np.random.default_rng([seed, 1, source]).permutation(quota)
        shard = np.empty(quota, np.int64)
        shard[order] = np.repeat(np.arange(shards), share[:, source])
        dealt.append(shard.tolist())
    return dealt


_PLAN = (
    "_source string, source_size long, target double, _passes int, _end long, "
    "_extras array<long>, _blocks int, _shards array<int>"
)


def closest_fill(gap: float, counts: dict[int, int]) -> dict[int, int]:
    """How many documents of each size, of ``counts``, fill a gap: the largest first, as long as
    they fit, and where that comes closer, one that is too long in the end. What is missed is at
    most half of the smallest document that the largest first would leave out."""
    sizes, left, taken = sorted(counts), gap, []
    best, fill = left, {}

    def weigh() -> None:
        """Keep what is taken so far, with or without one more, if nothing came closer yet."""
        nonlocal best, fill
        if left < best:
            best, fill = left, dict(taken)
        for size in sizes[bisect_right(sizes, left):]:
            if size - left >= best:
                return
            if counts[size] > (own := dict(taken).get(size, 0)):
                best, fill = size - left, dict(taken) | {size: own + 1}
                return

    weigh()
    for size in reversed(sizes):
        number = min(counts[size], int(left // size))
        if number:
            taken.append((size, number))
            left -= number * size
            weigh()
    return fill


def _chosen(found: pd.DataFrame) -> pd.DataFrame:
    fill = closest_fill(float(found["gap"].iloc[0]),
                        dict(zip(found["size"].tolist(), found["count"].tolist())))
    return pd.DataFrame({"source": [found["source"].iloc[0]] * len(fill), "size": list(fill),
                         "picked": list(fill.values())})


def fillers(rows: DataFrame, gaps: DataFrame) -> dict[str | None, list[int]]:
    """The places of the documents that fill the gap of each source: of ``rows (source, size,
    place)`` beyond the ``cut`` of ``gaps (name, cut, gap)``. Rows with equal places count
    together. A task sees the sizes of a source up to twice its gap, not its documents."""
    same = F.col("source").eqNullSafe(F.col("name"))
    short = (F.col("size") > 0) & (F.col("size") < 2 * F.col("gap"))
    near = rows.join(F.broadcast(gaps), same).where((F.col("place") > F.col("cut")) & short)
    units = near.groupBy("source", "gap", "place").agg(F.sum("size").alias("size")).where(short)
    counts = units.groupBy("source", "gap", "size").count()
    picks = write_once(counts.groupBy("source").applyInPandas(
        _chosen, "source string, size long, picked long"), "picks")
    most = picks.agg(F.max("picked").alias("most")).first()["most"] or 0
    picks = F.broadcast(picks.withColumnsRenamed({"source": "name", "size": "wanted"}))
    found = units.join(picks, same & (F.col("size") == F.col("wanted")))
    in_order = Window.partitionBy("source", "size").orderBy("place")
    first = found.withColumn("number", F.row_number().over(in_order)).where(
        (F.col("number") <= most) & (F.col("number") <= F.col("picked")))
    filled: dict[str | None, list[int]] = {}
    for r in first.select("source", "place").collect():
        filled.setdefault(r["source"], []).append(r["place"])
    return filled


def plan_mix(
    rows: DataFrame, weights: Sequence[float], most: int, shards: int, seed: int
) -> DataFrame:
    """One row for each source of ``rows (source, size, place)``: its size and target in words,
    its whole passes, where its last part pass ends, the documents that fill what is left, and
    the shard of each block. The driver holds a few numbers for each source, and the places of
    those documents, which have no more words than the longest."""
    by_source = rows.groupBy("source").agg(F.sum("size").alias("size"))
    sources = by_source.orderBy(F.col("source").asc_nulls_last()).collect()
    names, sizes = [r["source"] for r in sources], [int(r["size"]) for r in sources]
    targets = capped_targets(sizes, [weights[i % len(weights)] for i in range(len(names))], most)
    passes = [min(most, int(t // s)) if s else 0 for s, t in zip(sizes, targets)]
    parts = [max(0.0, t - p * s) if p < most else 0.0
             for s, t, p in zip(sizes, targets, passes)]
    spark = rows.sparkSession
    wanted = F.broadcast(spark.createDataFrame(
        list(zip(names, parts)), "name string, part double"
    ))
    sliced = rows.withColumn("slice", F.shiftright("place", 63 - SLICE_BITS))
    upto = Window.partitionBy("source").orderBy("slice")
    sums = sliced.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    sums = sums.withColumn("after", F.sum("words").over(upto))
    same = F.col("source").eqNullSafe(F.col("name"))
    last = sums.join(wanted, same).where(
        (F.col("part") > 0) & (F.col("after") > F.col("part"))
        & (F.col("after") - F.col("words") <= F.col("part"))
    )
    # At most one slice of each source; empty slices before it hold no words.
    last = F.broadcast(last.select("name", "part", F.col("slice").alias("cut"),
                                   (F.col("after") - F.col("words")).alias("before")))
    inside = sliced.join(last, same & (F.col("slice") == F.col("cut")))
    in_order = Window.partitionBy("source").orderBy("place")  # equal places count together
    inside = inside.withColumn("end", F.col("before") + F.sum("size").over(in_order))
    taken = F.col("end") <= F.col("part")
    ends = {
        r["source"]: r for r in inside.groupBy("source", "cut", "before", "part").agg(
            F.max(F.when(taken, F.col("place"))).alias("place"),
            F.max(F.when(taken, F.col("end"))).alias("end"),
        ).collect()
    }
    left, cuts = [], []
    for name, part in zip(names, parts):
        row = ends.get(name)
        if row is None:  # nothing is wanted, or (by rounding) the whole source
            cuts.append((1 << 63) - 1 if part > 0 else -1)
        else:
            done = row["end"] is not None
            cuts.append(row["place"] if done else (row["cut"] << (63 - SLICE_BITS)) - 1)
            left.append((name, cuts[-1], float(part - (row["end"] if done else row["before"]))))
    extras = fillers(rows, spark.createDataFrame(left, "name string, cut long, gap double"))
    width = max(1.0, sum(targets) / BLOCKS)
    blocks = [max(1, int(np.ceil(s / width))) for s in sizes]
    quotas = [p * b + ((cut * b >> 63) + 1 if cut >= 0 else 0) + (name in extras)
              for name, p, b, cut in zip(names, passes, blocks, cuts)]
    dealt = deal_blocks(quotas, shards, seed)
    return spark.createDataFrame(
        [(n, s, t, p, c, extras.get(n, []), b, d) for n, s, t, p, c, b, d in
         zip(names, sizes, targets, passes, cuts, blocks, dealt)], _PLAN
    )


def mix_sources(
    df: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: Sequence[float] = WEIGHTS,
    most: int = MOST_PASSES,
    shards: int = SHARDS,
    seed: int = SEED,
) -> DataFrame:
    """``df`` with ``size`` (words), ``source_size``, ``target`` (words) and ``draws``: one
    ``(shard, turn)`` for each time that the mix takes the document, at most ``most``.

    Sources in order of code points, null last, get the weights in turn and share the size of
    the whole table. Each misses its target by at most half of the smallest document that a last
    pass filled as far as documents fit would leave out. A null text has size 0; a source without
    words gets nothing. Rows equal in key and text are drawn together. An empty table gives an
    empty result. Columns of ``df`` called like the new ones are replaced, others kept whatever
    their names. The result depends on values and parameters alone, not on the layout.
    """
    new = ["size", "source_size", "target", "draws"]
    marked = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in new]).alias("row"),
        F.col(source).alias("source"), word_count(text).alias("size"),
        shuffled_place(seed, key, text).alias("_place"),
    )
    rows = write_once(marked.select("source", "size", F.col("_place").alias("place")), "sizes")
    # One row for each source, with about BLOCKS numbers in all.
    plan = F.broadcast(plan_mix(rows, weights, most, shards, seed))
    placed = marked.join(plan, F.col("source").eqNullSafe(F.col("_source")))
    block = _block_of("_place", "_blocks")
    inside = (F.col("_place") <= F.col("_end")).cast("int")
    extra = F.array_contains("_extras", F.col("_place")).cast("int")
    turns = F.col("_passes") + F.greatest(inside, extra)
    turns = F.when(F.col("source_size") > 0, F.least(turns, F.lit(most))).otherwise(0)
    number = F.when(
        (extra == 1) & (inside == 0), F.size("_shards") - 1
    ).otherwise(F.col("_passes") * F.col("_blocks") + block)
    draws = F.transform(
        F.when(turns > 0, F.sequence(F.lit(0), turns - 1)).otherwise(F.array().cast("array<int>")),
        lambda turn: F.struct(
            F.get("_shards", F.when(turn < F.col("_passes"), turn * F.col("_blocks") + block)
                  .otherwise(number)).alias("shard"),
            turn.alias("turn"),
        ),
    )
    drawn = placed.select("row", "size", "source_size", "target", draws.alias("draws"))
    return drawn.select("row.*", "size", "source_size", "target", "draws")


def _block_of(place: str, blocks: str):
    """The block of a place among ``blocks`` equal ranges of the order; the product of the
    upper 40 bits and a count below 2**23 fits into 63 bits."""
    return F.shiftright(F.shiftright(place, 23) * F.col(blocks), 40).cast("int")


def mixed_rows(mixed: DataFrame, key: str = "doc_id", seed: int = SEED) -> DataFrame:
    """The rows of the mix, each document as often as it was drawn, with ``shard``; rows of a
    shard lie together, in an order shuffled by key and turn."""
    own = [F.col(f"`{c}`") for c in mixed.columns if c not in ("draws", "shard")]
    drawn = mixed.select(F.struct(*own).alias("row"), F.col(key).alias("key"),
                         F.explode("draws").alias("draw"))
    drawn = drawn.select("row", "draw.shard", shuffled_place(seed + 1, "key", "draw.turn")
                         .alias("turn"))
    return drawn.repartitionByRange("shard", "turn").sortWithinPartitions(
        "shard", "turn"
    ).select("row.*", "shard")
