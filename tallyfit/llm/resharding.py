"""Resharding by minimum-cost flow: from old shard sizes and new capacities to block moves.

Sizes per shard are the only thing the solver sees. What a shard keeps, and the blocks it hands
over, are runs of its documents in order of falling size, so a run is described by its first
document and a run ends among the smallest documents that are moved at all. Every document then
finds its shard from a table with one row for each old shard.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.positions import with_earlier_totals, with_position
from .texts import shuffled_place

SHARDS = 40
OLD_SHARDS = 32
SEED = 11


def equal_fill(kept: Sequence[int], total: int) -> list[int]:
    """What each shard still gets so that sizes end as equal as their kept bytes allow."""
    order = np.argsort(kept, kind="stable")
    values = np.array(kept, dtype=object)[order]
    room = total - int(sum(values))
    want = [0] * len(values)
    if room <= 0:
        return want
    filled = 0
    for count in range(1, len(values) + 1):
        filled += int(values[count - 1])
        level, rest = divmod(room + filled, count)
        if count == len(values) or level <= values[count]:
            for place in range(count):
                want[int(order[place])] = level + (place < rest) - int(values[place])
            break
    return want


def cheapest_transfers(
    supply: Sequence[int], demand: Sequence[int], cost: Sequence[Sequence[float]] | None = None
) -> list[list[int]]:
    """``flow[i][j]``: units from source ``i`` to sink ``j`` that meet all demands at the
    lowest total cost, by successive shortest paths; supplies and demands add up equally.

    ``cost[i][j]`` is the cost of one unit, 1 everywhere if it is not given.
    """
    n, m = len(supply), len(demand)
    price = np.ones((n, m)) if cost is None else np.array(cost, float).reshape(n, m)
    flow = np.zeros((n, m), dtype=object)
    left, need = [int(x) for x in supply], [int(x) for x in demand]
    while any(left) and any(need):
        # Distances from sources with supply; a used edge can be walked back at minus its cost.
        at_source = np.where(np.array(left, dtype=object) > 0, 0.0, np.inf).astype(float)
        at_sink = np.full(m, np.inf)
        from_source, from_sink = np.full(m, -1), np.full(n, -1)
        for _ in range(n + m):
            through = at_source[:, None] + price
            best = through.argmin(0)
            reached = through[best, np.arange(m)]
            better = reached < at_sink - 1e-12
            at_sink[better], from_source[better] = reached[better], best[better]
            back = np.where(flow.T > 0, at_sink[:, None] - price.T, np.inf)
            best = back.argmin(0)
            reached = back[best, np.arange(n)]
            returned = reached < at_source - 1e-12
            at_source[returned], from_sink[returned] = reached[returned], best[returned]
            if not better.any() and not returned.any():
                break
        end = min((j for j in range(m) if need[j]), key=lambda j: at_sink[j])
        path, j = [], end
        while True:
            i = int(from_source[j])
            path.append((i, j, 1))
            if from_sink[i] < 0:
                break
            j = int(from_sink[i])
            path.append((i, j, -1))
        amount = min([left[i], need[end], *[flow[a, b] for a, b, sign in path if sign < 0]])
        for a, b, sign in path:
            flow[a, b] += sign * amount
        left[i] -= amount
        need[end] -= amount
    return flow.tolist()


def plan_moves(
    rows: DataFrame, shards: int, cost: Sequence[Sequence[float]] | None = None
) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """For rows ``(old, size, place)`` the runs that each old shard splits into, as
    ``(old, [(minus size, place, shard), ...])``: a run starts at the named document, in order
    of falling size and rising place, and goes to ``shard``.

    Rows with equal size and place are one: they stay or move together, on the side of a cut on
    which their middle lies. The flow runs from all bytes of each old shard to equal capacities;
    an arc back to the same shard is free, so what flows along it stays, starting with the
    largest documents. Whole documents end a little beside that amount, so what is left over is
    solved once more against the capacities that are left. Numbers on the driver follow the
    shard counts, not the documents.
    """
    rows = rows.groupBy("old", (-F.col("size")).alias("minus"), "place").agg(
        F.sum("size").alias("size"))
    sizes = {r[0]: int(r[1]) for r in rows.groupBy("old").agg(F.sum("size")).collect()}
    if not sizes:
        return []
    total = sum(sizes.values())
    old = sorted(sizes)
    base, so_far = {}, 0
    for shard in old:
        base[shard] = so_far
        so_far += sizes[shard]
    placed = with_earlier_totals(rows, ["old", "minus", "place"], {"before": "size"})
    start = F.create_map(*[F.lit(x) for pair in base.items() for x in pair])
    twice = 2 * (F.col("before") - start[F.col("old")]) + F.col("size")  # its middle, doubled
    price = [[0.0 if i == j else 1.0 if cost is None else float(cost[i][j])
              for j in range(shards)] for i in old]
    full = cheapest_transfers([sizes[i] for i in old], equal_fill([0] * shards, total), price)
    keeps = [F.lit(x) for n, i in enumerate(old) if i < shards for x in (i, int(full[n][i]))]
    stays = F.lit(False)
    if keeps:
        stays = (F.col("old") < shards) & (twice <= 2 * F.create_map(*keeps)[F.col("old")])
    kept = {r[0]: int(r[1] or 0) for r in placed.where(stays).groupBy("old").agg(
        F.sum("size")).collect()}
    want = equal_fill([kept.get(j, 0) for j in range(shards)], total)
    rest = [sizes[i] - kept.get(i, 0) for i in old]
    flow = cheapest_transfers(rest, want, price)
    run = F.when(stays, -1)
    targets = {}
    for i, shard in enumerate(old):
        upto = kept.get(shard, 0)
        for j in range(shards):
            if flow[i][j]:
                targets[shard, len(targets)] = j
                upto += flow[i][j]
                run = run.when(
                    (F.col("old") == shard) & (twice <= 2 * upto), len(targets) - 1
                )
    last = {shard: n for shard, n in targets}
    # The last document of a shard may have its middle beyond the last boundary by rounding.
    for shard, n in last.items():
        run = run.when(F.col("old") == shard, n)
    firsts = placed.groupBy("old", run.otherwise(-1).alias("run")).agg(
        F.min(F.struct("minus", "place")).alias("first")
    ).collect()
    runs: dict[int, list[tuple[int, int, int]]] = {}
    for shard, number, first in firsts:
        to = targets.get((shard, number), min(shard, shards - 1))
        runs.setdefault(shard, []).append((first["minus"], first["place"], to))
    return [(shard, sorted(runs[shard])) for shard in sorted(runs)]


def reshard(
    df: DataFrame,
    key: str,
    size: str,
    old_shard: str,
    text: str = "text",
    shards: int = SHARDS,
    cost: Sequence[Sequence[float]] | None = None,
) -> DataFrame:
    """``df`` with ``shard`` and ``slot``: the new shard of each row, and its place there from
    0 without gaps. Sizes of new shards are as equal as whole documents allow, and the fewest
    bytes leave their old shard (or the cheapest ones under ``cost[old][new]``).

    ``old_shard`` holds integers from 0; shards from ``shards`` on are emptied. A null size
    counts as 0 and a null old shard as 0. A document larger than a shard's share stays whole.
    Rows with equal ``text`` and size that are in one old shard move together, so equal texts
    stay together if they were; without a column of that name, rows with equal keys do. An empty
    table gives an empty result. Columns of ``df`` that are called ``shard`` or ``slot`` are
    replaced; other names are kept, whatever they are. The order of slots depends on the key and
    the text alone.
    """
    by = [text] if text in df.columns else [key]
    own = [c for c in df.columns if c not in ("shard", "slot")]
    marked = df.select(
        F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"),
        F.coalesce(F.col(old_shard).cast("int"), F.lit(0)).alias("old"),
        F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("size"),
        shuffled_place(SEED, *by).alias("place"),
        shuffled_place(SEED, key, *by).alias("inside"),
    )
    runs = plan_moves(marked.select("old", "size", "place"), shards, cost)
    table = df.sparkSession.createDataFrame(
        runs, "old int, runs array<struct<minus: long, place: long, shard: int>>"
    )
    at = F.struct((-F.col("size")).alias("minus"), F.col("place").alias("place"))
    begun = F.filter("runs", lambda r: F.struct(r["minus"], r["place"]) <= at)
    # One row for each old shard, so the table is broadcast whatever the documents are.
    placed = marked.join(F.broadcast(table), "old").select(
        "row", F.element_at(begun, -1)["shard"].alias("shard"), "place", "inside")
    counts = {r[0]: r[1] for r in placed.groupBy("shard").count().collect()}
    first, so_far = [F.lit(-1), F.lit(0).cast("long")], 0
    for shard in sorted(counts):
        first += [F.lit(shard), F.lit(so_far).cast("long")]
        so_far += counts[shard]
    placed = with_position(placed, ["shard", "place", "inside"], "position")
    slot = F.col("position") - F.create_map(*first)[F.col("shard")]
    return placed.select("row", "shard", slot.alias("slot")).select("row.*", "shard", "slot")


def rewrite_affected(
    rows: DataFrame, folder: str, old_shard: str, files_per_shard: int = 1
) -> list[int]:
    """Write the shards that gain or lose rows under ``folder`` as ``shard=N``, in slot order,
    and return their numbers; files of all other shards can stay as they are."""
    changed = rows.where(~F.col(old_shard).eqNullSafe(F.col("shard")))
    ends = changed.select(F.explode(F.array("shard", F.col(old_shard).cast("int"))).alias("s"))
    affected = sorted(r[0] for r in ends.where("s IS NOT NULL").distinct().collect())
    if affected:
        kept = rows.where(F.col("shard").isin(affected)).drop(old_shard)
        kept.repartitionByRange(
            max(1, len(affected) * files_per_shard), "shard", "slot"
        ).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
    return affected
