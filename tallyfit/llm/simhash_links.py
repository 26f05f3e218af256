"""SimHash near copies: fingerprints of word shingles, joined by walking a binary trie.

Fingerprints are computed where the texts are read. Equal ones are one node of the join, so
copies are never paired. The join walks pairs of trie nodes together, adds up the bits in which
their paths differ and gives up a pair as soon as the budget is exceeded. Two fingerprints
within the budget differ in few bits of at least one of several bit ranges, so the trie is
walked once with each range in front, with the small budget that holds inside it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import write_once
from .graphs import components, smallest_labels

SHINGLE = 4
MAX_BITS = 4
SEED = 42
BLOCK = 512  # fingerprints that one side of a trie walk holds at most
LEAF = 16  # a pair of trie nodes with so few pairs below it is compared directly
CHUNK = 1 << 15  # shingle hashes whose bits are unpacked at once


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text as a signed number; 0 for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        after = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], after[:-shingle]]).tolist()
        ends = (after[shingle - 1:] - 1).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts, ends)]
    values = np.array(hashes, dtype="<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(values), CHUNK):
        part = values[at:at + CHUNK].view(np.uint8)
        ones += np.unpackbits(part, bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    set_bits = 2 * ones > len(values)
    return int(np.packbits(set_bits, bitorder="little").view("<i8")[0])


def with_fingerprint(
    df: DataFrame, text: str = "text", name: str = "fingerprint", shingle: int = SHINGLE
) -> DataFrame:
    """Add the fingerprint of ``text``: A-Z in lower case, words between ASCII white space,
    shingles of ``shingle`` words with repeats, or the whole sequence if it is shorter."""

    @F.pandas_udf("long")
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return df.withColumn(name, hashed(F.col(text)))


def _ranges(max_bits: int) -> list[tuple[int, int]]:
    """Bit ranges ``(offset, width)`` of which one holds at most one differing bit."""
    count = max_bits // 2 + 1
    edges = [round(i * 64 / count) for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _rotated(values: np.ndarray, by: int) -> np.ndarray:
    by %= 64
    if not by:
        return values
    return (values << np.uint64(by)) | (values >> np.uint64(64 - by))


def trie_pairs(
    a: np.ndarray, b: np.ndarray, same: bool, depth: int, width: int, max_bits: int
) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all pairs of the sorted fingerprints ``a`` and ``b`` within the budget.

    All of ``a`` share their first ``depth`` bits, and so do all of ``b``. Up to bit ``width``
    at most one bit may differ. ``same`` says that ``a`` is ``b``: each pair comes once.
    """
    first = min(1, max_bits)
    error = int(np.bitwise_count((a[0] ^ b[0]) >> np.uint64(64 - depth))) if depth else 0
    walk = np.array([[0], [len(a)], [0], [len(b)], [error]], np.int64)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for bit in range(depth, 65):
        pairs = (walk[1] - walk[0]) * (walk[3] - walk[2])
        leaf = pairs <= LEAF if bit < 64 else pairs > 0
        if leaf.any():
            low_a, _, low_b, high_b, _ = walk[:, leaf]
            n, wide = pairs[leaf], high_b - low_b
            which = np.repeat(np.arange(len(n)), n)
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            i, j = low_a[which] + place // wide[which], low_b[which] + place % wide[which]
            near = np.bitwise_count(a[i] ^ b[j]) <= max_bits
            if same:
                near &= i < j
            found.append((i[near], j[near]))
            walk = walk[:, ~leaf]
        if not walk.shape[1]:
            break
        mask = np.uint64(1 << (63 - bit))
        zeros_a = np.concatenate([[0], np.cumsum((a & mask) == 0)])
        zeros_b = zeros_a if same else np.concatenate([[0], np.cumsum((b & mask) == 0)])
        low_a, high_a, low_b, high_b, error = walk
        mid_a = low_a + zeros_a[high_a] - zeros_a[low_a]
        mid_b = low_b + zeros_b[high_b] - zeros_b[low_b]
        own = (low_a == low_b) & (high_a == high_b) & same
        cross = [np.array([mid_a, high_a, low_b, mid_b, error + 1])[:, ~own],
                 np.array([low_a, mid_a, mid_b, high_b, error + 1])]
        walk = np.concatenate([np.array([low_a, mid_a, low_b, mid_b, error]),
                               np.array([mid_a, high_a, mid_b, high_b, error]), *cross], axis=1)
        budget = first if bit < width else max_bits
        walk = walk[:, (walk[0] < walk[1]) & (walk[2] < walk[3]) & (walk[4] <= budget)]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _pack(depth: int):
    """Consecutive sorted fingerprints of one trie node as blocks of bounded size."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            turn = batch["turn"].to_numpy()
            values = batch["value"].to_numpy(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
            node = values >> np.uint64(64 - depth) if depth else values * np.uint64(0)
            cut = np.flatnonzero((np.diff(turn) != 0) | (np.diff(node) != 0)) + 1
            edges = np.concatenate([[0], cut, [len(values)]])
            rows = [(int(turn[at]), int(node[at]), values[at:min(at + BLOCK, end)].tobytes())
                    for start, end in zip(edges, edges[1:]) for at in range(start, end, BLOCK)]
            yield pd.DataFrame(rows, columns=["turn", "node", "block"])

    return pack


def _walk(depth: int, ranges: list[tuple[int, int]], max_bits: int):
    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            left, right = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
            for turn, x, y in zip(batch["turn"], batch["block"], batch["other"]):
                same = x == y
                a = np.frombuffer(x, np.uint64)
                b = a if same else np.frombuffer(y, np.uint64)
                offset, width = ranges[turn]
                i, j = trie_pairs(a, b, same, depth, width, max_bits)
                if not len(i):
                    continue
                both = a if same else np.concatenate([a, b])
                labels = smallest_labels(len(both), i, j if same else j + len(a))
                moved = np.flatnonzero(labels != np.arange(len(both)))
                back = _rotated(both, 64 - offset)
                left.append(back[moved])
                right.append(back[labels[moved]])
            yield pd.DataFrame({"a": np.concatenate(left).view(np.int64),
                                "b": np.concatenate(right).view(np.int64)})

    return walk


def hamming_links(fingerprints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links ``(a, b)`` that connect whatever is connected by pairs of the distinct
    ``fingerprint`` values at most ``max_bits`` apart.

    Each walk of two blocks returns a spanning forest of its pairs, not the pairs, so that a
    group of near copies gives a number of links in proportion to its size. Blocks hold at most
    ``BLOCK`` values wherever many fingerprints share a trie node.
    """
    ranges = _ranges(max_bits)
    count = fingerprints.count()
    depth = min(int(np.ceil(np.log2(max(1, count / BLOCK)))), *(w for _, w in ranges))
    value = F.col("fingerprint")
    turns = [
        F.struct(
            F.lit(turn).alias("turn"),
            (value if not offset else F.shiftleft(value, offset).bitwiseOR(
                F.shiftrightunsigned(value, 64 - offset)
            )).bitwiseXOR(F.lit(-(1 << 63))).alias("value"),
        )
        for turn, (offset, _) in enumerate(ranges)
    ]
    turned = fingerprints.select(F.explode(F.array(*turns)).alias("t")).select("t.*")
    placed = turned.repartitionByRange("turn", "value").sortWithinPartitions("turn", "value")
    blocks = write_once(
        placed.mapInPandas(_pack(depth), "turn int, node long, block binary"), "blocks"
    )
    near = [F.col("node"), *[F.col("node").bitwiseXOR(F.lit(1 << i)) for i in range(depth)]]
    reach = F.explode(F.array(*near) if max_bits else F.array(F.col("node")))
    left = blocks.select("turn", F.col("node").alias("from"), "block", reach.alias("node"))
    right = blocks.select("turn", "node", F.col("block").alias("other"))
    pairs = left.where("from <= node").join(right, ["turn", "node"])
    pairs = pairs.where("from < node OR block <= other").select("turn", "block", "other")
    return pairs.mapInPandas(_walk(depth, ranges, max_bits), "a long, b long")


def simhash_components(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """``(key, fingerprint, component_id)`` for every row: its fingerprint as a signed 64-bit
    number and the smallest key that links of at most ``max_bits`` bits reach.

    Null and empty texts, and texts without words, have fingerprint 0 and are linked like any
    other. Rows that repeat a key or a text each get their row. A null key names no component
    unless its group has no other. Other columns of ``df``, whatever their names, are not read.
    An empty table gives an empty result.
    """
    narrow = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    marked = write_once(
        with_fingerprint(narrow, "_text", shingle=shingle).select("_key", "fingerprint"),
        "fingerprints",
    )
    return marked.withColumnRenamed("_key", key).join(
        fingerprint_components(marked, max_bits), "fingerprint"
    ).select(key, "fingerprint", "component_id")


def fingerprint_components(marked: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(fingerprint, component_id)`` for the distinct fingerprints of ``(_key, fingerprint)``;
    ``component_id`` is the smallest ``_key`` of the component."""
    nodes = write_once(marked.groupBy("fingerprint").agg(F.min("_key").alias("first")), "nodes")
    found = write_once(components(hamming_links(nodes.select("fingerprint"), max_bits)), "found")
    placed = nodes.join(
        found.withColumnRenamed("node", "fingerprint"), "fingerprint", "left"
    ).select("fingerprint", "first", F.coalesce("component", "fingerprint").alias("component"))
    smallest = write_once(
        placed.groupBy("component").agg(F.min("first").alias("component_id")), "smallest"
    )
    # A written table on either side lets the skew join split a very large component.
    return write_once(
        placed.join(smallest, "component").select("fingerprint", "component_id"), "components"
    )


def near_copy_survivors(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """The one row of each component that has its smallest key, with all columns of ``df``.

    A null key comes after all others; of rows with equal keys the one whose text has the
    smaller hash stays, and of rows equal in key and text any one. Texts are shuffled once.
    """
    marked = df.withColumn("_mark", F.xxhash64(key, text))
    narrow = write_once(
        with_fingerprint(marked, text, "_print", shingle).select(
            F.col(key).alias("_key"), "_mark", F.col("_print").alias("fingerprint")
        ),
        "fingerprints",
    )
    # Components are named after keys elsewhere; here every row needs a name of its own.
    named = narrow.select(F.col("_mark").alias("_key"), "fingerprint")
    rank = F.struct(F.col("_key").isNull(), F.col("_key"), F.col("_mark"))
    placed = narrow.join(fingerprint_components(named, max_bits), "fingerprint")
    first = placed.groupBy("component_id").agg(F.min(rank).alias("first"))
    stays = write_once(first.select(F.col("first._mark").alias("_mark")), "stays")
    return marked.join(stays, "_mark", "left_semi").dropDuplicates(["_mark"]).drop("_mark")
