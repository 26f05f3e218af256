"""Benchmark decontamination: spaced seeds that ignore some token positions.

A seed is a fixed mask over a window of tokens. Test and training windows are hashed at the
positions that the mask selects, so a window with other words at the ignored positions still
meets its counterpart. Around every meeting the tokens themselves are compared, and enough of
them must agree. Everything runs as DataFrame expressions; documents are scanned, not shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import write_once

# Positions that each seed compares. Any two other tokens in a window of eleven
# leave a match of one of the first three somewhere in a stretch of eighteen tokens.
SEEDS = ("11011011011", "11101000111", "10111110101")
SHORT_SEED = "11111111"
SPAN = 11
SHORT_SPAN = 8
AROUND = 8  # tokens that are compared on either side of a window
SHARE = 0.8  # of the compared tokens that must agree
WINDOWS = 20_000  # of the benchmark, that are broadcast with their tokens
MARK_BITS = 27  # a bitmap of 2 to this power marks the keys of a larger benchmark
MARKED = 1 << 23  # windows that are marked in one bitmap
SEPARATOR = r"[^\p{L}\p{N}]+"


def token_hashes(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits of a text."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATOR), lambda w: w != "")
    return F.transform(words, lambda word: F.xxhash64(word))


def _key(seed: int, mask: str, hashes: Column, at: Column) -> Column:
    picked = [F.get(hashes, at + n) for n, bit in enumerate(mask) if bit == "1"]
    return F.xxhash64(F.lit(seed), *picked)


def benchmark_windows(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """``(key, item, lead, zone)``: a row for each window of each item and seed. The zone holds
    the tokens to compare, ``lead`` of which stand before the window."""
    items = benchmark.select(F.col(item).alias("item"), token_hashes(F.col(text)).alias("own"))
    parts = []
    for seed, mask in enumerate([*SEEDS, SHORT_SEED]):
        size = F.size("own")
        fits = size >= SPAN if len(mask) == SPAN else (size >= SHORT_SPAN) & (size < SPAN)
        placed = items.where(fits).select(
            "item", "own", F.explode(F.sequence(F.lit(0), size - len(mask))).alias("at")
        )
        lead = F.least(F.col("at"), F.lit(AROUND))
        zone = F.slice("own", F.col("at") - lead + 1, lead + len(mask) + AROUND)
        parts.append(placed.select(
            _key(seed, mask, F.col("own"), F.col("at")).alias("key"), "item",
            lead.alias("lead"), zone.alias("zone"), F.lit(len(mask) == SPAN).alias("full"),
        ))
    return reduce(DataFrame.unionByName, parts)


def _meetings(hashed: DataFrame, windows: DataFrame, total: int) -> list[DataFrame]:
    """Document windows beside the benchmark windows with the same key, each meeting once."""
    if total <= WINDOWS:
        return [hashed.join(F.broadcast(windows), "key")]
    place = F.pmod(F.col("key"), F.lit(1 << MARK_BITS))
    word, bit = F.shiftright(place, 6), F.pmod(place, F.lit(64)).cast("int")
    chunks = -(-total // MARKED)
    met = []
    for chunk in range(chunks):
        part = windows.where(F.pmod(F.xxhash64("key"), F.lit(chunks)) == chunk)
        # One row for each 64 bits at most, whatever the benchmark is.
        marks = part.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(
            F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
        marked = hashed.withColumn("word", word).join(F.broadcast(marks), "word").where(
            F.getbit("bits", bit) == 1)
        met.append(marked.drop("word", "bits").join(part, "key"))
    return met


def find_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    share: float = SHARE,
) -> DataFrame:
    """``(key, item, n_windows, n_equal, similarity)``, a row for each document and item of
    which the document holds a passage: how many windows met and agreed, and the most equal
    tokens and the highest share of equal ones around any of them.

    Letters and digits count, their case and what stands between them does not. Items of fewer
    than 8 tokens cannot leak; of fewer than 11 they need 8 equal tokens in a row and four in
    five of the whole. Null and empty texts hold nothing. Documents without a leak have no row;
    rows that repeat a key are one document; a null key or item is a value like any other.
    Other columns are not read and empty tables give an empty result.

    A benchmark of up to ``WINDOWS`` windows is broadcast. A larger one is met by a shuffle join
    of the document windows that a bitmap of its keys lets through, with one scan of the documents
    for each ``MARKED`` windows; its size is not limited and no hit is lost.
    """
    windows = write_once(benchmark_windows(benchmark, item, text), "windows")
    total, short = windows.agg(F.count("*"), F.count(F.when(~F.col("full"), 1))).first()
    seeds = list(SEEDS) + ([SHORT_SEED] if short else [])
    span = SHORT_SPAN if short else SPAN
    rows = documents.select(
        F.col(key).alias("_key"), token_hashes(F.col(text)).alias("own")
    )
    last = F.size("own") - span
    starts = F.when(last >= 0, F.sequence(F.lit(0), last))
    placed = rows.select("_key", "own", F.explode(starts).alias("at"))
    keys = [_key(n, mask, F.col("own"), F.col("at")) for n, mask in enumerate(seeds)]
    hashed = placed.select("_key", "own", "at", F.stack(F.lit(len(keys)), *keys).alias("key"))
    # Only the tokens around a window go on; they are cut out where a window meets.
    before = F.least(F.col("at"), F.lit(AROUND))
    near = F.slice("own", F.col("at") - before + 1, before + SPAN + AROUND)
    hashed = hashed.select("_key", "key", before.alias("before"), near.alias("near"))
    found = []
    for met in _meetings(hashed, windows, total):
        shift = F.col("before") - F.col("lead")
        equal = F.size(F.filter(
            F.arrays_zip("zone", F.sequence(F.lit(0), F.size("zone") - 1).alias("n")),
            lambda pair: F.coalesce(
                F.get("near", shift + pair["n"]) == pair["zone"], F.lit(False)
            ),
        ))
        figures = met.select("_key", "item", equal.alias("equal"), F.size("zone").alias("size"))
        # Windows that do not agree are told apart in the aggregate: as a filter the comparison
        # would move into the join, out of compiled code, and see every window.
        agreed = F.when(F.col("equal") >= share * F.col("size"), F.col("equal"))
        found.append(figures.groupBy("_key", "item").agg(
            F.count(agreed).alias("n_windows"), F.max(agreed).alias("n_equal"),
            F.max(agreed / F.col("size")).alias("similarity"),
        ))
    best = reduce(DataFrame.unionByName, found).groupBy("_key", "item").agg(
        F.sum("n_windows").alias("n_windows"), F.max("n_equal").alias("n_equal"),
        F.max("similarity").alias("similarity"),
    )
    return best.where("n_windows > 0").select(
        F.col("_key").alias(key), F.col("item").alias(item), "n_windows",
        F.col("n_equal").cast("long").alias("n_equal"), "similarity",
    )


def without_leaks(
    documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The documents that hold no passage of the benchmark, with all their columns."""
    marked = documents.withColumn("_mark", F.xxhash64(key, text))
    leaks = write_once(
        find_leaks(marked, benchmark, "_mark", text).select("_mark").distinct(), "leaks"
    )
    return marked.join(leaks, "_mark", "left_anti").drop("_mark")
