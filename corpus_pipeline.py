"""A training corpus from raw documents: quality, near copies, benchmark passages, mix, shards.

Each stage takes the documents that the one before kept, in a table written in between.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfit.llm.decontamination import without_leaks
from tallyfit.llm.quality_model import fit_quality, keep_quality
from tallyfit.llm.resharding import OLD_SHARDS, reshard
from tallyfit.llm.simhash_links import near_copy_survivors
from tallyfit.llm.source_mixing import mix_sources, mixed_rows
from tallyfit.sources import load
from tallyfit.sources.scratch import write_once


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return keep_quality(docs, fit_quality(docs, load(spark, sf_dir, "labels")))


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near copies, the one with the smallest id."""
    return near_copy_survivors(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return without_leaks(docs, load(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix draws them, the rows of an output shard together."""
    whole = docs.select("doc_id", "source", "text", F.struct("*").alias("document"))
    return mixed_rows(mix_sources(whole)).select("document.*")


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot; shards are of equal size and few bytes move."""
    sized = docs.select(
        F.struct("*").alias("document"), "doc_id", F.xxhash64("text").alias("mark"),
        (F.octet_length(F.coalesce("text", F.lit(""))) + 16).cast("long").alias("size"),
        F.pmod(F.xxhash64("text"), F.lit(OLD_SHARDS)).cast("int").alias("old_shard"),
    )
    placed = reshard(sized, "doc_id", "size", "old_shard", text="mark")
    kept = [F.col(f"document.`{c}`").alias(c) for c in docs.columns if c not in ("shard", "slot")]
    added = [c for c in ("size", "old_shard") if c not in docs.columns]
    return placed.select(*kept, *added, "shard", "slot")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("near_copies", near_copies_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

# A fitted network and a trie join have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each result but the last written once."""
    docs = load(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES, start=1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = write_once(docs, name)
    return docs
