"""The registered queries of this subpackage, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import load
from ..sources.scratch import write_once
from .centroid_clusters import cluster_vectors
from .decontamination import find_leaks
from .interpolated_lm import score_documents
from .merkle_manifest import audited
from .page_text import extract_main_text
from .personal_data import BASE, find_personal_data, written
from .quality_model import fit_quality, score_quality
from .repeated_bytes import repeated_bytes
from .resharding import OLD_SHARDS, reshard
from .simhash_links import simhash_components
from .source_mixing import mix_sources
from .texts import whole
from .token_counts import count_tokens
from .vector_links import cosine_links

TOKENIZER = "byte_bpe_50k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function ``(spark, folder) -> DataFrame``, with equivalent SQL if any."""

    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


@query("op4_cap_filter_links")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    found = cosine_links(load(spark, folder, "embeddings"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return found.withColumn("kept", kept)


@query("op7_simhash_trie")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_components(load(spark, folder, "documents"))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query("op1_min_cost_reshard")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    text = whole("text")
    rows = load(spark, folder, "documents").select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64("text"), F.lit(OLD_SHARDS)).cast("int").alias("old_shard"),
    )
    found = reshard(write_once(rows, "sizes"), "doc_id", "size", "old_shard", text="text_crc32")
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "old_shard",
    )


@query("op8_hypergeometric_mix")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mix_sources(load(spark, folder, "documents"))
    taken = F.size("draws") * F.col("size")
    return mixed.select(
        "doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"),
        F.col("draws.shard").alias("shards"),
    )


@query("op6_rank_synchronous_tokens")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    content = Path(public_tokenizers.path(TOKENIZER)).read_text(encoding="utf-8")
    return count_tokens(load(spark, folder, "documents"), content)


@query("op9_nearest_url_difference")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return extract_main_text(load(spark, folder, "pages"))


@query("op10_random_indexing_quality")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    documents = load(spark, folder, "documents")
    model = fit_quality(documents, load(spark, folder, "labels"))
    return score_quality(documents, model)


@query("op5_deleted_interpolation")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return score_documents(load(spark, folder, "documents"))


@query("op3_spaced_seed_leaks")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return find_leaks(load(spark, folder, "documents"), load(spark, folder, "benchmark"))


@query("op2_boosted_candidates")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    found = find_personal_data(load(spark, folder, "documents"))

    def count(kind: str, spans: str = "base"):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.concat("base", "added")).alias("spans"),
        (F.size("base") + F.size("added")).cast("long").alias("n_spans"),
        *[count(kind, "added").alias(f"n_added_{kind}") for kind in ("card", "phone", "secret")],
    )


@query("op11_veb_merkle_manifest")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return audited(load(spark, folder, "documents"))


@query("op13_incremental_centroids")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return cluster_vectors(load(spark, folder, "embeddings"))


@query("op12_deep_shallow_repeats")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    found = repeated_bytes(load(spark, folder, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), "kept_sha256",
    )
