"""Parquet tables, literal tables and the labelled text set."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


FEW_SPLITS = 16


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def literal_table(
    spark: SparkSession, rows: Iterable[tuple], schema: StructType | str
) -> DataFrame:
    """A table of rows written down in the program, with an explicit schema."""
    return spark.createDataFrame(list(rows), schema)


def spread(scan: DataFrame) -> DataFrame:
    """Spread a table with few input splits over all cores, before work that is heavy per row.

    Files of one row group cannot be split by the scan. A table with at least ``FEW_SPLITS``
    splits, about 2 GB, is left alone and not shuffled, however many cores there are.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < FEW_SPLITS else scan


def text_set(spark: SparkSession, folder: str, heavy: bool = False) -> DataFrame:
    """Labelled texts ``(doc_id, text, label)``; ``doc_id`` is unique on both sides.

    ``heavy`` announces work on each text and spreads the documents for it.
    """
    documents = load(spark, folder, "documents").select("doc_id", "text")
    documents = spread(documents) if heavy else documents
    labels = load(spark, folder, "labels").select(
        "doc_id", F.col("toxic").cast("double").alias("label")
    )
    return documents.join(labels, "doc_id")
