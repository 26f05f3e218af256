"""Term counts, document frequencies and TF-IDF with exact terms instead of hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import write_once
from .attaching import attach_lookup


def term_frequency(docs: DataFrame, key: str, tokens: str = "tokens") -> DataFrame:
    """``(key, term, tf)``: how often each term occurs in each row.

    A row holds its whole text, so the count needs no shuffle: sort the tokens of the row,
    find where each run of equal tokens starts, and take the distance to the next start.
    """
    ordered = docs.select(key, F.sort_array(tokens).alias("_sorted"))
    starts = F.when(F.size("_sorted") == 0, F.array().cast("array<int>")).otherwise(
        F.filter(
            F.sequence(F.lit(1), F.size("_sorted")),
            lambda i: (i == 1) | (F.get("_sorted", i - 1) != F.get("_sorted", i - 2)),
        )
    )
    runs = ordered.select(key, "_sorted", starts.alias("_start"))
    closed = F.concat("_start", F.array(F.size("_sorted") + 1))
    ends = F.slice(closed, F.lit(2), F.size("_start"))
    counted = F.zip_with(
        "_start",
        ends,
        lambda start, end: F.struct(
            F.get("_sorted", start - 1).alias("term"), (end - start).cast("bigint").alias("tf")
        ),
    )
    return runs.select(key, F.inline(counted))


def document_frequency(docs: DataFrame, tokens: str = "tokens") -> DataFrame:
    """``(term, df)``: in how many rows each term occurs. Only sums per task are shuffled."""
    terms = docs.select(F.explode(F.array_distinct(tokens)).alias("term"))
    return terms.groupBy("term").agg(F.count("*").alias("df"))


def tf_idf(docs: DataFrame, key: str, tokens: str = "tokens") -> DataFrame:
    """``(key, term, tf, df, idf, tf_idf)`` with ``idf = ln((m + 1) / (df + 1))`` for ``m`` rows.

    Texts are tokenised once: the counts are written down, and the frequency pass and the
    final join read those.
    """
    counts = write_once(term_frequency(docs, key, tokens), "term-counts")
    frequencies = counts.groupBy("term").agg(F.count("*").alias("df"))
    frequencies = write_once(frequencies, "document-frequencies")
    weighed = attach_lookup(counts, frequencies, "term", "df", weight="df")
    idf = F.log((F.lit(docs.count()) + 1) / (F.col("df") + 1))
    return weighed.withColumn("idf", idf).withColumn("tf_idf", F.col("tf") * F.col("idf"))
