"""Text functions and term features over the whole text of every document."""

from __future__ import annotations

from pyspark.ml.feature import HashingTF, StopWordsRemover
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import REMOVED_CHARACTERS, TEXT_FEATURES
from ..functions import register_text_udf, remove_characters, stop_words, with_tokens
from ..operators import document_frequency, term_frequency, tf_idf
from ..sources import load, spread
from .registry import query

_BLANK = r"[ \t\n\x0B\f\r]"
_TRIMMED = rf"regexp_replace(lower(text), '{_BLANK}+$', '')"
TOKENS_SQL = rf"""CASE WHEN {_TRIMMED} = '' AND text <> '' THEN []
                    ELSE string_split_regex({_TRIMMED}, '{_BLANK}') END"""
_TERMS = f"""WITH words AS (SELECT doc_id, unnest({TOKENS_SQL}) AS term FROM documents),
                  tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
                  freq AS (SELECT term, count(*) AS df FROM tf GROUP BY term)"""


def _stop_words_in_sql() -> str:
    words = [word.lower() for word in stop_words()]
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def token_rows(spark: SparkSession, folder: str) -> DataFrame:
    documents = spread(load(spark, folder, "documents").select("doc_id", "text"))
    return with_tokens(documents).select("doc_id", "tokens")


@query(
    "clean_text",
    f"SELECT doc_id, regexp_replace(text, '{REMOVED_CHARACTERS}', '', 'g') AS text FROM documents",
)
def clean_text(spark: SparkSession, folder: str) -> DataFrame:
    documents = load(spark, folder, "documents")
    return documents.select("doc_id", remove_characters("text").alias("text"))


@query(
    "udf_clean_text",
    f"SELECT doc_id, regexp_replace(text, '{REMOVED_CHARACTERS}', '', 'g') AS text FROM documents",
)
def udf_clean_text(spark: SparkSession, folder: str) -> DataFrame:
    clean = register_text_udf(
        spark, "remove_marks", lambda texts: texts.str.replace(REMOVED_CHARACTERS, "", regex=True)
    )
    documents = spread(load(spark, folder, "documents").select("doc_id", "text"))
    return documents.select("doc_id", clean("text").alias("text"))


@query(
    "tokenize",
    f"""SELECT doc_id, len(tokens) AS n_tokens, array_to_string(tokens, ' ') AS words
        FROM (SELECT doc_id, {TOKENS_SQL} AS tokens FROM documents)""",
)
def tokenize(spark: SparkSession, folder: str) -> DataFrame:
    return token_rows(spark, folder).select(
        "doc_id",
        F.size("tokens").cast("bigint").alias("n_tokens"),
        F.array_join("tokens", " ").alias("words"),
    )


@query(
    "remove_stopwords",
    f"""SELECT doc_id, len(words) AS n_tokens, array_to_string(words, ' ') AS words
        FROM (SELECT doc_id, [x FOR x IN {TOKENS_SQL} IF x NOT IN ({_stop_words_in_sql()})] AS words
              FROM documents)""",
)
def remove_stopwords(spark: SparkSession, folder: str) -> DataFrame:
    remover = StopWordsRemover(inputCol="tokens", outputCol="words", stopWords=stop_words())
    return remover.transform(token_rows(spark, folder)).select(
        "doc_id",
        F.size("words").cast("bigint").alias("n_tokens"),
        F.array_join("words", " ").alias("words"),
    )


@query(
    "hashing_tf",
    f"SELECT doc_id, len({TOKENS_SQL})::double AS occurrences FROM documents",
)
def hashing_tf(spark: SparkSession, folder: str) -> DataFrame:
    hashing = HashingTF(inputCol="tokens", outputCol="rawFeatures", numFeatures=TEXT_FEATURES)
    hashed = hashing.transform(token_rows(spark, folder))
    counts = hashed.select("doc_id", F.unwrap_udt("rawFeatures").alias("v"))
    total = F.aggregate("v.values", F.lit(0.0), lambda total, count: total + count)
    return counts.select("doc_id", total.alias("occurrences"))


@query("term_frequency", f"{_TERMS} SELECT doc_id, term, tf FROM tf")
def count_terms(spark: SparkSession, folder: str) -> DataFrame:
    return term_frequency(token_rows(spark, folder), "doc_id")


@query("document_frequency", f"{_TERMS} SELECT term, df FROM freq")
def count_documents(spark: SparkSession, folder: str) -> DataFrame:
    return document_frequency(token_rows(spark, folder))


@query(
    "tf_idf",
    f"""{_TERMS}
        SELECT doc_id, term, tf, df, round(ln((m + 1) / (df + 1)), 6) AS idf,
               round(tf * ln((m + 1) / (df + 1)), 6) AS tf_idf
        FROM tf JOIN freq USING (term), (SELECT count(*) AS m FROM documents)""",
)
def weigh_terms(spark: SparkSession, folder: str) -> DataFrame:
    weighed = tf_idf(token_rows(spark, folder), "doc_id")
    return weighed.select(
        "doc_id", "term", "tf", "df",
        F.round("idf", 6).alias("idf"), F.round("tf_idf", 6).alias("tf_idf"),
    )
