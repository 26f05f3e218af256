"""Text expressions and term features."""

from collections import Counter
from math import log

import pytest
from pyspark.ml.feature import IDF, HashingTF, StopWordsRemover
from pyspark.sql import functions as F

from tallyfit import limits
from tallyfit.functions import register_text_udf, remove_characters, stop_words, with_tokens
from tallyfit.operators import document_frequency, term_frequency, tf_idf, vector_positions
from tallyfit.sources import literal_table

TEXTS = ["", "   ", " A  b\tC ", "x", "x\n", "\nx", "a b a", "Één twee één ", "tab\x0bfeed\fend",
         "the The THE cat", "What? No, stop. ok"]


@pytest.fixture
def texts(spark):
    return literal_table(spark, list(enumerate(TEXTS)), "id int, text string")


def test_tokens_of_blanks_and_missing_text(spark):
    rows = [("", [""]), (None, [""]), ("   ", []), (" A  b\tC ", ["", "a", "", "b", "c"]),
            ("x\n", ["x"]), ("\nx", ["", "x"]), ("tab\x0bfeed\fend", ["tab", "feed", "end"])]
    df = literal_table(spark, rows, "text string, expected array<string>")
    for row in with_tokens(df).collect():
        assert row.tokens == row.expected


def test_remove_characters(texts):
    clean = texts.where("id = 10").select(remove_characters("text").alias("t")).first().t
    assert clean == "What No stop ok"


def test_text_udf_by_name_and_with_nulls(spark):
    double = register_text_udf(spark, "twice", lambda texts: texts + texts)
    df = literal_table(spark, [("ab",), (None,)], "t string")
    assert [r[0] for r in df.select(double("t")).collect()] == ["abab", None]
    assert [r[0] for r in df.selectExpr("twice(t)").collect()] == ["abab", None]


def test_stop_words_are_trimmed_and_found_in_any_case(spark, texts):
    words = stop_words()
    assert words[0] == "one" and "the" in words and len(words) > 180
    remover = StopWordsRemover(inputCol="tokens", outputCol="words", stopWords=words)
    df = texts.select("id", F.split("text", " ").alias("tokens"))
    kept = {r.id: r.words for r in remover.transform(df).collect()}
    assert kept[9] == ["cat"]
    po = literal_table(spark, [(["po", "PO", "One", "ones"],)], "tokens array<string>")
    assert remover.transform(po).first().words == ["ones"]


def _expected(rows):
    return {i: Counter(words) for i, words in rows.items()}


def test_term_frequency_against_counter(texts):
    df = with_tokens(texts).select("id", "tokens")
    expected = _expected({r.id: r.tokens for r in df.collect()})
    rows = term_frequency(df, "id").collect()
    assert {(r.id, r.term): r.tf for r in rows} == {
        (i, t): n for i, c in expected.items() for t, n in c.items()}
    frequencies = Counter(t for c in expected.values() for t in c)
    assert {r.term: r.df for r in document_frequency(df).collect()} == dict(frequencies)


@pytest.mark.parametrize("rows_bound, hot_keys", [(10**6, 10**5), (0, 10), (0, 10**5)])
def test_tf_idf_against_brute_force(texts, monkeypatch, rows_bound, hot_keys):
    monkeypatch.setattr(limits, "BROADCAST_ROWS", rows_bound)
    monkeypatch.setattr(limits, "HOT_KEYS", hot_keys)
    df = with_tokens(texts).select("id", "tokens")
    counts = _expected({r.id: r.tokens for r in df.collect()})
    frequencies = Counter(t for c in counts.values() for t in c)
    got = {(r.id, r.term): r.tf_idf for r in tf_idf(df, "id").collect()}
    assert got == pytest.approx({
        (i, t): n * log((len(TEXTS) + 1) / (frequencies[t] + 1))
        for i, c in counts.items() for t, n in c.items()})


def test_term_counts_are_not_shuffled(texts):
    df = with_tokens(texts).select("id", "tokens")
    assert "Exchange" not in term_frequency(df, "id")._jdf.queryExecution().toString()


def test_hashed_weights_agree_with_exact_ones(texts):
    """With enough room there are no collisions: same multiset of weights per row."""
    df = with_tokens(texts).select("id", "tokens")
    hashed = HashingTF(inputCol="tokens", outputCol="raw", numFeatures=1 << 18).transform(df)
    weighed = IDF(inputCol="raw", outputCol="v").fit(hashed).transform(hashed)
    entries = vector_positions(weighed, "id", "v").collect()
    left = Counter((r.id, round(r.value, 9)) for r in entries)
    right = Counter((r.id, round(r.tf_idf, 9)) for r in tf_idf(df, "id").collect() if r.tf_idf)
    assert left == right


def test_stop_words_are_the_default_list(spark):
    from pyspark.ml.feature import StopWordsRemover

    from tallyfit.fixed_values import ENGLISH_STOP_WORDS

    assert ENGLISH_STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")


def test_import_reads_no_jar_and_starts_no_session():
    import subprocess
    import sys
    from pathlib import Path

    script = (
        "import builtins, glob, zipfile\n"
        "def refuse(*a, **k): raise OSError('no files at import')\n"
        "zipfile.ZipFile = refuse; glob.glob = refuse\n"
        "import __spark_entry__ as e\n"
        "assert len(e.queries()) >= 64 and len(e.oracle_sql()) >= 54\n"
        "from pyspark.sql import SparkSession\n"
        "assert SparkSession.getActiveSession() is None\n"
    )
    root = Path(__file__).parent.parent
    subprocess.run([sys.executable, "-c", script], cwd=root, check=True, timeout=120)
