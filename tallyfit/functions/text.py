"""Text expressions and words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Tokenizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import ENGLISH_STOP_WORDS, EXTRA_STOP_WORDS, REMOVED_CHARACTERS


def remove_characters(text: Column | str, pattern: str = REMOVED_CHARACTERS) -> Column:
    """``text`` without any character that matches ``pattern``."""
    return F.regexp_replace(text, pattern, "")


def with_tokens(df: DataFrame, text: str = "text", name: str = "tokens") -> DataFrame:
    """Add the lower-cased words of ``text`` between single whitespace characters.

    Blanks at the start or in a row give empty tokens, blanks at the end give none. An empty
    or missing text gives one empty token.
    """
    return Tokenizer(inputCol=text, outputCol=name).transform(df.na.fill("", [text]))


def stop_words(extra: Sequence[str] = EXTRA_STOP_WORDS) -> list[str]:
    """``extra`` words, then the default English list; entries are trimmed, else one with
    a blank around it could never match a token."""
    return [word.strip() for word in extra] + ENGLISH_STOP_WORDS


def hash_text(key: Column | str, salt: str = "") -> Column:
    """32 hexadecimal digits that depend on ``salt`` and the key value alone; a missing key
    counts as an empty one, so that its row is not lost."""
    text = (F.col(key) if isinstance(key, str) else key).cast("string")
    return F.md5(F.concat(F.lit(salt), F.coalesce(text, F.lit(""))))


def hash_number(key: Column | str, salt: str = "") -> Column:
    """The number that the first eight digits of the hash are, of 32 bits."""
    return F.conv(F.substring(hash_text(key, salt), 1, 8), 16, 10).cast("bigint")


def hash_percent(key: Column | str, salt: str = "") -> Column:
    """A number from 0 to 99 that depends on ``salt`` and the key value alone."""
    return hash_number(key, salt) % 100
