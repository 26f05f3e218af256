"""Column expressions on texts that several operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def whole(text: Column | str) -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def word_count(text: Column | str) -> Column:
    """Number of words between ASCII white space; 0 for null."""
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def remainder(key: Column | str, by: int) -> Column:
    """CRC-32 of the key as text, modulo ``by``; a null key counts as an empty text."""
    key = F.col(key) if isinstance(key, str) else key
    return (F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % by).cast("int")


def shuffled_place(seed: int, *columns: Column | str) -> Column:
    """A number from 0 to 2**63 - 1 that depends on the seed and the values alone."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 1)
