"""Splits and samples of a table."""

from __future__ import annotations

from collections.abc import Sequence
from math import floor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import hash_number, hash_percent, hash_text
from ..sources.scratch import write_once


def split_by_key(
    df: DataFrame, key: str, percent: int = 80, salt: str = ""
) -> tuple[DataFrame, DataFrame]:
    """About ``percent`` of the rows and the rest, decided by the key value alone.

    The parts are the same however the table is laid out, and after a lost task is rerun.
    To split or sample a part once more, give the second step another ``salt``.
    """
    place = hash_percent(key, salt)
    return df.where(place < percent), df.where(place >= percent)


def sample_by_key(df: DataFrame, key: str, percent: int, salt: str = "") -> DataFrame:
    """About ``percent`` of the rows, always the same ones."""
    return df.where(hash_percent(key, salt) < percent)


def fold_by_key(
    df: DataFrame, key: str, folds: int, name: str = "fold", salt: str = ""
) -> DataFrame:
    """Add a fold number from 0 for cross-validation, decided by the key value alone."""
    return df.withColumn(name, (hash_number(key, salt) % folds).cast("int"))


def random_split(
    df: DataFrame, weights: Sequence[float], seed: int, key: str
) -> list[DataFrame]:
    """Random parts whose sizes are exactly those of ``weights``: the first parts together have
    the whole number of rows below their share, and so on.

    Rows stand in the order of a hash of ``seed`` and ``key``, and parts are cut at hashes, so a
    part is the same for every layout of ``df`` and after a lost task is rerun. Keys are unique;
    rows that share one stay together, which may make a part larger by them. A missing key
    counts as an empty one.

    Nothing is sorted: the hash at which a part ends is found digit by digit, from counts of
    rows by the next digits, for all parts at once.
    """
    total = sum(weights)
    if total <= 0 or min(weights) < 0:
        raise ValueError(f"weights must not be negative, nor all zero: {list(weights)}")
    place = hash_text(key, f"{seed}:")
    hashes = write_once(df.select(place.alias("hash")), "hashes")
    rows = hashes.count()
    shares = [sum(weights[:n + 1]) / total for n in range(len(weights) - 1)]
    cuts = ["", *_hashes_at(hashes, [floor(s * rows) for s in shares], rows), _LAST]
    return [df.where((place >= low) & (place < high)) for low, high in zip(cuts, cuts[1:])]


_LAST = "g"  # behind every hexadecimal digit
_DIGITS = 3  # digits counted at once: 4,096 counts at most for each cut


def _hashes_at(hashes: DataFrame, ranks: list[int], rows: int) -> list[str]:
    """For each rank a text with that many hashes before it."""
    found = {rank: "" if rank <= 0 else _LAST for rank in ranks if rank <= 0 or rank >= rows}
    open_at = {rank: ("", rank) for rank in ranks if rank not in found}  # prefix, rank inside
    length = 0
    while open_at:
        prefixes = sorted({prefix for prefix, _ in open_at.values()})
        inside = hashes.where(F.substring("hash", 1, length).isin(prefixes))
        counts: dict[str, list] = {}
        for row in inside.groupBy(F.substring("hash", 1, length + _DIGITS).alias("h")).count(
        ).orderBy("h").collect():
            counts.setdefault(row["h"][:length], []).append((row["h"], row["count"]))
        length += _DIGITS
        still = {}
        for rank, (prefix, left) in open_at.items():
            for step, count in counts[prefix]:
                if left == 0:
                    found[rank] = step
                    break
                if left < count:
                    # Equal keys have equal hashes and go together.
                    if length >= 32:
                        found[rank] = step + _LAST
                    else:
                        still[rank] = (step, left)
                    break
                left -= count
            else:
                found[rank] = counts[prefix][-1][0] + _LAST
        open_at = still
    return [found[rank] for rank in ranks]
