"""Keyed joins that put features or looked-up values beside the rows they belong to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import limits
from ..sources.scratch import write_once


def attach_features(
    df: DataFrame, features: DataFrame, key: str | Sequence[str], how: str = "inner"
) -> DataFrame:
    """Put the columns of ``features`` beside the row with the same ``key``.

    ``key`` must be unique in ``features``; a key that two feature rows share stops the job, as
    it would multiply rows. ``how="left"`` keeps rows without features. A join without a key
    would pair every row with every other one and is refused, as are columns that both sides
    have. The check is made by the shuffle that the join needs anyway.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if not keys:
        raise ValueError("attach_features needs at least one key column")
    shared = set(df.columns) & set(features.columns) - set(keys)
    if shared:
        raise ValueError(f"columns on both sides: {sorted(shared)}")
    others = [c for c in features.columns if c not in keys]
    if not others:
        return df.join(features, keys, how)
    found = features.dropna(subset=keys).groupBy(*keys).agg(
        F.count("*").alias("_rows"), F.first(F.struct(*others)).alias("_features")
    )
    said = F.raise_error(F.concat(F.lit("repeated key in features: "), F.to_json(F.struct(*keys))))
    one = F.when(F.col("_rows") > 1, said.cast("boolean")).otherwise(F.lit(True))
    unique = found.where(one).select(*keys, "_features.*")
    return df.join(unique, keys, how)


def attach_by_position(left: DataFrame, right: DataFrame, number: str) -> DataFrame:
    """Put the columns of ``right`` beside the row of ``left`` with the same row number, for
    tables in files that have no key in common.

    ``number`` names the column that ``read_csv(row_number=...)`` or ``with_row_numbers`` adds
    to both. Tables of unequal length are refused, as are columns that both have. No two rows
    share a number, so the join has no heavy key.
    """
    shared = set(left.columns) & set(right.columns) - {number}
    if shared:
        raise ValueError(f"columns on both sides: {sorted(shared)}")
    rows = [side.count() for side in (left, right)]
    if rows[0] != rows[1]:
        raise ValueError(f"tables of unequal length: {rows[0]} and {rows[1]} rows")
    return left.join(right, number)


def attach_lookup(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    value: str,
    default=None,
    weight: str | None = None,
) -> DataFrame:
    """Add ``value`` from ``lookup(key, value)`` to every row of ``df``.

    Rows whose key is null or not in ``lookup`` get ``default``. A lookup table of checked
    small size is broadcast. A larger one is joined in two parts: keys that hold many rows
    of ``df`` are few by definition and are broadcast, so their rows are not shuffled at
    all; the rest, with no heavy key among them, goes through a shuffle join. A heavy key of
    any length travels as its hash and digest, so that only ``value``, which should be short,
    decides what is broadcast. ``weight``
    names a column of ``lookup`` with the rows of ``df`` per key; without it they are
    counted.
    """
    entry_bytes = sum(
        F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in (key, value)
    )
    size = lookup.agg(F.count("*").alias("rows"), F.sum(entry_bytes + 16).alias("bytes")).first()
    pairs = lookup.select(key, value)
    if size["rows"] <= limits.BROADCAST_ROWS and (size["bytes"] or 0) <= limits.BROADCAST_BYTES:
        return _with_default(df.join(F.broadcast(pairs), key, "left"), value, default)

    if weight is None:
        weighed = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_weight"))
    else:
        weighed = lookup.select(key, F.col(weight).alias("_weight"))
    weighed = write_once(weighed, "weights")
    total = weighed.agg(F.sum("_weight")).first()[0] or 0
    # The digest is taken only of rows whose hash is that of a heavy key.
    digest = F.sha2(F.col(key).cast("string").cast("binary"), 256)
    is_hot = (F.xxhash64(key) == F.col("_hash")) & (digest == F.col("_digest"))
    hot_keys = weighed.where(F.col("_weight") > total / limits.HOT_KEYS).select(
        F.xxhash64(key).alias("_hash"), digest.alias("_digest")
    )
    hot_found = pairs.join(F.broadcast(hot_keys), is_hot).select("_hash", "_digest", value)
    hot = hot_keys.join(F.broadcast(hot_found), ["_hash", "_digest"], "left")

    marked = df.join(F.broadcast(hot), is_hot, "left")
    head = marked.where(F.col("_hash").isNotNull() | F.col(key).isNull()).drop("_hash", "_digest")
    rest = df.where(F.col(key).isNotNull()).join(F.broadcast(hot_keys), is_hot, "left_anti")
    tail = rest.join(pairs, key, "left")
    return _with_default(tail.unionByName(head), value, default)


def _with_default(df: DataFrame, value: str, default) -> DataFrame:
    if default is None:
        return df
    return df.withColumn(value, F.coalesce(F.col(value), F.lit(default)))
