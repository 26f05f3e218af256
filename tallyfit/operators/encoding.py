"""Category indexes, one-hot positions and views of vector columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import limits
from ..sources.scratch import write_once
from .attaching import attach_lookup
from .positions import with_position


def category_index(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, rows, index)`` for every value of ``columns``.

    Indexes count from 0 by falling frequency; equal frequencies go by the value as a
    string. Nothing is collected, so the number of values is not bounded by the driver.
    """
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    counts = (
        texts.unpivot([], list(columns), "column", "value")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("rows"))
    )
    ranked = with_position(counts, ["column", F.desc("rows"), "value"])
    first = ranked.groupBy("column").agg(F.min("position").alias("_first"))
    return (
        ranked.join(F.broadcast(first), "column")  # one row per column of ``columns``
        .withColumn("index", F.col("position") - F.col("_first"))
        .drop("position", "_first")
    )


@dataclass
class CategoryIndex:
    """Maps values of several columns to their index in the table it was fitted on.

    Columns with few values use one string indexer, which keeps its labels on the driver.
    Columns beyond ``limits.DRIVER_LABELS`` values keep them together in one table and are
    joined, all of them at once.
    """

    columns: list[str]
    suffix: str = "Index"
    handle_invalid: str = "keep"
    small: StringIndexerModel | None = None
    large: list[str] = field(default_factory=list)
    lookup: DataFrame | None = None
    sizes: dict[str, int] = field(default_factory=dict)

    @property
    def output_columns(self) -> list[str]:
        return [c + self.suffix for c in self.columns]

    def fit(self, df: DataFrame) -> CategoryIndex:
        counts = df.agg(*[F.approx_count_distinct(c).alias(c) for c in self.columns]).first()
        few = [c for c in self.columns if counts[c] <= limits.DRIVER_LABELS]
        self.large = [c for c in self.columns if c not in few]
        if few:
            indexer = StringIndexer(
                inputCols=few,
                outputCols=[c + self.suffix for c in few],
                handleInvalid=self.handle_invalid,
            )
            self.small = indexer.fit(df)
        if self.large:
            table = write_once(category_index(df, self.large), "category-index")
            numbers = F.array_position(F.lit(self.large), F.col("column")) - 1
            self.lookup = table.select(
                _entry(numbers, F.col("value")).alias("_entry"), F.col("index").alias("_index")
            )
            found = {r["column"]: r["count"] for r in table.groupBy("column").count().collect()}
            self.sizes = {c: found.get(c, 0) for c in self.large}
        return self

    def _joined(self, df: DataFrame) -> DataFrame:
        """Add the indexes of all large columns, null where a value has none.

        The table is written once with a number for each row. Its large columns, one below the
        other, meet the lookup table in one join, which copes with heavy values; the indexes
        of a row come together by its number and go back beside it. No two rows share a number.
        """
        saved = write_once(df.withColumn("_row", F.monotonically_increasing_id()), "to-index")
        cells = [
            F.struct(F.lit(n).alias("_n"),
                     _entry(F.lit(n), F.col(c).cast("string")).alias("_entry"))
            for n, c in enumerate(self.large)
        ]
        long = saved.select("_row", F.inline(F.array(*cells))).where(F.col("_entry").isNotNull())
        found = attach_lookup(long, self.lookup, "_entry", "_index")
        place = [F.max(F.when(F.col("_n") == n, F.col("_index"))).cast("double")
                 .alias(c + self.suffix) for n, c in enumerate(self.large)]
        return saved.join(found.groupBy("_row").agg(*place), "_row", "left").drop("_row")

    def _checked(self, df: DataFrame, column: str) -> DataFrame:
        """Treat the values without an index, and describe the index column to later stages,
        as the string indexer does for columns with few values."""
        name, size = column + self.suffix, self.sizes[column]
        if self.handle_invalid == "skip":
            df = df.where(F.col(name).isNotNull())
        elif self.handle_invalid == "error":
            unseen = F.raise_error(F.lit(f"unseen value in {column}"))
            df = df.withColumn(name, F.when(F.col(name).isNull(), unseen).otherwise(F.col(name)))
        else:
            df = df.withColumn(name, F.coalesce(name, F.lit(float(size))))
        count = size + 1 if self.handle_invalid == "keep" else size
        nominal = {"type": "nominal", "name": name, "num_vals": count}
        return df.withMetadata(name, {"ml_attr": nominal})

    def transform(self, df: DataFrame) -> DataFrame:
        """Add one index column per column. Values not seen in ``fit``, and nulls, get the next
        index (``keep``), take their row away (``skip``) or are an error (``error``)."""
        if self.small is not None:
            df = self.small.transform(df)
        if self.large:
            df = self._joined(df)
        for c in self.large:
            df = self._checked(df, c)
        return df


def _entry(number: Column, value: Column) -> Column:
    """A column number and a value as one key; null without a value."""
    return F.concat(number.cast("string"), F.lit(":"), value)


def vector_positions(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``(key, position, value)`` for the entries of a vector that are not zero.

    Reads the stored form of the vector, so a wide sparse vector is not made dense.
    """
    parts = df.select(key, F.unwrap_udt(vector).alias("_v"))
    places = F.when(F.col("_v.type") == 0, F.col("_v.indices")).otherwise(
        F.sequence(F.lit(0), F.size("_v.values") - 1)
    )
    return (
        parts.select(key, F.inline(F.arrays_zip(places.alias("position"),
                                                F.col("_v.values").alias("value"))))
        .where(F.col("value") != 0)
    )


def one_hot_positions(df: DataFrame, key: str, vectors: Sequence[str]) -> DataFrame:
    """``(key, column, position, size)``: the active position of each one-hot vector, or null."""
    parts = df.select(key, *[F.unwrap_udt(v).alias(v) for v in vectors])
    rows = [
        F.struct(
            F.lit(v).alias("column"),
            F.get(F.col(f"{v}.indices"), F.lit(0)).alias("position"),
            F.col(f"{v}.size").alias("size"),
        )
        for v in vectors
    ]
    return parts.select(key, F.inline(F.array(*rows)))
