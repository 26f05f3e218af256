"""Which dimensions of a vector column have few distinct values."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorIndexer, VectorIndexerModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import new_folder, write_once

_PARTIAL = "position int, value double, many boolean, stored long"


def _few_in_task(most: int):
    """Per task at most ``most`` values other than zero for each dimension; a dimension with more
    is only marked. Its size follows from the width of the vectors, not from the rows."""
    def collect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        many, stored, few, rows, width = (np.zeros(0, bool), np.zeros(0, np.int64), {}, 0, 0)
        for batch in batches:
            rows += len(batch)
            if not len(batch):
                continue
            width = max(width, int(batch["size"].max()))
            if width > len(many):
                many = np.pad(many, (0, width - len(many)))
                stored = np.pad(stored, (0, width - len(stored)))
            place = np.concatenate(batch["places"].to_numpy()).astype(np.int64)
            value = np.concatenate(batch["values"].to_numpy()).astype(float)
            place, value = place[value != 0], value[value != 0]
            stored += np.bincount(place, minlength=len(stored))
            looked = ~many[place]
            pairs = pd.DataFrame({"p": place[looked], "v": value[looked]}).drop_duplicates()
            for p, v in zip(pairs["p"].tolist(), pairs["v"].tolist()):
                own = few.setdefault(p, set())
                own.add(v)
                if len(own) > most:
                    many[p] = True
        out = [(p, v, False, 0) for p, own in few.items() if not many[p] for v in own]
        out += [(int(p), None, bool(many[p]), int(stored[p])) for p in np.flatnonzero(stored)]
        out.append((-1, float(width), False, rows))
        yield pd.DataFrame(out, columns=["position", "value", "many", "stored"])

    return collect


def few_values(df: DataFrame, vector: str, most: int) -> DataFrame:
    """``(position, categories)``: the distinct values, in order, of each dimension that has at
    most ``most`` of them; zeros that a sparse vector does not store are values too. Dimensions
    in which no vector stores anything are left out; position -1 holds the width.

    Tables of any number of partitions: tasks hand on a few values per dimension, which a
    shuffle by dimension merges.
    """
    parts = df.where(F.col(vector).isNotNull()).select(F.unwrap_udt(vector).alias("v"))
    places = F.when(F.col("v.type") == 0, F.col("v.indices")).otherwise(
        F.sequence(F.lit(0), F.size("v.values") - 1))
    size = F.when(F.col("v.type") == 0, F.col("v.size")).otherwise(F.size("v.values"))
    partial = parts.select(places.alias("places"), F.col("v.values").alias("values"),
                           size.alias("size")).mapInPandas(_few_in_task(most), _PARTIAL)
    merged = partial.groupBy("position").agg(
        F.collect_set("value").alias("values"), F.bool_or("many").alias("many"),
        F.sum("stored").alias("stored"))
    merged = write_once(merged, "values")  # one row for each dimension
    rows = merged.where("position < 0").first()
    zero = F.when(F.col("stored") < (rows["stored"] if rows else 0), F.array(F.lit(0.0))).otherwise(
        F.array().cast("array<double>"))
    values = F.when(F.col("position") < 0, F.array(F.array_max("values"))).otherwise(
        F.array_sort(F.array_union("values", zero)))
    kept = ~F.col("many") & ((F.col("position") < 0) | (F.size(values) <= most))
    return merged.select("position", F.when(kept, values).alias("categories"))


def fit_vector_indexer(
    df: DataFrame, vector: str, output: str, most: int, handle_invalid: str = "keep"
) -> VectorIndexerModel:
    """A vector indexer for dimensions with at most ``most`` values, from :func:`few_values`.

    The library's own fit sends one result per partition to the driver. It is given a table of
    ``most + 1`` vectors instead, in which every dimension has exactly the values found, or one
    too many to be a category; what it learns from them is what it would learn from ``df``.
    """
    found = few_values(df, vector, most).collect()
    width = int(next((r["categories"][0] for r in found if r["position"] < 0), 0))
    if not width:
        raise ValueError("no vectors to index")
    table = np.zeros((most + 1, width))
    for row in found:
        if row["position"] >= 0:
            values = row["categories"] or range(1, most + 2)
            table[:, row["position"]] = [values[n % len(values)] for n in range(most + 1)]
    vectors = df.sparkSession.createDataFrame([(Vectors.dense(t),) for t in table], [vector])
    return VectorIndexer(inputCol=vector, outputCol=output, maxCategories=most,
                         handleInvalid=handle_invalid).fit(vectors.coalesce(1))


def categories_of(df: DataFrame, vector: str, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For wide vectors, from :func:`few_values`: how many categories each dimension has, 0 for
    one with more than ``most`` values, and their values, in the order of the library's indexer:
    zero first, if it occurs, then as they rise. Unused places of the second array are NaN."""
    found = few_values(df, vector, most)
    zero_first = F.concat(F.filter("categories", lambda x: x == 0),
                          F.filter("categories", lambda x: x != 0))
    rows = found.select("position", F.when(F.col("position") < 0, F.col("categories"))
                        .otherwise(zero_first).alias("values")).toArrow()
    positions, lists = rows["position"].to_numpy(), rows["values"].combine_chunks()
    lengths = lists.value_lengths().fill_null(0).to_numpy()
    values = lists.flatten().to_numpy()
    starts = np.cumsum(lengths) - lengths
    about = np.flatnonzero(positions < 0)
    width = int(values[starts[about[0]]]) if len(about) else 0
    if not width:
        raise ValueError("no vectors to index")
    counts, table = np.ones(width, np.int8), np.full((width, most), np.nan)
    table[:, 0] = 0  # dimensions in which nothing is stored
    own = positions >= 0
    counts[positions[own]], table[positions[own], 0] = lengths[own], np.nan
    for n in range(most):
        has = own & (lengths > n)
        table[positions[has], n] = values[starts[has] + n]
    return counts, table


def indexer_of(
    spark: SparkSession, categories: dict[int, list[float]], width: int, vector: str,
    output: str, most: int, handle_invalid: str = "keep",
) -> VectorIndexerModel:
    """The library's indexer of vectors of ``width`` dimensions for given categories, by its
    saved form; dimensions without any are left as they are. A fit of one dimension gives the
    frame, as the library's own keeps a set for each dimension."""
    frame = VectorIndexer(inputCol=vector, outputCol=output, maxCategories=most,
                          handleInvalid=handle_invalid)
    path = new_folder(spark, "indexer")
    frame.fit(spark.createDataFrame([(Vectors.dense([0.0]),)], [vector])).write().save(path)
    maps = {d: {float(v): n for n, v in enumerate(own)} for d, own in categories.items()}
    table = spark.createDataFrame(
        [(width, maps)], "numFeatures int, categoryMaps map<int, map<double, int>>")
    table.write.mode("overwrite").parquet(f"{path}/data")
    return VectorIndexerModel.load(path)
