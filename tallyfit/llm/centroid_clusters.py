"""Centroid clustering over integers, with a distance matrix that is kept up to date.

Every vector keeps its exact dot products with all centroids. A round changes few components of
the centroids, and none of those that have settled; only these changes, times the vector's own
components, are added to the products. Distances follow from products and squared lengths, so
no round multiplies vectors with whole centroids again. Vectors and products stay in a written
table of batches, rewritten each round; what leaves a batch are sums per cluster.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import new_folder

DIMENSIONS = 64
SCALE = 256
CLUSTERS = 40
ROUNDS = 5
SEED = 2
BATCH = 4096  # vectors per row of the written table
LARGEST = 1 << 27  # beyond it a squared distance does not fit a long
EXACT = 1 << 53  # whole numbers below it are exact as doubles

_STATE = "ids array<string>, vectors binary, products binary, clusters binary, nearest binary, " \
    "sums binary, counts binary, inertia binary"


def whole_vectors(df: DataFrame, key: str, vector: str, dimensions: int) -> DataFrame:
    """``(key, x)``: vectors of the right length without null or non-finite components, each
    component scaled and rounded down to an integer."""
    x = F.transform(F.col(vector), lambda v: v.cast("double"))
    fine = (F.size("x") == dimensions) & F.forall(
        "x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    kept = df.select(F.col(key).alias("key"), x.alias("x")).where(F.coalesce(fine, F.lit(False)))
    scaled = F.transform("x", lambda v: F.floor(v * SCALE))
    too_large = F.exists("x", lambda v: F.abs(v * SCALE) > LARGEST)
    said = F.raise_error(F.lit(f"a component beyond {LARGEST // SCALE} has no exact distance"))
    return kept.select("key", F.when(too_large, said.cast("array<bigint>")).otherwise(
        scaled.cast("array<bigint>")).alias("x"))


def starting_centroids(vectors: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors with the smallest hash of seed and key; null keys come last, rows with equal
    keys go by their components."""
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")).cast("binary"), 256)
    first = vectors.orderBy(place.asc_nulls_last(), "x").limit(clusters).collect()
    return np.array([row.x for row in first], np.int64)


def products(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact dot products of all vectors with all centroids: through doubles, which are fast,
    where every sum is small enough for them, else through integers."""
    bound = np.abs(vectors).max(initial=0) * np.abs(centroids).max(initial=0)
    if int(bound) * max(1, vectors.shape[1]) < EXACT:
        return (vectors.astype(float) @ centroids.T.astype(float)).astype(np.int64)
    return vectors @ centroids.T


def updated(kept: np.ndarray, vectors: np.ndarray, old: np.ndarray, new: np.ndarray):
    """Products with ``new`` centroids from those with ``old`` ones: each centroid adds its
    changed components alone."""
    change = new - old
    fresh = kept.copy()
    for number in np.flatnonzero(change.any(1)):
        moved = np.flatnonzero(change[number])
        fresh[:, number] += products(vectors[:, moved], change[number:number + 1, moved])[:, 0]
    return fresh


def assigned(vectors: np.ndarray, dots: np.ndarray, centroids: np.ndarray):
    """The nearest centroid of each vector, the smaller number at ties, and the distance."""
    lengths = (centroids * centroids).sum(1)
    away = lengths[None, :] - 2 * dots
    nearest = away.argmin(1)
    own = (vectors * vectors).sum(1)
    return nearest, away[np.arange(len(vectors)), nearest] + own


def _blob(values: np.ndarray, kind=np.int64) -> bytes:
    """Small integers compress well."""
    return pa.compress(np.ascontiguousarray(values, kind).tobytes(), "zstd", asbytes=True)


def _values(content: bytes, count: int, kind=np.int64) -> np.ndarray:
    size = count * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(content, size, "zstd", asbytes=True), kind)


def _settled(ids, vectors: np.ndarray, dots: np.ndarray, centroids: np.ndarray) -> tuple:
    """One row of the written table."""
    count = len(centroids)
    nearest, away = assigned(vectors, dots, centroids)
    sums = np.zeros((count, vectors.shape[1]), np.int64)
    np.add.at(sums, nearest, vectors)
    inertia = np.zeros((count, 2), np.int64)  # upper and lower 32 bits of all distances
    np.add.at(inertia, nearest, np.stack([away >> 32, away & 0xFFFFFFFF], 1))
    return (ids, _blob(vectors, np.int32), _blob(dots), _blob(nearest, np.int32), _blob(away),
            _blob(sums), _blob(np.bincount(nearest, minlength=count)), _blob(inertia))


def _first_round(centroids: np.ndarray):
    def begin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for at in range(0, len(frame), BATCH):
                part = frame.iloc[at:at + BATCH]
                vectors = np.stack(part["x"].to_numpy()).astype(np.int64)
                row = _settled(part["id"].tolist(), vectors, products(vectors, centroids),
                               centroids)
                yield pd.DataFrame([row], columns=_COLUMNS)

    return begin


def _next_round(old: np.ndarray, new: np.ndarray):
    def go_on(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count, dimensions = new.shape
        for frame in batches:
            for row in frame.itertuples(index=False):
                n = len(row.ids)
                vectors = _values(row.vectors, n * dimensions, np.int32)
                vectors = vectors.reshape(n, dimensions).astype(np.int64)
                dots = _values(row.products, n * count).reshape(n, count)
                made = _settled(row.ids, vectors, updated(dots, vectors, old, new), new)
                yield pd.DataFrame([made], columns=_COLUMNS)

    return go_on


_COLUMNS = [field.split()[0] for field in _STATE.split(", ")]


def _totals(count: int, dimensions: int):
    """Per task the sums of all its batches: one row for each cluster."""
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((count, dimensions), object)
        counts, inertia = np.zeros(count, object), np.zeros(count, object)
        for frame in batches:
            for row in frame.itertuples(index=False):
                sums += _values(row.sums, count * dimensions).reshape(count, dimensions)
                counts += _values(row.counts, count)
                high, low = _values(row.inertia, 2 * count).reshape(count, 2).T.astype(object)
                inertia += high * (1 << 32) + low
        yield pd.DataFrame({"cluster": range(count), "n": counts.astype(np.int64),
                            "sums": [[str(v) for v in s] for s in sums],
                            "inertia": [str(v) for v in inertia]})

    return add


def _summed(state: DataFrame, count: int, dimensions: int):
    """Sums, sizes and inertia of all clusters; 40 rows reach the driver for each round."""
    if not count:
        return np.zeros((0, dimensions), object), [], []
    schema = "cluster int, n long, sums array<string>, inertia string"
    parts = state.select("sums", "counts", "inertia").mapInPandas(
        _totals(count, dimensions), schema)
    exact = "decimal(38,0)"
    rows = parts.groupBy("cluster").agg(
        F.sum("n").alias("n"), F.sum(F.col("inertia").cast(exact)).alias("inertia"),
        *[F.sum(F.col("sums")[d].cast(exact)).alias(f"s{d}") for d in range(dimensions)],
    ).collect()
    sums = np.zeros((count, dimensions), object)
    counts, inertia = np.zeros(count, object), np.zeros(count, object)
    for row in rows:
        counts[row["cluster"]], inertia[row["cluster"]] = int(row["n"]), int(row["inertia"])
        sums[row["cluster"]] = [int(row[f"s{d}"]) for d in range(dimensions)]
    return sums, counts, inertia


def moved_centroids(old: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The mean of each cluster, rounded down; an empty cluster keeps its centroid."""
    new = old.copy()
    for number in range(len(old)):
        if counts[number]:
            new[number] = [int(s) // int(counts[number]) for s in sums[number]]
    return new


def _written(state: DataFrame, path: str) -> DataFrame:
    state.write.parquet(path)
    return state.sparkSession.read.schema(state.schema).parquet(path)


def _dropped(spark: SparkSession, path: str) -> None:
    """Remove a table that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in batches:
        for row in frame.itertuples(index=False):
            n = len(row.ids)
            yield pd.DataFrame({"id": row.ids, "cluster": _values(row.clusters, n, np.int32),
                                "distance": _values(row.nearest, n)})


def cluster_vectors(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", clusters: int = CLUSTERS,
    rounds: int = ROUNDS, dimensions: int = DIMENSIONS, seed: int = SEED,
) -> DataFrame:
    """``(key, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` for every vector
    of the right length without null or non-finite components; others have no row.

    Rows that repeat are vectors each. With fewer vectors than ``clusters`` there are as many
    clusters as vectors. Nearest centroids tie to the smaller number. Empty clusters keep their
    centroid. Other columns are not read. An empty table gives an empty result. A component
    beyond 524,288 in size has no exact distance in a long and is refused.

    All sums are exact. A round reads and writes the table of products once, in batches of
    4,096 vectors; the table before it is removed. No vector is shuffled.
    """
    spark = df.sparkSession
    kind = dict(df.select(F.col(key).alias("key")).dtypes)["key"]
    vectors = whole_vectors(df, key, vector, dimensions)
    centroids = starting_centroids(vectors, clusters, seed).reshape(-1, dimensions)
    count = len(centroids)
    named = vectors.select(F.col("key").cast("string").alias("id"), "x")
    path = new_folder(spark, "products")
    state = _written(named.mapInPandas(_first_round(centroids), _STATE), path)
    for _ in range(rounds if count else 0):
        sums, counts, _ = _summed(state, count, dimensions)
        moved = moved_centroids(centroids, sums, counts)
        after = new_folder(spark, "products")
        state = _written(state.mapInPandas(_next_round(centroids, moved), _STATE), after)
        _dropped(spark, path)
        path, centroids = after, moved
    _, _, inertia = _summed(state, count, dimensions)
    digests = [sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    # One row for each cluster.
    table = spark.createDataFrame(
        [(n, int(inertia[n]), int(sum(inertia)), digests[n]) for n in range(count)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    found = state.select("ids", "clusters", "nearest").mapInPandas(
        _rows, "id string, cluster int, distance long")
    return found.join(F.broadcast(table), "cluster").select(
        F.col("id").cast(kind).alias(key), "cluster", "distance", "cluster_inertia", "inertia",
        "centroid_sha256",
    )
