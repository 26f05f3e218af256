"""Centroid clustering against plain Python integers."""

import math
import random
from hashlib import sha256

import numpy as np
import pytest

from tallyfit.llm import centroid_clusters
from tallyfit.llm.catalog import QUERIES
from tallyfit.llm.centroid_clusters import cluster_vectors, products, updated

FOLDER = "/root/testdata/sf0.001"


def expected(rows, clusters=40, rounds=5, dimensions=64):
    kept = []
    for key, vector in rows:
        if vector is not None and len(vector) == dimensions and all(
                v is not None and math.isfinite(v) for v in vector):
            kept.append((key, [math.floor(256 * float(v)) for v in vector]))

    def place(row):
        return (row[0] is None, sha256(f"2:{row[0]}".encode()).hexdigest(), row[1])

    centroids = [x for _, x in sorted(kept, key=place)[:clusters]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(nearest(x)[1], []).append(x)
        for n, own in groups.items():
            centroids[n] = [sum(c) // len(own) for c in zip(*own)]
    last = [(key, *nearest(x)) for key, x in kept]
    inertia = {}
    for _, away, n in last:
        inertia[n] = inertia.get(n, 0) + away
    digest = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted([(key, n, away, inertia[n], sum(inertia.values()), digest[n])
                   for key, away, n in last], key=str)


def rows_of(df):
    return sorted(map(tuple, df.select("vec_id", "cluster", "distance", "cluster_inertia",
                                       "inertia", "centroid_sha256").collect()), key=str)


def test_updates_equal_products():
    pick = np.random.default_rng(3)
    for top in (300, 1 << 27):
        vectors = pick.integers(-top, top, (50, 6))
        old = pick.integers(-top, top, (4, 6))
        new = old.copy()
        new[1, 2] += 5
        new[3] = pick.integers(-top, top, 6)
        whole = np.array([[sum(int(a) * int(b) for a, b in zip(v, c)) for c in new]
                          for v in vectors])
        assert (products(vectors, new) == whole).all()
        assert (updated(products(vectors, old), vectors, old, new) == whole).all()


@pytest.mark.parametrize("batch", [3, 4096])
def test_equals_plain_python(spark, monkeypatch, batch):
    monkeypatch.setattr(centroid_clusters, "BATCH", batch)
    pick = random.Random(4)
    rows = [(n, [pick.choice([-1.5, -0.3, 0.0, 0.2, 0.9, 3.0]) for _ in range(4)])
            for n in range(200)]
    rows += [(5, [0.2] * 4), (5, [0.2] * 4), (None, [1.0] * 4), (300, None), (301, []),
             (302, [1.0] * 3), (303, [1.0, None, 1.0, 1.0]), (304, [math.nan] * 4),
             (305, [math.inf, 0.0, 0.0, 0.0]), (2 ** 60 + 1, [400_000.0, -400_000.0, 0.0, 0.001])]
    df = spark.createDataFrame([(*r, 1) for r in rows],
                               "vec_id long, embedding array<double>, cluster int")
    found = rows_of(cluster_vectors(df, clusters=7, dimensions=4))
    assert found == expected(rows, 7, dimensions=4)


def test_small_tables(spark):
    kind = "vec_id long, embedding array<float>"
    assert cluster_vectors(spark.createDataFrame([], kind)).count() == 0
    rows = [(1, [0.5, 1.0]), (2, [0.5, 1.0]), (3, [-2.0, 0.0])]
    found = rows_of(cluster_vectors(spark.createDataFrame(rows, kind), dimensions=2))
    assert found == expected(rows, dimensions=2)
    with pytest.raises(Exception, match="no exact distance"):
        cluster_vectors(spark.createDataFrame([(1, [1e9, 0.0])], kind), dimensions=2).count()


def test_query(spark):
    vectors = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding")
    found = QUERIES["op13_incremental_centroids"](spark, FOLDER)
    assert rows_of(found) == expected([(r.vec_id, r.embedding) for r in vectors.collect()])
