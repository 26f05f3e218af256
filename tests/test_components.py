"""Principal components against numpy, narrow and wide, dense and sparse."""

import numpy as np
import pytest
from pyspark.ml.feature import PCA
from pyspark.ml.linalg import Vectors

from tallyfit.operators import principal_components, project


def low_rank(rows, width, seed):
    pick = np.random.default_rng(seed)
    scales = np.array([9.0, 5.0, 3.0, 0.4])
    return (pick.standard_normal((rows, 4)) * scales) @ pick.standard_normal((4, width)) / 10


def test_narrow_equals_numpy_and_the_library(spark):
    data = low_rank(200, 6, 1) + 2
    df = spark.createDataFrame([(n, Vectors.dense(x)) for n, x in enumerate(data)],
                               ["id", "features"])
    found = principal_components(df, "features", 3)
    values = np.linalg.eigvalsh(np.cov(data.T))[::-1][:3]
    assert found.variances == pytest.approx(values) and found.rows == 200
    library = PCA(k=3, inputCol="features", outputCol="p").fit(df).pc.toArray()
    assert np.abs(np.abs(found.axes.T @ library) - np.eye(3)).max() < 1e-6
    along = np.array([r.projected for r in project(df, "id", "features", found).orderBy(
        "id").collect()])
    assert along == pytest.approx((data - data.mean(0)) @ found.axes)
    assert np.cov(along.T) == pytest.approx(np.diag(values), abs=1e-9)


@pytest.mark.parametrize("partitions", [1, 9])
def test_wide_sparse_rows(spark, partitions):
    data = low_rank(120, 40, 2)
    width = 100_000
    places = np.sort(np.random.default_rng(3).choice(width, 40, replace=False))
    rows = [(n, Vectors.sparse(width, places, x)) for n, x in enumerate(data)]
    df = spark.createDataFrame(rows, ["id", "features"]).repartition(partitions)
    found = principal_components(df, "features", 3)
    values = np.linalg.eigvalsh(np.cov(data.T))[::-1][:3]
    assert found.variances == pytest.approx(values) and found.rounds < 60
    assert found.axes.shape == (width, 3)
    inside = found.axes[places]
    assert (inside ** 2).sum(0) == pytest.approx(np.ones(3))
    along = np.array([r.projected for r in project(df, "id", "features", found).collect()])
    assert np.cov(along.T) == pytest.approx(np.diag(values), abs=1e-8)


def test_iterated_equals_exact(spark):
    data = low_rank(150, 60, 4) + np.random.default_rng(5).standard_normal((150, 60)) * 0.01
    df = spark.createDataFrame([(Vectors.dense(x),) for x in data], ["features"])
    exact = principal_components(df, "features", 3)
    iterated = principal_components(df, "features", 3, exact_width=10)
    assert iterated.variances == pytest.approx(exact.variances)
    assert np.abs(iterated.axes - exact.axes).max() < 1e-4


def test_refusals(spark, monkeypatch):
    df = spark.createDataFrame([(Vectors.dense([1.0, 2.0]),)], ["features"])
    with pytest.raises(ValueError, match="two rows"):
        principal_components(df, "features", 1)
    monkeypatch.setattr("tallyfit.limits.DRIVER_BYTES", 10)
    with pytest.raises(ValueError, match="DRIVER_BYTES"):
        principal_components(df.union(df), "features", 1, exact_width=1)
