"""Category indexes, vectors and covariances."""

import numpy as np
import pytest
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.linalg import Vectors

from tallyfit import limits
from tallyfit.operators import CategoryIndex, category_index, covariance_matrix, vector_positions
from tallyfit.sources import literal_table

ROWS = [(10, "b"), (9, "a"), (9, "b"), (8, "a"), (100, "c"), (8, None)]


@pytest.fixture
def rows(spark):
    return literal_table(spark, [(i, *r) for i, r in enumerate(ROWS)], "id int, n int, s string")


def test_ties_go_by_the_value_as_text(rows):
    got = {(r["column"], r.value): r["index"] for r in category_index(rows, ["n", "s"]).collect()}
    assert got == {("n", "8"): 0, ("n", "9"): 1, ("n", "10"): 2, ("n", "100"): 3,
                   ("s", "a"): 0, ("s", "b"): 1, ("s", "c"): 2}


@pytest.mark.parametrize("labels_bound", [100, 0])
def test_both_ways_agree_with_the_indexer(rows, spark, monkeypatch, labels_bound):
    monkeypatch.setattr(limits, "DRIVER_LABELS", labels_bound)
    seen = rows.where("s is not null")
    index = CategoryIndex(["n", "s"]).fit(seen)
    plain = StringIndexer(inputCols=["n", "s"], outputCols=["a", "b"]).fit(seen).transform(seen)
    expected = {r.id: (r.a, r.b) for r in plain.collect()}
    got = {r.id: (r.nIndex, r.sIndex) for r in index.transform(seen).collect()}
    assert got == expected
    later = literal_table(spark, [(1, 7, "z"), (2, 9, None)], "id int, n int, s string")
    unseen = {r.id: (r.nIndex, r.sIndex) for r in index.transform(later).collect()}
    assert unseen == {1: (4.0, 3.0), 2: (expected[1][0], 3.0)}


@pytest.mark.parametrize("labels_bound", [100, 0])
def test_unseen_value_can_be_an_error(rows, spark, monkeypatch, labels_bound):
    monkeypatch.setattr(limits, "DRIVER_LABELS", labels_bound)
    index = CategoryIndex(["n"], handle_invalid="error").fit(rows)
    assert index.transform(rows).count() == len(ROWS)
    with pytest.raises(Exception):
        index.transform(literal_table(spark, [(1, 7)], "id int, n int")).collect()


def test_vector_positions_of_both_kinds(spark):
    df = spark.createDataFrame(
        [(1, Vectors.sparse(9, [2, 7], [1.0, 3.0])), (2, Vectors.dense(0.0, 5.0))], ["id", "v"]
    )
    got = sorted(tuple(r) for r in vector_positions(df, "id", "v").collect())
    assert got == [(1, 2, 1.0), (1, 7, 3.0), (2, 1, 5.0)]


@pytest.mark.parametrize("block", [1024, 2])
def test_covariance_against_numpy(spark, monkeypatch, block):
    monkeypatch.setattr(limits, "COVARIANCE_WIDTH", block)
    rng = np.random.default_rng(0)
    data = rng.normal(size=(200, 5)) + 1000
    df = spark.createDataFrame([(x.tolist(),) for x in data], "x array<double>").repartition(7)
    got = np.zeros((5, 5))
    for r in covariance_matrix(df, "x").collect():
        got[r.i, r.j] = r.covariance
    assert np.allclose(got, np.cov(data.T))


def test_covariance_of_an_empty_table(spark):
    df = spark.createDataFrame([(None,)], "x array<double>")
    assert covariance_matrix(df, "x").collect() == []
    assert covariance_matrix(df.limit(0), "x").collect() == []


INVALID = [(1, 8), (2, 7), (3, None), (4, 9)]


@pytest.mark.parametrize("handle_invalid", ["keep", "skip", "error"])
def test_both_ways_treat_unseen_values_alike(rows, spark, monkeypatch, handle_invalid):
    seen = rows.where("s is not null")
    later = literal_table(spark, INVALID, "id int, n int")
    if handle_invalid == "error":
        later = later.where("n in (8, 9)")
    found = []
    for bound in (100, 0):
        monkeypatch.setattr(limits, "DRIVER_LABELS", bound)
        index = CategoryIndex(["n"], handle_invalid=handle_invalid).fit(seen)
        encoder = OneHotEncoder(inputCol="nIndex", outputCol="v", handleInvalid="keep")
        vectors = encoder.fit(index.transform(seen)).transform(index.transform(later))
        found.append(sorted((r.id, r.n, r.nIndex, r.v.size, r.v.indices.tolist())
                            for r in vectors.collect()))
    assert found[0] == found[1]
    assert len(found[0]) == {"keep": 4, "skip": 2, "error": 2}[handle_invalid]


def test_many_large_columns_are_joined_at_once(rows, spark, monkeypatch):
    """One write for all columns; a heavy value, a null and an unseen one in each."""
    from tallyfit.operators import encoding

    monkeypatch.setattr(limits, "DRIVER_LABELS", 0)
    monkeypatch.setattr(limits, "BROADCAST_ROWS", 2)
    columns = [f"c{n}" for n in range(5)]
    data = [(i, *[None if i == n else "a:%d" % (0 if i % 3 else i * (n + 1)) for n in range(5)])
            for i in range(60)]
    seen = literal_table(spark, data, "id int, " + ", ".join(c + " string" for c in columns))
    index = CategoryIndex(columns).fit(seen)
    written = []
    write = encoding.write_once
    monkeypatch.setattr(
        encoding, "write_once", lambda df, name: written.append(name) or write(df, name))
    later = seen.withColumnRenamed("id", "key").limit(59)
    got = {r.key: tuple(r)[6:] for r in index.transform(later).collect()}
    assert written == ["to-index"] and len(got) == 59
    plain = StringIndexer(inputCols=columns, outputCols=[c + "I" for c in columns],
                          handleInvalid="keep").fit(seen)
    assert got == {r.key: tuple(r)[6:] for r in plain.transform(later).collect()}
    empty = index.transform(later.limit(0))
    assert empty.collect() == [] and empty.columns == later.columns + index.output_columns
