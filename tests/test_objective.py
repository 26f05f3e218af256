"""Loss and gradient of a logistic regression against numpy and against fits."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors

from tallyfit.operators import vector_positions
from tallyfit.plans import logistic_objective, model_weights


@pytest.fixture(scope="module")
def rows(spark):
    pick = np.random.default_rng(1)
    x = pick.standard_normal((200, 5)) * (pick.random((200, 5)) < 0.6)
    y = (pick.random(200) < 1 / (1 + np.exp(-x @ [2, -1, 0, 0.5, 1]))).astype(float)
    x[0] = 0
    df = spark.createDataFrame(
        [(n, float(b), Vectors.dense(a)) for n, (a, b) in enumerate(zip(x, y))],
        ["id", "label", "features"])
    return df, x, y


def evaluated(df, weights, intercept, **settings):
    entries = vector_positions(df, "id", "features")
    return logistic_objective(entries, df.select("id", "label"), weights, intercept, "id",
                              **settings)


def test_equals_numpy(spark, rows):
    df, x, y = rows
    w = np.array([0.3, 0.0, -2.0, 1.0, 0.0])
    table = spark.createDataFrame([(n, float(v)) for n, v in enumerate(w) if v],
                                  "position int, weight double")
    found = evaluated(df, table, 0.7)
    margin = x @ w + 0.7
    chance = 1 / (1 + np.exp(-margin))
    assert found.loss == pytest.approx(-np.mean(y * np.log(chance) + (1 - y) * np.log1p(-chance)))
    gradient = {r.position: r.gradient for r in found.gradient.collect()}
    assert [gradient[n] for n in range(5)] == pytest.approx(x.T @ (chance - y) / len(y))
    assert found.intercept == pytest.approx(np.mean(chance - y)) and found.penalty == 0


@pytest.mark.parametrize("elastic", [0.0, 0.4])
def test_equals_the_history_of_a_fit(spark, rows, elastic):
    df, _, _ = rows
    model = LogisticRegression(regParam=0.02, elasticNetParam=elastic, maxIter=200, tol=1e-12).fit(
        df)
    found = evaluated(df, model_weights(spark, model), model.intercept, reg_param=0.02,
                      elastic_net=elastic)
    assert found.loss == pytest.approx(model.summary.objectiveHistory[-1], abs=1e-9)
    assert found.penalty > 0 and abs(found.intercept) < 1e-5
    # Weights that belong to other features do not give that loss.
    moved = model_weights(spark, model).selectExpr("(position + 1) % 5 AS position", "weight")
    assert evaluated(df, moved, model.intercept).loss > found.loss


def test_gradient_is_zero_at_an_unpenalised_fit(spark, rows):
    df, _, _ = rows
    model = LogisticRegression(maxIter=300, tol=1e-14).fit(df)
    found = evaluated(df, model_weights(spark, model), model.intercept)
    assert max(abs(r.gradient) for r in found.gradient.collect()) < 1e-5


def test_rows_without_entries_or_labels(spark):
    entries = spark.createDataFrame([(1, 0, 2.0), (3, 0, 9.0)], "id int, position int, value double")
    labels = spark.createDataFrame([(1, 1.0), (2, 0.0), (3, None)], "id int, label double")
    none = spark.createDataFrame([], "position int, weight double")
    found = logistic_objective(entries, labels, none, 0.0, "id")
    assert found.loss == pytest.approx(np.log(2))
    assert [r.gradient for r in found.gradient.collect()] == pytest.approx([-0.5])
    with pytest.raises(ValueError, match="no labelled rows"):
        logistic_objective(entries, labels.where("id = 3"), none, 0.0, "id")
