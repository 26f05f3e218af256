"""Linear grids from moments, and cross-validation from one text pass, against separate fits."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import IDF, HashingTF, Tokenizer
from pyspark.ml import Pipeline
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from tallyfit.fixed_values import BALANCED_LOGISTIC
from tallyfit.operators import fold_by_key
from tallyfit.plans import (
    house_prices,
    linear_grid,
    out_of_fold,
    part_moments,
    solve_linear,
    squared_error,
    tune_linear,
    tune_text_logistic,
)

WIDTH = 7


def _table(spark, n=400, seed=1):
    """Numbers with large means, categories that add up to one, a column that never changes."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        group = int(rng.integers(3))
        x = np.array([5000 + rng.normal(), rng.normal(), *(np.arange(3) == group), 4.0,
                      rng.normal() * 1e-3])
        y = 300 + 2 * x[0] - x[1] + 3 * group + rng.normal()
        full = Vectors.dense(x)
        kept = np.flatnonzero(x)
        sparse = Vectors.sparse(WIDTH, kept.tolist(), x[kept].tolist())
        rows.append((i, full if i % 2 else sparse, float(y)))
    return spark.createDataFrame(rows, ["id", "features", "label"]).repartition(5)


GRID = {"regParam": [0.0, 0.02, 0.5], "fitIntercept": [True, False],
        "elasticNetParam": [0.0, 0.3, 1.0]}


def test_moments_are_those_of_the_rows(spark, monkeypatch):
    monkeypatch.setattr(linear_grid, "_SLICE_BYTES", 8 * 9 * 11)
    rows = _table(spark)
    parts = part_moments(rows, F.col("id") % 3)
    assert sorted(parts) == [0, 1, 2]
    local = rows.collect()
    for n, found in parts.items():
        z = np.array([[1, *r.features.toArray(), r.label] for r in local if r.id % 3 == n])
        z = z - found.origin
        assert np.allclose(found.matrix, z.T @ z, rtol=1e-9, atol=1e-7)
    assert part_moments(rows.limit(0), F.lit(0)) == {}


def test_every_combination_equals_its_own_fit(spark):
    rows = _table(spark).cache()
    moments = part_moments(rows, F.lit(0))[0]
    local = rows.collect()
    x = np.array([r.features.toArray() for r in local])
    y = np.array([r.label for r in local])
    for settings in linear_grid.combinations_of(GRID):
        got = solve_linear(moments, **settings)
        plain = LinearRegression(maxIter=2000, tol=1e-13, **settings).fit(rows)
        predicted = x @ got.coefficients + got.intercept
        expected = x @ plain.coefficients.toArray() + plain.intercept
        assert np.allclose(predicted, expected, atol=2e-3), settings
        error = ((y - predicted) ** 2).sum()
        assert squared_error(moments, got) == pytest.approx(error, rel=1e-6)
        assert got.coefficients[5] == 0
    shown = rows.select(
        "id", got.prediction().alias("p")).toPandas().set_index("id").p
    assert np.allclose([shown[r.id] for r in local], predicted)


def test_weights_meet_the_conditions_of_an_optimum():
    rng = np.random.default_rng(3)
    for first, second, d in [(0.2, 0.0, 6), (0.05, 0.01, 30), (0.0, 0.3, 12), (2.0, 0.1, 5)]:
        a = rng.normal(size=(200, d)) @ rng.normal(size=(d, d))
        a[:, -1] = a[:, 0]
        q, c = a.T @ a / 200, a.T @ rng.normal(size=200) / 20
        w = linear_grid._elastic_net(q, c, first, second)
        slope = q @ w + second * w - c
        assert (np.abs(slope) <= first + 1e-6).all()
        assert np.allclose(slope[w != 0], -first * np.sign(w[w != 0]), atol=1e-6)


def test_tuning_measures_on_the_other_part(spark):
    rows = _table(spark).cache()
    held_out = F.col("id") % 5 == 0
    tuned = tune_linear(rows, held_out, GRID)
    assert len(tuned.metrics) == 18 == len(tuned.combinations)
    best = int(np.argmin(tuned.metrics))
    plain = LinearRegression(maxIter=2000, tol=1e-13, **tuned.combinations[best])
    scored = plain.fit(rows.where(~held_out)).transform(rows.where(held_out))
    error = scored.select(F.sqrt(F.avg((F.col("prediction") - F.col("label")) ** 2))).first()[0]
    assert tuned.metrics[best] == pytest.approx(error, rel=1e-5)
    whole = plain.fit(rows).transform(rows).select("id", F.col("prediction").alias("whole"))
    both = tuned.transform(rows).join(whole, "id")
    assert both.where("abs(prediction - whole) > 0.002").count() == 0
    for part in (F.lit(False), F.lit(True)):
        with pytest.raises(ValueError, match="rows to fit"):
            tune_linear(rows, part, GRID)


def test_a_label_that_never_changes(spark):
    rows = _table(spark, 50).withColumn("label", F.lit(7.0))
    moments = part_moments(rows, F.lit(0))[0]
    flat = solve_linear(moments, 0.1, 0.5, True)
    assert flat.intercept == pytest.approx(7.0) and not flat.coefficients.any()
    through_zero = solve_linear(moments, 0.0, 0.0, False)
    assert squared_error(moments, through_zero) / 50 < 49


def test_wide_rows_are_fitted_one_by_one(spark, monkeypatch):
    rows = spark.createDataFrame([
        (i, "a" if i % 2 else "b", float(i % 7), 3.0 * (i % 7) + (i % 2) + 10) for i in range(150)
    ], ["Id", "kind", "size", "SalePrice"])
    few = house_prices.fit_house_prices(rows, categories=["kind"])
    monkeypatch.setattr(house_prices, "GRAM_WIDTH", 0)
    wide = house_prices.fit_house_prices(rows, categories=["kind"])
    assert [c["fitIntercept"] for c in wide.tuned.combinations] == [True, False]
    assert few.tuned.combinations == wide.tuned.combinations
    assert few.tuned.metrics[0] == pytest.approx(wide.tuned.metrics[0], abs=0.1)


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.range(240).withColumn("label", (F.col("id") % 3 == 0).cast("double"))
    word = F.when((F.col("label") == 1) & (F.col("id") % 5 > 0), "awful").otherwise("lovely")
    return rows.withColumn(
        "text", F.concat(word, F.lit(" the word"), (F.col("id") % 13).cast("string")))


def test_folds_equal_a_cross_validator_that_hashes_anew(texts):
    grid = {"num_features": [8, 50], "reg_params": [0.1, 0.01]}
    tuned = tune_text_logistic(texts, "id", folds=3, settings=BALANCED_LOGISTIC, **grid)
    hashing = HashingTF(inputCol="words", outputCol="raw")
    logistic = LogisticRegression(**BALANCED_LOGISTIC)
    params = (ParamGridBuilder().addGrid(hashing.numFeatures, [8, 50])
              .addGrid(logistic.regParam, [0.1, 0.01]).build())
    stages = [Tokenizer(inputCol="text", outputCol="words"), hashing,
              IDF(inputCol="raw", outputCol="features"), logistic]
    plain = CrossValidator(
        estimator=Pipeline(stages=stages), estimatorParamMaps=params, numFolds=3,
        foldCol="fold", evaluator=BinaryClassificationEvaluator(),
    ).fit(fold_by_key(texts, "id", 3))
    assert tuned.metrics == pytest.approx(plain.avgMetrics, abs=1e-6)
    expected = {r.id: r.probability for r in plain.transform(texts).collect()}
    for r in tuned.transform(texts).collect():
        assert np.allclose(r.probability.toArray(), expected[r.id].toArray(), atol=1e-6)


def test_each_row_is_scored_by_a_model_that_did_not_see_it(spark, texts):
    tuned = tune_text_logistic(texts, "id", num_features=[64], reg_params=[0.01], folds=3,
                               settings=BALANCED_LOGISTIC)
    rows = out_of_fold(tuned)
    assert rows.columns == ["id", "label", "fold", "rawPrediction", "probability", "prediction"]
    assert rows.count() == 240 == rows.select("id").distinct().count()
    folds = fold_by_key(texts, "id", 3).select("id", F.col("fold").alias("wanted"))
    assert rows.join(folds, "id").where("fold <> wanted").count() == 0
    # The label of a held-out row does not change what is said of it.
    turned = texts.withColumn(
        "label", F.when(F.col("id") == 6, 1 - F.col("label")).otherwise(F.col("label")))
    other = tune_text_logistic(turned, "id", num_features=[64], reg_params=[0.01], folds=3,
                               settings=BALANCED_LOGISTIC)
    a, b = [t.where("id = 6").first().probability.toArray() for t in (rows, out_of_fold(other))]
    assert np.allclose(a, b, atol=1e-9)
    with pytest.raises(ValueError, match="each of several folds"):
        tune_text_logistic(texts.limit(1), "id", num_features=[8], folds=2)
