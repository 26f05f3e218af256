"""Model plans from end to end on small tables."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyfit.fixed_values import BALANCED_LOGISTIC, HOUSE_CATEGORIES, SPARSE_LOGISTIC
from tallyfit.operators import CategoryIndex, split_by_key
from tallyfit.plans import (
    coefficients,
    fit_component_logistic,
    fit_house_prices,
    fit_text_forest,
    fit_text_logistic,
    forest_summary,
    house_columns,
    loss_history,
    predict_house_prices,
    project_components,
    tune_text_logistic,
    tuning_results,
)
from tallyfit.plans.vector_classification import with_vector
from tallyfit.sources import literal_table, new_folder, read_csv, write_csv


@pytest.fixture(scope="module")
def questions(spark):
    """Texts that hold a telling word exactly where the label is 1; one text is missing."""
    word = F.when(F.col("label") == 1, "awful").otherwise("lovely")
    rows = spark.range(300).withColumn("label", (F.col("id") % 4 == 0).cast("double"))
    noise = F.concat(F.lit(" the word"), (F.col("id") % 11).cast("string"), F.lit("? "))
    return rows.withColumn(
        "text", F.when(F.col("id") == 5, None).otherwise(F.concat(word, noise))
    ).select("id", "text", "label")


def test_balanced_regression_learns(spark, questions):
    train, rest = split_by_key(questions, "id", 80)
    model = fit_text_logistic(train, num_features=1 << 10, settings=BALANCED_LOGISTIC)
    scored = model.transform(rest)
    assert scored.where("label <> prediction").count() <= 1
    losses = [r.loss for r in loss_history(spark, model.stages[-1]).orderBy("iteration").collect()]
    assert losses == sorted(losses, reverse=True) and len(losses) > 2


def test_coefficients_give_back_the_margin(spark, questions):
    model = fit_text_logistic(questions, num_features=1 << 8, settings=BALANCED_LOGISTIC)
    table = coefficients(spark, model.stages[-1]).toPandas()
    assert len(table) == 1 + (1 << 8)
    weights = table.sort_values("feature")["value"].to_numpy()
    scored = model.transform(questions).select(
        vector_to_array("features").alias("x"), vector_to_array("rawPrediction").alias("m"))
    for row in scored.collect():
        assert weights[0] + np.dot(weights[1:], row.x) == pytest.approx(row.m[1])


def test_training_text_and_new_text_pass_the_same_stages(spark, questions):
    model = fit_text_logistic(questions, num_features=1 << 10)
    rows = [(1, "THE lovely, word1?"), (2, "lovely word1")]
    new = literal_table(spark, rows, "id int, text string")
    a, b = [r.features for r in model.transform(new).orderBy("id").collect()]
    assert a == b


def test_sparse_regression_keeps_no_weight_on_noise(spark):
    rows = spark.range(400).select(
        F.concat(F.lit("w"), F.pmod(F.xxhash64("id"), F.lit(50)).cast("string")).alias("text"),
        (F.col("id") % 10 == 0).cast("double").alias("label"))
    model = fit_text_logistic(rows, num_features=1 << 10, settings=SPARSE_LOGISTIC).stages[-1]
    assert model.coefficients.numNonzeros() == 0
    assert model.intercept == pytest.approx(np.log(40 / 360), abs=1e-3)


def test_forest_names_its_predictions(spark, questions):
    train, rest = split_by_key(questions, "id", 80)
    model = fit_text_forest(train, num_features=1 << 6)
    rows = model.transform(rest).select("label", "predictedLabel").collect()
    assert {r.predictedLabel for r in rows} == {"0.0", "1.0"}
    assert sum(str(r.label) != r.predictedLabel for r in rows) <= 2
    trees = forest_summary(spark, model.stages[-2]).collect()
    assert len(trees) == 20 and all("Predict" in t.description for t in trees)


def test_forest_is_the_same_for_any_layout(questions):
    def predict(rows):
        model = fit_text_forest(rows, num_features=1 << 6)
        return sorted((r.id, r.prediction) for r in model.transform(questions).collect())

    assert predict(questions) == predict(questions)


def test_fits_with_many_partitions_stay_within_the_driver(spark, questions, monkeypatch):
    from tallyfit import limits
    from tallyfit.plans.fit_size import merge_partitions, tree_depth

    table = spark.range(100).repartition(64)
    assert tree_depth(table, 1) == 2
    assert merge_partitions(table, 1).rdd.getNumPartitions() == 64
    monkeypatch.setattr(limits, "DRIVER_BYTES", 4000)
    assert tree_depth(table, 1000) == 3
    assert merge_partitions(table, 1000).rdd.getNumPartitions() == 16
    assert merge_partitions(table, 1000, depth=1).rdd.getNumPartitions() == 4
    assert merge_partitions(table, 5000).rdd.getNumPartitions() == 1
    small = fit_text_logistic(questions, num_features=1 << 8, settings=BALANCED_LOGISTIC)
    monkeypatch.setattr(limits, "DRIVER_BYTES", 1 << 40)
    large = fit_text_logistic(questions, num_features=1 << 8, settings=BALANCED_LOGISTIC)
    assert np.allclose(small.stages[-1].coefficients.toArray(),
                       large.stages[-1].coefficients.toArray())


def test_cross_validation_tries_the_whole_grid(spark, questions):
    model = tune_text_logistic(questions, "id", num_features=[8, 64], reg_params=[0.1, 0.01])
    table = tuning_results(spark, model)
    assert table.count() == 8
    metrics = {r.combination: r.metric for r in table.collect()}
    assert len(metrics) == 4 and all(0 <= m <= 1 for m in metrics.values())
    assert max(metrics.values()) > 0.9


def _house(i, with_price):
    row = {c: ("v%d" % (i % 3)) for c in HOUSE_CATEGORIES}
    for n, c in enumerate(["OverallQual", "OverallCond", "YearBuilt", "YearRemodAdd", "MoSold",
                           "YrSold"]):
        row[c] = 1 + (i + n) % 4
    row.update(Id=i, GrLivArea=1000 + 13 * (i % 97), LotArea=5000 + 7 * (i % 31),
               Electrical="SBrkr", Alley="NA" if i % 2 else "Pave",
               MasVnrType="NA" if with_price and i % 5 == 0 else "None")
    if with_price:
        row["SalePrice"] = 100000 + 50 * row["GrLivArea"] + 9000 * row["OverallQual"]
        if i == 7:
            row["GrLivArea"] = 5000
    if not with_price and i % 10 == 0:
        row["Street"] = "unseen"
    return row


def test_house_prices_from_csv_to_csv(spark):
    folder = new_folder(spark, "houses")
    train = spark.createDataFrame([_house(i, True) for i in range(200)])
    test = spark.createDataFrame([_house(i, False) for i in range(200, 260)])
    write_csv(train, folder + "/train")
    write_csv(test, folder + "/test")
    train, test = read_csv(spark, folder + "/train"), read_csv(spark, folder + "/test")
    train, test = house_columns(train, test)
    assert train.where("Id = 7").count() == 0 and train.count() == 199
    assert {"Alley", "Electrical"}.isdisjoint(train.columns) and "Alley" not in test.columns
    assert "MasVnrType" in train.columns  # missing in the training rows only
    model = fit_house_prices(train)
    assert set(model.numbers) == {"GrLivArea", "LotArea"}
    predicted = predict_house_prices(model, test)
    assert predicted.columns == ["Id", "SalePrice"]
    write_csv(predicted, folder + "/out")
    written = read_csv(spark, folder + "/out", "Id int, SalePrice double")
    joined = written.join(test.select("Id", "GrLivArea", "OverallQual"), "Id")
    assert joined.count() == 60
    for r in joined.collect():
        assert r.SalePrice == pytest.approx(
            100000 + 50 * r.GrLivArea + 9000 * r.OverallQual, rel=0.05)
    results = tuning_results(spark, model.tuned)
    assert results.where("parameter = 'fitIntercept'").count() == 2


def test_rows_without_a_price_teach_nothing(spark):
    rows = [_house(i, True) for i in range(160)]
    for row in rows[::2]:
        row["SalePrice"] = None
    rows = spark.createDataFrame(rows)
    priced = fit_house_prices(rows.where("SalePrice is not null"))
    model = fit_house_prices(rows.repartition(5))
    assert model.tuned.metrics == pytest.approx(priced.tuned.metrics, rel=1e-6)
    assert predict_house_prices(model, rows).where("SalePrice < 50000").count() == 0
    with pytest.raises(ValueError, match="SalePrice"):
        fit_house_prices(rows.where("SalePrice is null"))


def test_wide_categories_take_the_joined_way(spark, monkeypatch):
    from tallyfit import limits

    rows = spark.createDataFrame([_house(i, True) for i in range(120)])
    monkeypatch.setattr(limits, "DRIVER_LABELS", 3)
    model = fit_house_prices(rows, categories=["Street", "OverallQual"])
    assert isinstance(model.index, CategoryIndex) and "OverallQual" in model.index.large
    assert predict_house_prices(model, rows).count() == 120


def test_components_against_numpy(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    vectors = with_vector(table, "embedding")
    model = project_components(vectors, "features", 3)
    data = np.array([r.embedding for r in table.select("embedding").collect()], dtype=float)
    _, _, axes = np.linalg.svd(data - data.mean(axis=0), full_matrices=False)
    assert np.allclose(np.abs(model.pc.toArray().T), np.abs(axes[:3]), atol=1e-6)


def test_component_regression_has_three_features(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    vectors = with_vector(table, "embedding")
    model = fit_component_logistic(vectors)
    assert model.stages[-1].numFeatures == 3
    assert model.transform(vectors).select("prediction").distinct().count() >= 1
