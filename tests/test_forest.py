"""Choice of terms, bounded vector indexing, and forests as node tables."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorIndexer
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tallyfit import limits
from tallyfit.operators import best_features, chi_squared, few_values, fit_vector_indexer
from tallyfit.plans import fit_text_forest, forest_nodes, forest_summary, walk_forest
from tallyfit.plans.fit_size import BIN_BYTES, POINT_BYTES, bound_partitions
from tallyfit.plans.wide_forest import fit_wide_forest


def test_chi_squared_equals_the_full_table(spark):
    pick = random.Random(1)
    labels = [pick.choice(["a", "b", "c", None]) for _ in range(300)]
    held = [{f for f in range(30) if pick.random() < (0.9 if f == 3 and y == "a" else 0.2)}
            | {99} for y in labels]
    entries = spark.createDataFrame(
        [(f, y) for own, y in zip(held, labels) for f in own], "f int, y string")
    scored = chi_squared(entries, spark.createDataFrame([(y,) for y in labels], "y string"),
                         "f", "y")
    found = {r.f: (r.rows, r.chi_squared) for r in scored.collect()}
    known = [(own, y) for own, y in zip(held, labels) if y is not None]
    for f in [*range(30), 99]:
        table = np.array([[sum((f in own) == has and y == c for own, y in known)
                           for c in "abc"] for has in (True, False)], float)
        expected = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
        with np.errstate(invalid="ignore"):
            parts = np.where(expected > 0, (table - expected) ** 2 / expected, 0)
        assert found[f] == (int(table[0].sum()), pytest.approx(parts.sum(), abs=1e-9))
    best = [r.f for r in best_features(scored, "f", 5).collect()]
    assert best == sorted(found, key=lambda f: (-found[f][1], f))[:5] and best[0] == 3


def vectors(spark, pick, partitions):
    rows = []
    for n in range(300):
        dense = [n % 3, n % 4, n % 5, pick.random(), 0.0, -1.0, n % 2 - 0.5]
        if n % 2:
            rows.append((Vectors.dense(dense + [0.0] * 2993),))
        else:
            places = {i: v for i, v in enumerate(dense) if v}
            places.update({100 + n % 7: 1.0, 200: float(n % 11), 2999: 5.0 if n < 4 else 0.0})
            rows.append((Vectors.sparse(3000, places),))
    return spark.createDataFrame(rows, ["features"]).repartition(partitions)


@pytest.mark.parametrize("partitions", [1, 20])
def test_vector_indexer_equals_the_plain_fit(spark, partitions):
    rows = vectors(spark, random.Random(2), partitions)
    plain = VectorIndexer(inputCol="features", outputCol="indexed", maxCategories=4,
                          handleInvalid="keep").fit(rows)
    bounded = fit_vector_indexer(rows, "features", "indexed", 4)
    assert bounded.numFeatures == plain.numFeatures == 3000
    assert {int(d): dict(v) for d, v in bounded.categoryMaps.items()} == {
        int(d): dict(v) for d, v in plain.categoryMaps.items()}
    first = rows.limit(5)
    assert bounded.transform(first).collect() == plain.transform(first).collect()


def test_few_values_hand_on_few_rows(spark):
    rows = vectors(spark, random.Random(3), 20)
    found = {r.position: r.categories for r in few_values(rows, "features", 4).collect()}
    assert found[-1] == [3000.0] and found[0] == [0.0, 1.0, 2.0] and found[2] is None
    assert found[3] is None and found[5] == [-1.0] and found[6] == [-0.5, 0.5]
    assert found[200] is None and found[2999] == [0.0, 5.0] and 150 not in found
    empty = few_values(rows.limit(0), "features", 4)
    assert [r.categories for r in empty.collect() if r.position >= 0] == []
    with pytest.raises(ValueError, match="no vectors"):
        fit_vector_indexer(rows.limit(0), "features", "indexed", 4)


def test_walks_equal_predictions(spark):
    pick = random.Random(4)
    rows = spark.createDataFrame(
        [(n, float(pick.choice([0, 1, 2])),
          Vectors.dense([pick.choice([0, 1, 2]), pick.random(), n % 9, pick.choice([-1, 1])]))
         for n in range(400)], ["id", "label", "features"])
    indexed = fit_vector_indexer(rows, "features", "indexed", 4).transform(rows)
    model = RandomForestClassifier(featuresCol="indexed", numTrees=7, maxDepth=4, seed=3).fit(
        indexed)
    nodes = forest_nodes(spark, model)
    table = nodes.collect()
    assert len(table) == model.totalNumNodes
    assert any(r.categories for r in table) and any(r.threshold is not None for r in table)
    for r in table:
        assert (r.feature is None) == (r.left is None) == (r.gain is None)
        assert r.prediction == float(np.argmax(r.counts))
    walked = {r.id: r for r in walk_forest(nodes, indexed, "id", "indexed").collect()}
    for r in model.transform(indexed).collect():
        assert walked[r.id].prediction == r.prediction
        assert walked[r.id].votes == pytest.approx(list(r.rawPrediction))


def test_forest_keeps_the_telling_terms(spark):
    pick = random.Random(5)
    rows = [(" ".join(pick.choice("abcdefghij") * 3 for _ in range(8))
             + (" signal" if n % 4 == 0 else ""), float(n % 4 == 0)) for n in range(200)]
    train = spark.createDataFrame(rows, "text string, label double")
    model = fit_text_forest(train, terms=3)
    assert model.stages[0:1] and len(model.stages[-5].getIndices()) == 3
    assert model.stages[-2].numFeatures == 3
    wrong = model.transform(train).where("prediction <> indexedLabel").count()
    assert wrong == 0
    model = fit_text_forest(train.limit(0).unionByName(train.limit(1)).withColumn(
        "text", train["text"].substr(0, 0)), terms=3)
    assert model.stages[-2].getNumTrees == 20


def partition_sizes(df):
    return [len(p) for p in df.rdd.glom().collect()]


def test_long_partitions_are_dealt_out(spark, monkeypatch):
    # One long partition beside short ones: the longest counts, not the average.
    df = spark.range(1000, numPartitions=1).union(spark.range(1000, 1030, numPartitions=3))
    df = df.withColumn("twin", F.when(F.col("id") % 3 > 0, F.lit(None).cast("long")))
    monkeypatch.setattr(limits, "TASK_BYTES", 1000 * (50 * BIN_BYTES + POINT_BYTES))
    assert bound_partitions(df, 50) is df
    assert bound_partitions(df.limit(0), 50).count() == 0
    monkeypatch.setattr(limits, "TASK_BYTES", 300 * (50 * BIN_BYTES + POINT_BYTES))
    dealt = bound_partitions(df, 50)
    sizes = partition_sizes(dealt)
    assert sum(sizes) == 1030 and len(sizes) == 4 and max(sizes) <= 300
    assert sorted(r.id for r in dealt.collect()) == list(range(1030))
    monkeypatch.setattr(limits, "TASK_BYTES", 1)
    assert bound_partitions(df.limit(5), 50).count() == 5


def test_forest_tasks_hold_few_rows(spark, monkeypatch):
    seen = []

    def fit(forest, df, plain=RandomForestClassifier.fit):
        seen.append(partition_sizes(df.select("indexedFeatures")))
        return plain(forest, df)

    monkeypatch.setattr(RandomForestClassifier, "fit", fit)
    rows = [("a b c" if n % 2 else "a d", float(n % 2)) for n in range(400)]
    train = spark.createDataFrame(rows, "text string, label double").coalesce(1)
    whole = fit_text_forest(train, terms=4)
    monkeypatch.setattr(limits, "TASK_BYTES", 50 * (4 * BIN_BYTES + POINT_BYTES), raising=False)
    dealt = fit_text_forest(train, terms=4)
    assert seen[0] == [400] and sum(seen[1]) == 400 and len(seen[1]) == 8 and max(seen[1]) <= 51
    for model in (whole, dealt):
        assert model.transform(train).where("prediction <> indexedLabel").count() == 0


def test_forest_draws_from_all_terms(spark):
    pick = random.Random(6)
    rows = [(" ".join(f"w{pick.randrange(9000)}" for _ in range(60)), float(n % 3 == 0))
            for n in range(300)]
    train = spark.createDataFrame(rows + [(None, 1.0), ("", 0.0)], "text string, label double")
    model = fit_text_forest(train)
    assert model.stages[-2].numFeatures == 1 << 18 and model.stages[-2].getNumTrees == 20
    terms = {r.feature for r in forest_nodes(spark, model.stages[-2]).collect()} - {None}
    assert len(terms) > 100 and max(terms) > 1 << 17
    summary = forest_summary(spark, model.stages[-2]).collect()
    assert [r.tree for r in summary] == list(range(20))
    assert all("numFeatures=262144" in r.description for r in summary)
    other = spark.createDataFrame([(n, t) for n, t in enumerate(
        ["new words", "w1 w1 w1 w1 w1 w2", "", None])], "id long, text string")
    texts = train.select("text").rdd.zipWithIndex().map(lambda r: (r[1] + 9, r[0].text))
    other = other.union(spark.createDataFrame(texts, "id long, text string"))
    scored = model.transform(other)
    walked = walk_forest(forest_nodes(spark, model.stages[-2]), scored, "id", "indexedFeatures")
    found = {r.id: r.prediction for r in walked.collect()}
    assert found == {r.id: r.prediction for r in scored.select("id", "prediction").collect()}
    assert len(found) == 306


def wide_rows(spark, rows, copies=1):
    pick = random.Random(7)
    table = []
    for n in range(rows):
        dense = [pick.choice([0, 0, 2]), pick.choice([0, 1, 3, 7]), pick.randrange(20) / 4,
                 pick.choice([-1, 1]), pick.randrange(-3, 9), 0.0, pick.choice([0, 0, 0, 5.5])]
        told = dense[2] + (dense[1] in (0, 3)) * 3 + dense[4] / 4 + pick.random()
        place = {i: float(v) for i, v in enumerate(dense) if v}
        table.append((float(told > 3) + (told > 5.5),
                      Vectors.dense(dense) if n % 2 else Vectors.sparse(7, place)))
    return spark.createDataFrame(table * copies, ["label", "features"])


def test_wide_forest_equals_the_library(spark):
    rows = wide_rows(spark, 700)
    tree = RandomForestClassifier(featuresCol="indexed", numTrees=1, maxDepth=4, seed=3,
                                  bootstrap=False, featureSubsetStrategy="all")
    plain = fit_vector_indexer(rows, "features", "indexed", 4)
    plain = tree.fit(plain.transform(rows))
    indexer, wide = fit_wide_forest(tree, rows, "features", 3, 4)
    assert wide.numFeatures == 7 and wide.numClasses == 3

    def nodes(model):
        return [(r.node, r.feature, r.left, r.right, r.rows, list(r.counts), r.prediction,
                 r.gain and round(r.gain, 12))
                for r in forest_nodes(spark, model).orderBy("node").collect()]

    assert nodes(wide) == nodes(plain) and len(nodes(wide)) > 20
    splits = forest_nodes(spark, wide).collect()
    assert any(r.categories for r in splits) and any(r.threshold is not None for r in splits)
    other = spark.createDataFrame(  # a category that the fit has not seen goes right
        [(n, Vectors.dense([9.0, v, 1.5, 9.0, 2.0, 0.0, 9.0])) for n, v in enumerate([1.0, 9.0])],
        ["id", "features"])
    scored = wide.transform(indexer.transform(other))
    walked = walk_forest(forest_nodes(spark, wide), scored, "id", "indexed").collect()
    assert {r.id: r.prediction for r in walked} == {r.id: r.prediction for r in scored.collect()}


def test_wide_forests_do_not_depend_on_the_layout(spark):
    rows = wide_rows(spark, 200, copies=5)
    forest = RandomForestClassifier(featuresCol="indexed", numTrees=6, seed=4)
    found = []
    for part in (rows.coalesce(1), rows.orderBy(F.rand(1)).repartition(7)):
        indexer, model = fit_wide_forest(forest, part, "features", 3, 4)
        found.append([t.toDebugString.split("\n", 1)[1] for t in model.trees])
        right = model.transform(indexer.transform(part)).where("label = prediction").count()
        assert right > 700
    assert found[0] == found[1] and len(set(found[0])) == 6
    roots = [r.rows for r in forest_nodes(spark, model).where("node = 0").collect()]
    assert all(850 < n < 1150 for n in roots) and len(set(roots)) > 1
    with pytest.raises(ValueError, match="no vectors"):
        fit_wide_forest(forest, rows.limit(0), "features", 3, 4)
