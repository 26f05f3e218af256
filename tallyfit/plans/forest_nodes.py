"""The trees of a forest as a table of nodes, and predictions by walking that table."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import new_folder, write_once


def forest_nodes(spark: SparkSession, model: RandomForestClassificationModel) -> DataFrame:
    """``(tree, node, feature, threshold, categories, left, right, gain, rows, counts,
    prediction)`` for every node of the forest.

    An inner node sends a row to ``left`` if the value of ``feature`` is at most ``threshold``,
    or is one of ``categories`` (the other of the two is null); a leaf has neither feature nor
    children. ``counts`` are rows per class. The model is saved to the shared folder and read
    back as a table, so the trees do not pass through the driver once more.
    """
    path = new_folder(spark, "forest")
    model.write().save(path)
    saved = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    inner = F.col("leftChild") >= 0
    # A split without categories holds one threshold.
    by_threshold = F.col("split.numCategories") < 0
    stored = F.col("split.leftCategoriesOrThreshold")
    return saved.select(
        F.col("treeID").cast("bigint").alias("tree"), F.col("id").cast("bigint").alias("node"),
        F.when(inner, F.col("split.featureIndex")).cast("bigint").alias("feature"),
        F.when(inner & by_threshold, F.get(stored, F.lit(0))).alias("threshold"),
        F.when(inner & ~by_threshold, stored).alias("categories"),
        F.when(inner, F.col("leftChild")).cast("bigint").alias("left"),
        F.when(inner, F.col("rightChild")).cast("bigint").alias("right"),
        F.when(inner, F.col("gain")).alias("gain"),
        F.col("rawCount").cast("bigint").alias("rows"),
        F.col("impurityStats").alias("counts"), "prediction",
    )


def walk_forest(nodes: DataFrame, rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``(key, prediction, votes)`` for every row, by following the node table level by level;
    ``votes`` are the class shares of the leaves reached, added up over the trees.

    ``key`` is unique. A level is one join of ``(row, tree, node)`` with the nodes, whose number
    follows from the model alone; vectors stay sparse.
    """
    parts = rows.select(key, F.unwrap_udt(vector).alias("v"))
    places = F.when(F.col("v.type") == 0, F.col("v.indices")).otherwise(
        F.sequence(F.lit(0), F.size("v.values") - 1))
    entries = parts.select(key, F.map_from_arrays(places, "v.values").alias("entries"))
    trees = [r["tree"] for r in nodes.select("tree").distinct().collect()]
    # Class shares of a leaf, so that small and large leaves weigh the same.
    total = F.aggregate("counts", F.lit(0.0), lambda t, c: t + c)
    nodes = write_once(nodes.withColumn("shares", F.transform("counts", lambda c: c / total))
                       .drop("counts", "prediction", "gain", "rows"), "nodes")
    state = entries.select(key, "entries", F.explode(F.array(*[F.lit(t) for t in sorted(trees)]))
                           .alias("tree"), F.lit(0).cast("bigint").alias("node"))
    done = None
    while True:
        met = write_once(state.join(nodes, ["tree", "node"]), "walk")
        ended = met.where("feature IS NULL").select(key, "shares")
        done = ended if done is None else done.unionByName(ended)
        value = F.coalesce(F.element_at("entries", F.col("feature").cast("int")), F.lit(0.0))
        goes_left = F.coalesce(value <= F.col("threshold"),
                               F.array_contains("categories", value))
        state = met.where("feature IS NOT NULL").select(
            key, "entries", "tree", F.when(goes_left, F.col("left")).otherwise(F.col("right"))
            .alias("node"))
        if not state.take(1):
            break
    classes = len(done.first()["shares"]) if done.take(1) else 0
    votes = done.groupBy(key).agg(
        F.array(*[F.sum(F.col("shares")[c]) for c in range(classes)]).alias("votes"))
    best = F.array_position("votes", F.array_max("votes")) - 1
    return votes.select(key, best.cast("double").alias("prediction"), "votes")
