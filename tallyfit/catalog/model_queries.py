"""Models: fitted on the training part, reported on the held-out part."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import (
    BALANCED_LOGISTIC,
    LINEAR_GRID,
    SPARSE_LOGISTIC,
    TABULAR_SEED,
    TEXT_FOLDS,
    TEXT_GRID_FEATURES,
    TEXT_SEED,
)
from ..functions import with_tokens
from ..operators import (
    CategoryIndex,
    best_features,
    chi_squared,
    confusion_matrix,
    per_label_metrics,
    sample_by_key,
    split_by_key,
    vector_positions,
    weighted_metrics,
)
from ..plans import (
    coefficients,
    fit_component_logistic,
    fit_house_prices,
    fit_text_forest,
    fit_text_logistic,
    forest_nodes,
    forest_summary,
    house_columns,
    logistic_objective,
    loss_history,
    model_weights,
    out_of_fold,
    predict_house_prices,
    tune_text_logistic,
    tuning_results,
    walk_forest,
)
from ..plans.vector_classification import with_vector
from ..sources import load, spread, text_set, write_once
from .registry import query, sql_hash, sql_percent
from .text_queries import TOKENS_SQL

_TEXT = f"""WITH t AS (SELECT doc_id, toxic, {sql_percent('doc_id')} AS bucket
                       FROM documents JOIN labels USING (doc_id))"""


def text_parts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return split_by_key(text_set(spark, folder, heavy=True), "doc_id", 80)


# With the sparse setting no weight leaves zero, so the intercept is the log odds of the
# classes and the more frequent class is predicted everywhere: SQL can state both.


@query(
    "logreg_model",
    f"""{_TEXT} SELECT 0::bigint AS nonzero_weights,
                       round(ln(sum(toxic) / sum(1 - toxic)), 4) AS intercept
                FROM t WHERE bucket < 80""",
)
def logreg_model(spark: SparkSession, folder: str) -> DataFrame:
    train, _ = text_parts(spark, folder)
    model = fit_text_logistic(train, settings=SPARSE_LOGISTIC).stages[-1]
    rows = [(int(model.coefficients.numNonzeros()), round(model.intercept, 4))]
    return spark.createDataFrame(rows, "nonzero_weights bigint, intercept double")


@query(
    "logreg_predict",
    f"""{_TEXT} SELECT doc_id, toxic::double AS label,
                       (SELECT (2 * sum(toxic) > count(*))::int::double FROM t WHERE bucket < 80)
                       AS prediction
                FROM t WHERE bucket >= 80""",
)
def logreg_predict(spark: SparkSession, folder: str) -> DataFrame:
    train, rest = text_parts(spark, folder)
    model = fit_text_logistic(train, settings=SPARSE_LOGISTIC)
    return model.transform(rest).select("doc_id", "label", "prediction")


@query(
    "logreg_sampled_predict",
    f"""{_TEXT} SELECT d.doc_id, (SELECT (2 * sum(toxic) > count(*))::int::double
                                  FROM t WHERE bucket < 25) AS prediction
                FROM documents d ANTI JOIN labels l ON d.doc_id = l.doc_id""",
)
def logreg_sampled_predict(spark: SparkSession, folder: str) -> DataFrame:
    """Learn from a quarter of the labelled texts, as they are, and predict for the others."""
    labelled = text_set(spark, folder, heavy=True)
    sample = sample_by_key(labelled, "doc_id", 25)
    model = fit_text_logistic(sample, clean=False, settings=SPARSE_LOGISTIC)
    documents = spread(load(spark, folder, "documents").select("doc_id", "text"))
    labels = load(spark, folder, "labels").select("doc_id")
    others = documents.join(labels, "doc_id", "left_anti")
    return model.transform(others).select("doc_id", "prediction")


@query(
    "text_holdout_confusion",
    f"""{_TEXT} SELECT toxic::double AS label, 0.0::double AS prediction, count(*) AS rows
                FROM t WHERE bucket >= 80 GROUP BY toxic""",
)
def text_holdout_confusion(spark: SparkSession, folder: str) -> DataFrame:
    return confusion_matrix(logreg_predict(spark, folder))


@query(
    "logreg_holdout_metrics",
    f"""{_TEXT},
        c AS (SELECT toxic::double AS label, count(*) AS rows, sum(count(*)) OVER () AS total
              FROM t WHERE bucket >= 80 GROUP BY toxic)
        SELECT label, rows, total::bigint AS total,
               CASE WHEN label = 0 THEN 1.0 ELSE 0.0 END::double AS fpr,
               CASE WHEN label = 0 THEN 1.0 ELSE 0.0 END::double AS tpr,
               CASE WHEN label = 0 THEN round(rows / total, 9) ELSE 0.0 END::double AS precision,
               CASE WHEN label = 0 THEN 1.0 ELSE 0.0 END::double AS recall,
               CASE WHEN label = 0 THEN round(2 * rows / (rows + total), 9) ELSE 0.0 END::double
                   AS f_measure FROM c""",
)
def logreg_holdout_metrics(spark: SparkSession, folder: str) -> DataFrame:
    metrics = per_label_metrics(logreg_predict(spark, folder))
    return metrics.withColumns(
        {m: F.round(m, 9) for m in ("fpr", "tpr", "precision", "recall", "f_measure")}
    )


@query(
    "logreg_training_metrics",
    f"""{_TEXT},
        s AS (SELECT sum(1 - toxic) / count(*) AS share FROM t WHERE bucket < 80)
        SELECT round(share, 9) AS accuracy, round(share, 9) AS fpr, round(share, 9) AS tpr,
               round(2 * share * share / (1 + share), 9) AS f_measure,
               round(share * share, 9) AS precision, round(share, 9) AS recall FROM s""",
)
def logreg_training_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics on the rows the model was fitted on, which say nothing about new text."""
    train, _ = text_parts(spark, folder)
    model = fit_text_logistic(train, settings=SPARSE_LOGISTIC)
    metrics = weighted_metrics(model.transform(train).select("label", "prediction"))
    return metrics.withColumns({m: F.round(m, 9) for m in metrics.columns})


@query("logreg_coefficients")
def logreg_coefficients(spark: SparkSession, folder: str) -> DataFrame:
    train, _ = text_parts(spark, folder)
    model = fit_text_logistic(train, settings=BALANCED_LOGISTIC)
    return coefficients(spark, model.stages[-1])


@query("loss_history")
def logreg_losses(spark: SparkSession, folder: str) -> DataFrame:
    train, _ = text_parts(spark, folder)
    model = fit_text_logistic(train, settings=BALANCED_LOGISTIC)
    return loss_history(spark, model.stages[-1])


# Without a penalty a fit on group indicators predicts each group's share of positives. A
# fit starts with no weights, where its loss is the entropy of the labels.

_GROUP = "CASE WHEN lang IN ('en', 'de') THEN lang ELSE 'other' END"


@query(
    "logreg_groups",
    f"""WITH g AS (SELECT {_GROUP} AS lang, count(*) AS rows, sum(toxic) AS yes
                   FROM documents JOIN labels USING (doc_id) GROUP BY 1)
        SELECT lang, rows, round(yes / rows, 5) AS probability,
               round(ln(yes / (rows - yes)) - ln((SELECT yes / (rows - yes) FROM g
                                                  WHERE lang = 'other')), 3) AS coefficient,
               ((2 * yes > rows)::int)::double AS prediction FROM g""",
)
def logreg_groups(spark: SparkSession, folder: str) -> DataFrame:
    documents = load(spark, folder, "documents").select("doc_id", F.expr(_GROUP).alias("lang"))
    labels = load(spark, folder, "labels").select("doc_id", F.col("toxic").cast("double"))
    shown = [F.col("lang") == name for name in ("en", "de")]
    vector = array_to_vector(F.array(*[F.coalesce(s, F.lit(False)).cast("double") for s in shown]))
    rows = documents.join(labels, "doc_id").select(
        "lang", F.col("toxic").alias("label"), vector.alias("features"))
    model = LogisticRegression(maxIter=200, tol=1e-12).fit(write_once(rows, "groups"))
    weights = zip(("en", "de", "other"), [*map(float, model.coefficients), 0.0])
    names = F.create_map(*[F.lit(x) for pair in weights for x in pair])
    scored = model.transform(rows).withColumn("p", vector_to_array("probability")[1])
    groups = scored.groupBy("lang").agg(
        F.count("*").alias("rows"), F.round(F.avg("p"), 5).alias("probability"),
        F.max("prediction").alias("prediction"))
    return groups.withColumn("coefficient", F.round(names[F.col("lang")], 3))


@query(
    "logreg_objective",
    f"""{_TEXT}, s AS (SELECT avg(toxic) AS p FROM t WHERE bucket < 80)
        SELECT 'first loss' AS name, round(-p * ln(p) - (1 - p) * ln(1 - p), 6) AS value FROM s
        UNION ALL SELECT 'last loss off by', 0.0 UNION ALL SELECT 'loss falls', 1.0""",
)
def logreg_objective(spark: SparkSession, folder: str) -> DataFrame:
    """The reported losses of a text model against the labels and against its own weights."""
    train, _ = text_parts(spark, folder)
    model = fit_text_logistic(train, settings=BALANCED_LOGISTIC)
    fitted, losses = model.stages[-1], model.stages[-1].summary.objectiveHistory
    features = write_once(
        PipelineModel(model.stages[:-1]).transform(train).select("doc_id", "label", "features"),
        "features")
    found = logistic_objective(
        vector_positions(features, "doc_id", "features"), features.select("doc_id", "label"),
        model_weights(spark, fitted), fitted.intercept, "doc_id",
        BALANCED_LOGISTIC["regParam"], BALANCED_LOGISTIC["elasticNetParam"])
    falls = all(a >= b for a, b in zip(losses, losses[1:])) and losses[-1] < losses[0]
    return spark.createDataFrame(
        [("first loss", round(float(losses[0]), 6)),
         ("last loss off by", abs(round(found.loss - float(losses[-1]), 6))),
         ("loss falls", float(falls))], "name string, value double")


@query("random_forest_predict")
def random_forest_predict(spark: SparkSession, folder: str) -> DataFrame:
    train, rest = text_parts(spark, folder)
    model = fit_text_forest(train)
    return model.transform(rest).select("doc_id", "label", "prediction", "predictedLabel")


@query("forest_summary")
def describe_forest(spark: SparkSession, folder: str) -> DataFrame:
    train, _ = text_parts(spark, folder)
    return forest_summary(spark, fit_text_forest(train).stages[-2])


# The statistic of a term is that of the table present/absent by label. The first split of a
# tree on such terms is the first of them: its Gini gain is the statistic over the rows, times
# the impurity of the root.

_TERM_SCORES = f"""WITH t AS (SELECT doc_id, toxic, {TOKENS_SQL} AS tokens
                              FROM documents JOIN labels USING (doc_id)
                              WHERE {sql_percent('doc_id')} < 80),
    n AS (SELECT count(*)::double AS n, sum(toxic)::double AS n1 FROM t),
    e AS (SELECT DISTINCT doc_id, toxic, unnest(tokens) AS term FROM t),
    c AS (SELECT term, count(*)::double AS p, sum(toxic)::double AS p1 FROM e GROUP BY term),
    s AS (SELECT *, CASE WHEN p < n THEN n * (n * (p1 * p1 / n1 + (p - p1) * (p - p1) / (n - n1))
                                              - p * p) / (p * (n - p)) ELSE 0 END AS chi
          FROM c, n)"""


def training_words(spark: SparkSession, folder: str) -> DataFrame:
    train, _ = text_parts(spark, folder)
    words = with_tokens(train).select("doc_id", "label", F.array_distinct("tokens").alias("terms"))
    return write_once(words, "words")


def scored_terms(words: DataFrame) -> DataFrame:
    entries = words.select("label", F.explode("terms").alias("term"))
    return chi_squared(entries, words.select("label"), "term", "label")


@query(
    "term_selection",
    f"""{_TERM_SCORES} SELECT term, p::bigint AS rows, round(chi, 6) AS chi_squared
        FROM s ORDER BY round(chi, 9) DESC, term LIMIT 200""",
)
def select_terms(spark: SparkSession, folder: str) -> DataFrame:
    scored = scored_terms(training_words(spark, folder))
    rounded = scored.withColumn("chi_squared", F.round("chi_squared", 9))
    best = best_features(rounded, "term", 200)
    return best.withColumn("chi_squared", F.round("chi_squared", 6))


@query(
    "forest_stump",
    f"""{_TERM_SCORES},
        b AS (SELECT * FROM s ORDER BY round(chi, 9) DESC, term LIMIT 1),
        k AS (SELECT *, 2 * p1 > p AS yes, 2 * (n1 - p1) > n - p AS no FROM b)
        SELECT 0::bigint AS node, CASE WHEN yes <> no THEN term END AS term,
               CASE WHEN yes <> no THEN
                    round(chi / n * 2 * n1 / n * (1 - n1 / n), 9) END AS gain,
               n::bigint AS rows, n1 AS positives, (2 * n1 > n)::int::double AS prediction FROM k
        UNION ALL SELECT 1, NULL, NULL, (n - p)::bigint, n1 - p1, no::int::double FROM k
                  WHERE yes <> no
        UNION ALL SELECT 2, NULL, NULL, p::bigint, p1, yes::int::double FROM k WHERE yes <> no""",
)
def forest_stump(spark: SparkSession, folder: str) -> DataFrame:
    """A tree of one split on the twenty best terms, as a node table."""
    words = training_words(spark, folder)
    rounded = scored_terms(words).withColumn("chi_squared", F.round("chi_squared", 9))
    terms = [r["term"] for r in best_features(rounded, "term", 20).collect()]
    present = [F.array_contains("terms", t).cast("double") for t in terms]
    rows = words.select("label", array_to_vector(F.array(*present)).alias("features"))
    stump = RandomForestClassifier(
        numTrees=1, maxDepth=1, bootstrap=False, featureSubsetStrategy="all", seed=TEXT_SEED)
    nodes = forest_nodes(spark, stump.fit(rows))
    names = F.array(*[F.lit(t) for t in terms])
    return nodes.select(
        "node", F.get(names, F.col("feature").cast("int")).alias("term"),
        F.round("gain", 9).alias("gain"), "rows", F.col("counts")[1].alias("positives"),
        "prediction")


@query(
    "forest_walk",
    f"""{_TEXT} SELECT doc_id, true AS equal FROM t WHERE bucket >= 80""",
)
def forest_walk(spark: SparkSession, folder: str) -> DataFrame:
    """Held-out predictions by joins with the node table, against those of the model."""
    train, rest = text_parts(spark, folder)
    model = fit_text_forest(train)
    scored = write_once(
        model.transform(rest).select("doc_id", "indexedFeatures", "prediction"), "scored")
    nodes = forest_nodes(spark, model.stages[-2])
    walked = walk_forest(nodes, scored, "doc_id", "indexedFeatures")
    both = scored.join(walked.withColumnRenamed("prediction", "walked"), "doc_id")
    return both.select("doc_id", (F.col("prediction") == F.col("walked")).alias("equal"))


@query(
    "linreg_simple",
    """SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
              round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
              round(regr_r2(l_extendedprice, l_quantity), 9) AS r2
       FROM lineitem""",
)
def linreg_simple(spark: SparkSession, folder: str) -> DataFrame:
    rows = load(spark, folder, "lineitem").select("l_quantity", "l_extendedprice")
    rows = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(rows)
    model = LinearRegression(labelCol="l_extendedprice").fit(rows)
    result = [(round(float(model.coefficients[0]), 4), round(model.intercept, 4),
               round(model.summary.r2, 9))]
    return spark.createDataFrame(result, "slope double, intercept double, r2 double")


# Without a penalty the mean prediction of every encoded category is its mean label.


@query(
    "linreg_predict",
    """SELECT 'p_brand' AS "column", p_brand AS value, round(avg(p_retailprice), 4) AS prediction
       FROM part GROUP BY p_brand
       UNION ALL SELECT 'p_type', p_type, round(avg(p_retailprice), 4) FROM part GROUP BY p_type""",
)
def linreg_predict(spark: SparkSession, folder: str) -> DataFrame:
    categories = ["p_brand", "p_type"]
    part = load(spark, folder, "part").select(*categories, "p_size", "p_retailprice")
    index = CategoryIndex(categories, handle_invalid="error").fit(part)
    indexed = index.transform(part)
    encoder = OneHotEncoder(
        inputCols=index.output_columns, outputCols=[c + "Vec" for c in categories]
    )
    encoded = encoder.fit(indexed).transform(indexed)
    assembler = VectorAssembler(
        inputCols=encoder.getOutputCols() + ["p_size"], outputCol="features"
    )
    rows = assembler.transform(encoded)
    scored = LinearRegression(labelCol="p_retailprice").fit(rows).transform(rows)
    named = scored.select("prediction", *categories).unpivot(
        "prediction", categories, "column", "value"
    )
    means = named.groupBy("column", "value").agg(F.avg("prediction").alias("prediction"))
    return means.withColumn("prediction", F.round("prediction", 4))


# One feature: the penalised weight has a closed form, a shrunken and clipped correlation.


@query(
    "param_grid",
    """WITH m AS (SELECT avg(l_quantity) AS xm, avg(l_extendedprice) AS ym,
                         stddev_pop(l_quantity) AS xs, stddev_pop(l_extendedprice) AS ys,
                         covar_pop(l_quantity, l_extendedprice) AS c,
                         avg(l_quantity * l_quantity) AS xx,
                         avg(l_quantity * l_extendedprice) AS xy FROM lineitem),
            g AS (SELECT r, f, e FROM (VALUES (0.1::double)) a(r), (VALUES (true), (false)) b(f),
                                      (VALUES (0.5::double)) d(e)),
            s AS (SELECT *, CASE WHEN f THEN c ELSE xy END / (xs * ys) AS rho,
                         CASE WHEN f THEN 1 ELSE xx / (xs * xs) END AS q FROM m, g),
            w AS (SELECT *, sign(rho) * greatest(abs(rho) - r * e / ys, 0)
                            / (q + r * (1 - e) / ys) * ys / xs AS k FROM s)
       SELECT r AS reg_param, f AS fit_intercept, e AS elastic_net, round(k, 3) AS coefficient,
              round(CASE WHEN f THEN ym - k * xm ELSE 0 END, 2) AS intercept FROM w""",
)
def param_grid(spark: SparkSession, folder: str) -> DataFrame:
    rows = load(spark, folder, "lineitem").select("l_quantity", "l_extendedprice")
    rows = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(rows)
    regression = LinearRegression(labelCol="l_extendedprice", maxIter=10)
    builder = ParamGridBuilder()
    for name, values in LINEAR_GRID.items():
        builder.addGrid(regression.getParam(name), values)
    found = [
        (m.getRegParam(), m.getFitIntercept(), m.getElasticNetParam(),
         round(float(m.coefficients[0]), 3), round(m.intercept, 2))
        for m in regression.fit(rows, builder.build())
    ]
    return spark.createDataFrame(
        found,
        "reg_param double, fit_intercept boolean, elastic_net double, coefficient double, "
        "intercept double",
    )


def part_sets(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Parts to learn from and parts to price; the names of some are missing."""
    part = load(spark, folder, "part").withColumn(
        "p_name", F.when(F.col("p_type") == "PROMO", "NA").otherwise(F.col("p_name"))
    )
    train, test = split_by_key(part, "p_partkey", 80)
    return house_columns(train, test, always=[], outlier=("p_size", 50))


def tuned_parts(train: DataFrame):
    return fit_house_prices(
        train, key="p_partkey", target="p_retailprice", categories=["p_brand", "p_type", "p_name"]
    )


# The optimum of an elastic net has no closed form. SQL finds it by accelerated proximal
# gradient steps from second moments, for the rows to fit and for all rows (``whole``).
_PRICES = f"""WITH RECURSIVE
    p AS (SELECT p_partkey AS k, p_brand, p_type, p_size, p_retailprice AS y,
                 {sql_percent('p_partkey')} AS bucket,
                 {sql_percent('p_partkey', str(TABULAR_SEED))} >= 80 AS rest FROM part),
    t AS (SELECT * FROM p WHERE bucket < 80 AND p_size < 50),
    x AS (SELECT k, 'b' || p_brand AS f, 1::double AS v FROM p
          UNION ALL SELECT k, 't' || p_type, 1 FROM p UNION ALL SELECT k, 's', p_size FROM p),
    o AS (SELECT whole, k, y FROM t, (VALUES (true), (false)) s(whole) WHERE whole OR NOT rest),
    n AS (SELECT whole, count(*) AS n, avg(y) AS ym, stddev_pop(y) AS ys FROM o GROUP BY whole),
    m AS (SELECT whole, f, n, ym, ys, sum(v) / n AS xm, sqrt(sum(v * v) / n - xm * xm) AS xs,
                 sum(v * y) / n AS xy, row_number() OVER (PARTITION BY whole ORDER BY f) AS j
          FROM o JOIN x USING (k) JOIN n USING (whole) GROUP BY whole, f, n, ym, ys),
    g AS (SELECT whole, a.f AS f, b.f AS h, sum(a.v * b.v) AS xx
          FROM o JOIN x a USING (k) JOIN x b USING (k) GROUP BY whole, a.f, b.f),
    c AS (SELECT *, 0.1 * 0.5 / ys AS pen FROM m, (VALUES (true), (false)) i(fit)),
    q AS (SELECT a.whole, a.fit, a.j, a.pen,
                 (a.xy - CASE WHEN a.fit THEN a.xm * a.ym ELSE 0 END) / (a.xs * a.ys) AS r,
                 list((coalesce(xx, 0) / a.n - CASE WHEN a.fit THEN a.xm * b.xm ELSE 0 END)
                      / (a.xs * b.xs) + CASE WHEN a.j = b.j THEN a.pen ELSE 0 END
                      ORDER BY b.j) AS row
          FROM c a JOIN c b ON a.whole = b.whole AND a.fit = b.fit
          LEFT JOIN g ON g.whole = a.whole AND g.f = a.f AND g.h = b.f
          GROUP BY a.whole, a.fit, a.j, a.pen, a.xy, a.xm, a.ym, a.xs, a.ys),
    s AS (SELECT whole, fit, any_value(pen) AS pen, list(row ORDER BY j) AS qs,
                 list(r ORDER BY j) AS rs,
                 max(list_sum(list_transform(row, lambda z: abs(z)))) AS top FROM q GROUP BY whole, fit),
    w AS (SELECT 0 AS step, whole, fit, pen, qs, rs, top,
                 (sqrt(top) - sqrt(pen)) / (sqrt(top) + sqrt(pen)) AS beta,
                 list_transform(rs, lambda z: 0::double) AS old,
                 list_transform(rs, lambda z: 0::double) AS w FROM s
          UNION ALL
          SELECT step + 1, whole, fit, pen, qs, rs, top, beta, w,
                 list_transform(range(1, len(w) + 1), lambda i:
                     sign(u[i] - (list_dot_product(qs[i], u) - rs[i]) / top)
                     * greatest(abs(u[i] - (list_dot_product(qs[i], u) - rs[i]) / top)
                                - pen / top, 0))
          FROM (SELECT *, list_transform(range(1, len(w) + 1),
                                         lambda i: w[i] + beta * (w[i] - old[i])) AS u
                FROM w WHERE step < 4000)),
    z AS (SELECT c.*, w[j] * ys / xs AS weight FROM c
          JOIN (SELECT whole, fit, w FROM w WHERE step = 4000) USING (whole, fit)),
    b AS (SELECT whole, fit, CASE WHEN fit THEN any_value(ym) - sum(weight * xm) ELSE 0 END AS base
          FROM z GROUP BY whole, fit),
    d AS (SELECT b.whole, b.fit, p.k, p.y, p.bucket, p.rest AND p.bucket < 80 AND p.p_size < 50
                 AS measured, any_value(base) + coalesce(sum(weight * v), 0) AS predicted
          FROM p JOIN x USING (k) CROSS JOIN b
          LEFT JOIN z ON z.whole = b.whole AND z.fit = b.fit AND z.f = x.f
          GROUP BY b.whole, b.fit, p.k, p.y, p.bucket, measured),
    e AS (SELECT fit, sqrt(avg((y - predicted) ** 2)) AS metric FROM d
          WHERE measured AND NOT whole GROUP BY fit)"""


@query(
    "tune_train_validation",
    f"""{_PRICES}
        SELECT CASE WHEN fit THEN 0 ELSE 1 END::bigint AS combination, parameter,
               CASE parameter WHEN 'regParam' THEN '0.1' WHEN 'elasticNetParam' THEN '0.5'
                              ELSE fit::varchar END AS setting, round(metric, 4) AS metric
        FROM e, (VALUES ('regParam'), ('fitIntercept'), ('elasticNetParam')) v(parameter)""",
)
def tune_train_validation(spark: SparkSession, folder: str) -> DataFrame:
    train, _ = part_sets(spark, folder)
    results = tuning_results(spark, tuned_parts(train).tuned)
    return results.withColumn("metric", F.round("metric", 4))


@query(
    "house_price_predictions",
    f"""{_PRICES}
        SELECT k AS p_partkey, round(predicted, 3) AS p_retailprice FROM d
        WHERE bucket >= 80 AND whole AND fit = (SELECT fit FROM e ORDER BY metric LIMIT 1)""",
)
def house_price_predictions(spark: SparkSession, folder: str) -> DataFrame:
    train, test = part_sets(spark, folder)
    priced = predict_house_prices(tuned_parts(train), test, target="p_retailprice")
    return priced.withColumn("p_retailprice", F.round("p_retailprice", 3))


@query("tune_cross_validation")
def tune_cross_validation(spark: SparkSession, folder: str) -> DataFrame:
    tuned = tune_text_logistic(text_set(spark, folder, heavy=True), "doc_id", parallelism=4)
    return tuning_results(spark, tuned)


# Every document is scored once, by a model that did not see it; each of its words is counted
# at every width of the grid.


@query(
    "out_of_fold_rows",
    f"""SELECT doc_id, toxic::double AS label, ({sql_hash('doc_id')} % {TEXT_FOLDS})::int AS fold,
               len({TOKENS_SQL})::double AS words
        FROM documents JOIN labels USING (doc_id)""",
)
def out_of_fold_rows(spark: SparkSession, folder: str) -> DataFrame:
    tuned = tune_text_logistic(
        text_set(spark, folder, heavy=True), "doc_id", parallelism=4, settings=BALANCED_LOGISTIC)
    sums = [F.aggregate(vector_to_array(f"counts{w}"), F.lit(0.0), lambda a, x: a + x)
            for w in TEXT_GRID_FEATURES]
    words = tuned.counts.select("doc_id", F.when(
        (sums[0] == sums[1]) & (sums[1] == sums[2]), sums[0]).alias("words"))
    scored = out_of_fold(tuned).where(F.col("prediction").isin(0.0, 1.0))
    return scored.select("doc_id", "label", "fold").join(words, "doc_id")


@query("pca_logreg")
def pca_logreg(spark: SparkSession, folder: str) -> DataFrame:
    vectors = with_vector(load(spark, folder, "embeddings"), "embedding")
    train, rest = split_by_key(vectors, "vec_id", 80)
    model = fit_component_logistic(train)
    return model.transform(rest).select("vec_id", "label", "prediction")
