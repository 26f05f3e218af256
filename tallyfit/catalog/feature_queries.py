"""Category indexes, one-hot vectors, assembled vectors, components."""

from __future__ import annotations

from pyspark.ml.feature import (
    IndexToString,
    OneHotEncoder,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import COMPONENTS, MAX_CATEGORIES
from ..operators import (
    CategoryIndex,
    category_index,
    covariance_matrix,
    fit_vector_indexer,
    one_hot_positions,
    principal_components,
    project,
    vector_positions,
)
from ..plans.vector_classification import project_components, with_vector
from ..sources import load, spread
from .registry import query


def sql_index(table: str, column: str) -> str:
    """SQL twin of a category index: ``(column, i, k)`` with ``k`` categories in all."""
    return f"""(SELECT {column}, row_number() OVER (ORDER BY count(*) DESC, {column}::varchar) - 1
                       AS i, count(*) OVER () AS k
                FROM {table} GROUP BY {column})"""


PART_CATEGORIES = ["p_brand", "p_type", "p_size"]
_PART = f"""WITH b AS {sql_index('part', 'p_brand')}, t AS {sql_index('part', 'p_type')},
                 s AS {sql_index('part', 'p_size')},
                 e AS (SELECT p_partkey, p_retailprice, b.i AS bi, t.i AS ti, s.i AS si,
                              b.k AS bk, t.k AS tk, s.k AS sk
                       FROM part JOIN b USING (p_brand) JOIN t USING (p_type)
                            JOIN s USING (p_size))"""


def indexed_parts(spark: SparkSession, folder: str) -> DataFrame:
    part = load(spark, folder, "part").select("p_partkey", *PART_CATEGORIES, "p_retailprice")
    return CategoryIndex(PART_CATEGORIES, handle_invalid="error").fit(part).transform(part)


def encoded_parts(spark: SparkSession, folder: str) -> DataFrame:
    indexed = indexed_parts(spark, folder)
    encoder = OneHotEncoder(
        inputCols=[c + "Index" for c in PART_CATEGORIES],
        outputCols=[c + "Vec" for c in PART_CATEGORIES],
    )
    return encoder.fit(indexed).transform(indexed)


@query(
    "index_categories",
    f"""{_PART} SELECT p_partkey, bi::double AS "p_brandIndex", ti::double AS "p_typeIndex",
                       si::double AS "p_sizeIndex" FROM e""",
)
def index_categories(spark: SparkSession, folder: str) -> DataFrame:
    return indexed_parts(spark, folder).select(
        "p_partkey", *[c + "Index" for c in PART_CATEGORIES]
    )


@query(
    "index_categories_table",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {c}::varchar AS value, count(*) AS rows,
                   row_number() OVER (ORDER BY count(*) DESC, {c}::varchar) - 1 AS index
            FROM lineitem GROUP BY {c}"""
        for c in ("l_orderkey", "l_partkey", "l_suppkey")
    ),
)
def index_categories_table(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["l_orderkey", "l_partkey", "l_suppkey"]
    return category_index(spread(load(spark, folder, "lineitem").select(*keys)), keys)


@query(
    "index_label",
    f"""WITH p AS {sql_index('orders', 'o_orderpriority')}
        SELECT o_orderkey, p.i::double AS "indexedLabel"
        FROM orders JOIN p USING (o_orderpriority)""",
)
def index_label(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    indexer = StringIndexer(inputCol="o_orderpriority", outputCol="indexedLabel")
    return indexer.fit(orders).transform(orders).select("o_orderkey", "indexedLabel")


@query(
    "index_to_label",
    f"""WITH p AS {sql_index('orders', 'o_orderpriority')}
        SELECT o_orderkey, p.i::double AS prediction, o_orderpriority AS "predictedLabel"
        FROM orders JOIN p USING (o_orderpriority)""",
)
def index_to_label(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    labels = StringIndexer(inputCol="o_orderpriority", outputCol="prediction").fit(orders)
    indexed = labels.transform(orders).select("o_orderkey", "prediction")
    back = IndexToString(
        inputCol="prediction", outputCol="predictedLabel", labels=list(labels.labels)
    )
    return back.transform(indexed)


@query(
    "one_hot",
    f"""{_PART}
        SELECT p_partkey, 'p_brandVec' AS "column", CASE WHEN bi < bk - 1 THEN bi END AS position,
               bk - 1 AS size FROM e
        UNION ALL SELECT p_partkey, 'p_typeVec', CASE WHEN ti < tk - 1 THEN ti END, tk - 1 FROM e
        UNION ALL SELECT p_partkey, 'p_sizeVec', CASE WHEN si < sk - 1 THEN si END, sk - 1
        FROM e""",
)
def one_hot(spark: SparkSession, folder: str) -> DataFrame:
    vectors = [c + "Vec" for c in PART_CATEGORIES]
    return one_hot_positions(encoded_parts(spark, folder), "p_partkey", vectors).select(
        "p_partkey",
        "column",
        F.col("position").cast("bigint").alias("position"),
        F.col("size").cast("bigint").alias("size"),
    )


@query(
    "assemble_features",
    f"""{_PART}
        SELECT p_partkey, bi AS position, 1.0::double AS value FROM e WHERE bi < bk - 1
        UNION ALL SELECT p_partkey, bk - 1 + ti, 1.0 FROM e WHERE ti < tk - 1
        UNION ALL SELECT p_partkey, bk + tk - 2 + si, 1.0 FROM e WHERE si < sk - 1
        UNION ALL SELECT p_partkey, bk + tk + sk - 3, p_retailprice
        FROM e WHERE p_retailprice <> 0""",
)
def assemble_features(spark: SparkSession, folder: str) -> DataFrame:
    assembler = VectorAssembler(
        inputCols=[c + "Vec" for c in PART_CATEGORIES] + ["p_retailprice"], outputCol="features"
    )
    rows = vector_positions(assembler.transform(encoded_parts(spark, folder)), "p_partkey",
                            "features")
    return rows.withColumn("position", F.col("position").cast("bigint"))


_INDEXED = ["l_returnflagIndex", "l_linestatusIndex"]
_MEASURED = ["l_linenumber", "l_quantity", "l_discount", "l_tax"]


@query(
    "vector_index",
    " UNION ALL ".join(
        f"""SELECT {i} AS dimension, CASE WHEN count(DISTINCT {c}) <= {MAX_CATEGORIES}
                                          THEN count(DISTINCT {c}) END AS categories
            FROM lineitem"""
        for i, c in enumerate(["l_returnflag", "l_linestatus", *_MEASURED])
    ),
)
def vector_index(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = load(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", *_MEASURED)
    index = CategoryIndex(["l_returnflag", "l_linestatus"]).fit(lineitem)
    assembler = VectorAssembler(inputCols=_INDEXED + _MEASURED, outputCol="features")
    vectors = assembler.transform(index.transform(lineitem)).select("features")
    model = fit_vector_indexer(vectors, "features", "indexedFeatures", MAX_CATEGORIES)
    found = {int(d): len(values) for d, values in model.categoryMaps.items()}
    rows = [(d, found.get(d)) for d in range(model.numFeatures)]
    return spark.createDataFrame(rows, "dimension int, categories bigint")


# A covariance matrix that is squared over and over, at a trace of 1, tends to the projection on
# its first component; the component is taken away and the next one found in the same way.
SQUARINGS = 24


def components_sql(count: int) -> str:
    """Common table expressions ``v`` of entries and ``e0``, ``e1``, ... of components, each
    with a positive largest entry."""
    parts = ["""v AS MATERIALIZED (
                  SELECT vec_id, unnest(embedding)::double AS x,
                         generate_subscripts(embedding, 1) - 1 AS i FROM embeddings),
                c0 AS MATERIALIZED (
                  SELECT a.i, b.i AS j, covar_samp(a.x, b.x) AS c
                  FROM v a JOIN v b USING (vec_id) GROUP BY a.i, b.i)"""]
    for n in range(count):
        last = f"c{n}"
        for step in range(SQUARINGS):
            parts.append(f"""c{n}_{step} AS MATERIALIZED (
                  SELECT i, j, c / sum(CASE WHEN i = j THEN c END) OVER () AS c
                  FROM (SELECT a.i, b.j, sum(a.c * b.c) AS c
                        FROM {last} a JOIN {last} b ON a.j = b.i GROUP BY a.i, b.j))""")
            last = f"c{n}_{step}"
        both = f"FROM c{n} c JOIN e{n} a ON a.i = c.i JOIN e{n} b ON b.i = c.j"
        parts.append(f"""e{n} AS MATERIALIZED (
                  SELECT i, c / sqrt(sum(c * c) OVER ()) AS e FROM {last}
                  WHERE j = (SELECT arg_max(i, c) FROM {last} WHERE i = j)),
                c{n + 1} AS MATERIALIZED (
                  SELECT c.i, c.j, c.c - a.e * b.e * (SELECT sum(a.e * c.c * b.e) {both}) AS c
                  {both})""")
    return ", ".join(parts)


@query(
    "pca_project",
    f"WITH {components_sql(COMPONENTS)} SELECT vec_id, "
    + ", ".join(f"round(sum(x * e{n}.e), 6) AS pc{n}" for n in range(COMPONENTS))
    + " FROM v " + " ".join(f"JOIN e{n} ON e{n}.i = v.i" for n in range(COMPONENTS))
    + " GROUP BY vec_id",
)
def pca_project(spark: SparkSession, folder: str) -> DataFrame:
    vectors = with_vector(load(spark, folder, "embeddings"), "embedding")
    model = project_components(vectors, "features", COMPONENTS)
    # A component is defined but for its sign: here its largest entry is positive.
    signs = [1.0 if max(axis, key=abs) > 0 else -1.0 for axis in model.pc.toArray().T.tolist()]
    parts = model.transform(vectors).select("vec_id", vector_to_array("pcaFeatures").alias("p"))
    return parts.select("vec_id", *[
        F.round(F.get("p", F.lit(i)) * sign, 6).alias(f"pc{i}") for i, sign in enumerate(signs)])


# The sums of the first three powers of all variances along components are traces of powers
# of the covariance matrix; rows along different components have no covariance.


@query(
    "pca_spectrum",
    """WITH v AS (SELECT vec_id, unnest(embedding)::double AS x,
                         generate_subscripts(embedding, 1) - 1 AS i FROM embeddings),
            c AS (SELECT a.i, b.i AS j, covar_samp(a.x, b.x) AS c
                  FROM v a JOIN v b USING (vec_id) GROUP BY a.i, b.i)
       SELECT 'power 1' AS name, round(sum(c), 6) AS value FROM c WHERE i = j
       UNION ALL SELECT 'power 2', round(sum(c * c), 6) FROM c
       UNION ALL SELECT 'power 3', round(sum(a.c * b.c * d.c), 6)
                 FROM c a JOIN c b ON a.j = b.i JOIN c d ON b.j = d.i AND d.j = a.i
       UNION ALL SELECT 'covariance ' || x, 0.0 FROM (VALUES ('0 1'), ('0 2'), ('1 2')) t(x)
       UNION ALL SELECT 'variance off by ' || x, 0.0 FROM (VALUES ('0'), ('1'), ('2')) t(x)""",
)
def pca_spectrum(spark: SparkSession, folder: str) -> DataFrame:
    vectors = with_vector(load(spark, folder, "embeddings"), "embedding")
    found = principal_components(vectors, "features", 64)
    variances = found.variances
    rows = [(f"power {p}", round(float((variances ** p).sum()), 6)) for p in (1, 2, 3)]
    along = project(vectors, "vec_id", "features", found).select(
        *[F.get("projected", F.lit(i)).alias(f"pc{i}") for i in range(COMPONENTS)])
    pairs = [(i, j) for i in range(COMPONENTS) for j in range(i, COMPONENTS)]
    got = along.agg(*[F.covar_samp(f"pc{i}", f"pc{j}").alias(f"{i} {j}") for i, j in pairs])
    for (i, j), value in zip(pairs, got.first()):
        name = f"covariance {i} {j}" if i < j else f"variance off by {i}"
        off = value - (float(variances[i]) if i == j else 0.0)
        rows.append((name, abs(round(off, 6))))
    return spark.createDataFrame(rows, "name string, value double")


@query(
    "covariance_matrix",
    """WITH v AS (SELECT vec_id, unnest(embedding)::double AS x,
                         generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)
       SELECT a.i, b.i AS j, round(covar_samp(a.x, b.x), 9) AS covariance
       FROM v a JOIN v b USING (vec_id) GROUP BY a.i, b.i""",
)
def covariances(spark: SparkSession, folder: str) -> DataFrame:
    matrix = covariance_matrix(load(spark, folder, "embeddings"), "embedding")
    return matrix.withColumn("covariance", F.round("covariance", 9))
