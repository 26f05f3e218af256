"""Scans, sinks, projections, filters, fills, profiles, keyed joins and splits."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import TEXT_SEED
from ..functions import hash_percent
from ..operators import (
    CategoryIndex,
    attach_by_position,
    attach_features,
    cast_label,
    class_balance,
    drop_columns_missing_in,
    fill_numbers,
    fill_text,
    keep_below,
    missing_profile,
    preview,
    random_split,
    sample_by_key,
    schema_report,
    split_by_key,
    value_counts_per_column,
)
from ..sources import (
    literal_table,
    load,
    new_folder,
    read_csv,
    read_csv_strings,
    spread,
    text_set,
    write_csv,
)
from .registry import query, sql_percent

# Sources, sinks and actions.


@query(
    "csv_scan_infer",
    "SELECT doc_id, text, lang, source, n_chars FROM documents",
)
def csv_scan_infer(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "documents-csv")
    write_csv(spread(load(spark, folder, "documents")), path)
    scanned = read_csv(spark, path)
    return scanned.select(
        F.col("doc_id").cast("bigint"), "text", "lang", "source", F.col("n_chars").cast("bigint")
    )


@query(
    "csv_scan_strings",
    """SELECT l_orderkey::varchar AS l_orderkey, l_partkey::varchar AS l_partkey,
              l_suppkey::varchar AS l_suppkey, l_linenumber::varchar AS l_linenumber,
              l_quantity::varchar AS l_quantity, l_extendedprice::varchar AS l_extendedprice,
              l_discount::varchar AS l_discount, l_tax::varchar AS l_tax, l_returnflag,
              l_linestatus, l_shipdate::date::varchar AS l_shipdate
       FROM lineitem""",
)
def csv_scan_strings(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "lineitem-csv")
    lineitem = spread(load(spark, folder, "lineitem"))
    write_csv(lineitem.withColumn("l_shipdate", F.col("l_shipdate").cast("date")), path)
    return read_csv_strings(spark, path, multi_line=False)


@query(
    "literal_table",
    """SELECT event_id, event_type, weight
       FROM events JOIN (VALUES ('view', 1), ('click', 2), ('signup', 5), ('purchase', 10),
                                ('error', 0)) AS w(event_type, weight) USING (event_type)""",
)
def literal_weights(spark: SparkSession, folder: str) -> DataFrame:
    weights = literal_table(
        spark,
        [("view", 1), ("click", 2), ("signup", 5), ("purchase", 10), ("error", 0)],
        "event_type string, weight int",
    )
    events = load(spark, folder, "events").select("event_id", "event_type")
    return events.join(weights, "event_type").select("event_id", "event_type", "weight")


@query(
    "csv_sink_predictions",
    """WITH line AS (SELECT regr_slope(p_retailprice, p_size::double) AS slope,
                            regr_intercept(p_retailprice, p_size::double) AS start FROM part)
       SELECT p_partkey AS "Id", round(start + slope * p_size, 4) AS "SalePrice"
       FROM part, line""",
)
def csv_sink_predictions(spark: SparkSession, folder: str) -> DataFrame:
    part = load(spark, folder, "part").select("p_partkey", "p_size", "p_retailprice")
    rows = VectorAssembler(inputCols=["p_size"], outputCol="features").transform(part)
    model = LinearRegression(labelCol="p_retailprice").fit(rows)
    predicted = model.transform(rows).select(
        F.col("p_partkey").alias("Id"), F.col("prediction").alias("SalePrice")
    )
    path = new_folder(spark, "predictions")
    write_csv(predicted, path)
    written = read_csv(spark, path, "Id bigint, SalePrice double", multi_line=False)
    return written.withColumn("SalePrice", F.round("SalePrice", 4))


@query(
    "dataset_sizes",
    """SELECT 'train' AS name, count(l.doc_id) AS rows
       FROM documents d LEFT JOIN labels l USING (doc_id)
       UNION ALL SELECT 'test', count(*) FILTER (l.doc_id IS NULL)
       FROM documents d LEFT JOIN labels l USING (doc_id)
       UNION ALL SELECT 'positive', count(*) FILTER (l.toxic = 1)
       FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def dataset_sizes(spark: SparkSession, folder: str) -> DataFrame:
    labels = load(spark, folder, "labels").select("doc_id", "toxic")
    marked = load(spark, folder, "documents").select("doc_id").join(labels, "doc_id", "left")
    sizes = marked.agg(
        F.count("toxic").alias("train"),
        F.count_if(F.col("toxic").isNull()).alias("test"),
        F.count_if(F.col("toxic") == 1).alias("positive"),
    )
    return sizes.unpivot([], ["train", "test", "positive"], "name", "rows")


@query(
    "preview_topn",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
       ORDER BY o_totalprice DESC, o_orderkey LIMIT 45""",
)
def preview_topn(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return preview(orders, 45, F.desc("o_totalprice"), "o_orderkey")


_LINEITEM_TYPES = [
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
    ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
    ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
    ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"),
]


@query(
    "schema_report",
    " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", '{kind}' AS type, count({name}) AS rows FROM lineitem"
        for name, kind in _LINEITEM_TYPES
    ),
)
def schema_with_counts(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = load(spark, folder, "lineitem")
    return schema_report(lineitem).join(value_counts_per_column(lineitem), "column")


# Projections, filters and null handling.


@query(
    "project_columns",
    "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem",
)
def project_columns(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = load(spark, folder, "lineitem")
    return lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


@query(
    "project_exprs",
    """SELECT l_orderkey, l_linenumber,
              round(l_extendedprice * (1 - l_discount), 4) AS net_price,
              upper(l_returnflag) || l_linestatus AS status
       FROM lineitem""",
)
def project_exprs(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "round(l_extendedprice * (1 - l_discount), 4) AS net_price",
        "upper(l_returnflag) || l_linestatus AS status",
    )


@query(
    "filter_outliers",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice < 400000",
)
def filter_outliers(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return keep_below(orders, "o_totalprice", 400000)


@query("filter_positive", "SELECT doc_id, quality FROM labels WHERE toxic = 1")
def filter_positive(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "labels").filter("toxic = 1").select("doc_id", "quality")


@query(
    "cast_label",
    """SELECT doc_id, coalesce(toxic::double, 0.0) AS label
       FROM documents LEFT JOIN labels USING (doc_id)""",
)
def cast_text_label(spark: SparkSession, folder: str) -> DataFrame:
    targets = load(spark, folder, "labels").select(
        "doc_id", F.col("toxic").cast("string").alias("target")
    )
    rows = load(spark, folder, "documents").select("doc_id").join(targets, "doc_id", "left")
    return cast_label(fill_text(rows), "target")


@query(
    "rename_columns",
    """SELECT o_orderkey AS "Id", o_totalprice AS label, o_orderpriority AS priority
       FROM orders""",
)
def rename_columns(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    return (
        orders.withColumnRenamed("o_orderkey", "Id")
        .withColumnRenamed("o_totalprice", "label")
        .withColumnRenamed("o_orderpriority", "priority")
    )


@query("drop_columns", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def drop_columns(spark: SparkSession, folder: str) -> DataFrame:
    unwanted = ["c_name", "c_acctbal", "no_such_column"]
    return load(spark, folder, "customer").drop(*unwanted)


def events_with_nulls(spark: SparkSession, folder: str) -> DataFrame:
    """Events without a type and a value where the type is ``error``."""
    failed = F.col("event_type") == "error"
    return load(spark, folder, "events").select(
        "event_id",
        F.when(~failed, F.col("event_type")).alias("event_type"),
        F.when(~failed, F.col("value")).alias("value"),
    )


@query(
    "fill_null_strings",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS event_type,
              CASE WHEN event_type <> 'error' THEN value END AS value
       FROM events""",
)
def fill_null_strings(spark: SparkSession, folder: str) -> DataFrame:
    return fill_text(events_with_nulls(spark, folder))


@query(
    "fill_null_numbers",
    """SELECT event_id, nullif(event_type, 'error') AS event_type,
              CASE WHEN event_type = 'error' THEN 0.0 ELSE value END AS value
       FROM events""",
)
def fill_null_numbers(spark: SparkSession, folder: str) -> DataFrame:
    return fill_numbers(events_with_nulls(spark, folder))


# Keyed join.


@query(
    "attach_features",
    """WITH brand AS (SELECT p_brand, row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS i
                      FROM part GROUP BY p_brand),
            kind AS (SELECT p_type, row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS i
                     FROM part GROUP BY p_type)
       SELECT p_partkey, p_name, p_retailprice, brand.i::double AS "p_brandIndex",
              kind.i::double AS "p_typeIndex"
       FROM part JOIN brand USING (p_brand) JOIN kind USING (p_type)""",
)
def attach_part_features(spark: SparkSession, folder: str) -> DataFrame:
    part = load(spark, folder, "part")
    categories = part.select("p_partkey", "p_brand", "p_type")
    index = CategoryIndex(["p_brand", "p_type"]).fit(categories)
    encoded = index.transform(categories).select("p_partkey", *index.output_columns)
    rest = part.select("p_partkey", "p_name", "p_retailprice")
    return attach_features(rest, encoded, "p_partkey")


@query(
    "attach_by_position",
    "SELECT doc_id, text, toxic FROM documents JOIN labels USING (doc_id)",
)
def attach_labels_by_position(spark: SparkSession, folder: str) -> DataFrame:
    """Texts and labels in two CSV files without a common key, row for row."""
    labels = load(spark, folder, "labels").select("doc_id", "toxic")
    rows = load(spark, folder, "documents").select("doc_id", "text").join(labels, "doc_id")
    rows = rows.orderBy("doc_id")
    texts, marks = new_folder(spark, "texts-csv"), new_folder(spark, "marks-csv")
    write_csv(rows.select("doc_id", "text"), texts)
    write_csv(rows.select("toxic").coalesce(2), marks)
    left = read_csv(spark, texts, "doc_id bigint, text string", row_number="row")
    right = read_csv(spark, marks, "toxic int", multi_line=False, row_number="row")
    return attach_by_position(left, right, "row").drop("row")


# Profiles.


def events_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Events with the text ``NA`` for the type of errors and for small values' props."""
    return load(spark, folder, "events").select(
        "event_id",
        "user_id",
        F.when(F.col("event_type") == "error", "NA").otherwise(F.col("event_type"))
        .alias("event_type"),
        "value",
        F.when(F.col("value") < 10, "NA").otherwise(F.col("props")).alias("props"),
    )


_PROFILE = """SELECT 'event_id' AS "column", count(*) FILTER (event_id::varchar = 'NA') AS "Total"
              FROM events
    UNION ALL SELECT 'user_id', count(*) FILTER (user_id::varchar = 'NA') FROM events
    UNION ALL SELECT 'event_type', count(*) FILTER (event_type = 'error') FROM events
    UNION ALL SELECT 'value', count(*) FILTER (value::varchar = 'NA') FROM events
    UNION ALL SELECT 'props', count(*) FILTER (value < 10) FROM events"""


@query("missing_profile", _PROFILE)
def profile_events(spark: SparkSession, folder: str) -> DataFrame:
    return missing_profile(events_with_gaps(spark, folder))


@query("missing_profile_sorted", f"""SELECT * FROM ({_PROFILE}) ORDER BY "Total" DESC, "column" """)
def profile_events_sorted(spark: SparkSession, folder: str) -> DataFrame:
    return profile_events(spark, folder).orderBy(F.desc("Total"), "column")


@query(
    "drop_missing_columns",
    f"""SELECT event_id, value,
               CASE WHEN {sql_percent('event_id')} < 80 THEN 'train' ELSE 'test' END AS part
        FROM events""",
)
def drop_missing_columns(spark: SparkSession, folder: str) -> DataFrame:
    train, test = split_by_key(events_with_gaps(spark, folder), "event_id")
    train, test = drop_columns_missing_in(test, train, test, always=["user_id"])
    return train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))


@query(
    "class_balance",
    """SELECT toxic::double AS label, count(*) AS rows,
              round(count(*) / sum(count(*)) OVER (), 9) AS share
       FROM documents JOIN labels USING (doc_id) GROUP BY toxic""",
)
def text_class_balance(spark: SparkSession, folder: str) -> DataFrame:
    return class_balance(text_set(spark, folder)).withColumn("share", F.round("share", 9))


# Splits and samples.


@query(
    "random_split",
    f"""SELECT doc_id, CASE WHEN place <= floor(0.8::double * rows) THEN 'train' ELSE 'holdout' END
                       AS part
        FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('{TEXT_SEED}:' || doc_id)) AS place,
                     count(*) OVER () AS rows FROM documents)""",
)
def random_parts(spark: SparkSession, folder: str) -> DataFrame:
    keys = load(spark, folder, "documents").select("doc_id")
    train, rest = random_split(keys, [0.8, 0.2], TEXT_SEED, "doc_id")
    return train.withColumn("part", F.lit("train")).union(
        rest.withColumn("part", F.lit("holdout"))
    )


@query(
    "hash_split",
    f"""SELECT doc_id,
               CASE WHEN {sql_percent('doc_id')} < 80 THEN 'train' ELSE 'holdout' END AS part
        FROM documents""",
)
def hash_parts(spark: SparkSession, folder: str) -> DataFrame:
    keys = load(spark, folder, "documents").select("doc_id")
    part = F.when(hash_percent("doc_id") < 80, "train").otherwise("holdout")
    return keys.withColumn("part", part)


@query(
    "sample_fraction",
    f"SELECT doc_id, n_chars FROM documents WHERE {sql_percent('doc_id')} < 25",
)
def sample_fraction(spark: SparkSession, folder: str) -> DataFrame:
    documents = load(spark, folder, "documents").select("doc_id", "n_chars")
    return sample_by_key(documents, "doc_id", 25)
