"""CSV, cleaning, profiles, keyed joins and splits."""

import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tallyfit import limits
from tallyfit.operators import (
    attach_features,
    attach_lookup,
    cast_label,
    class_balance,
    drop_columns_missing_in,
    fill_numbers,
    fill_text,
    fold_by_key,
    keep_below,
    missing_profile,
    preview,
    random_split,
    sample_by_key,
    schema_report,
    split_by_key,
    with_earlier_totals,
    with_position,
)
from tallyfit.sources import literal_table, new_folder, read_csv, read_csv_strings, write_csv

TEXTS = [
    (1, "plain"),
    (2, 'says "hi", twice'),
    (3, "two\nlines\r\nand three"),
    (4, "  blanks around  "),
    (5, "back\\slash"),
    (6, ""),
    (7, None),
]


def test_csv_round_trip_keeps_text(spark):
    path = new_folder(spark, "test-csv")
    write_csv(literal_table(spark, TEXTS, "id int, text string"), path)
    rows = {r.id: r.text for r in read_csv(spark, path).collect()}
    assert rows == dict(TEXTS)
    strings = read_csv_strings(spark, path)
    assert [t for _, t in strings.dtypes] == ["string", "string"]
    assert strings.count() == len(TEXTS)


def test_literal_table_with_a_vector_column(spark):
    fields = [StructField("pred", VectorUDT(), False), StructField("label", IntegerType())]
    schema = StructType(fields)
    rows = [(Vectors.sparse(5, [1, 3], [1.0, 7.0]), 1), (Vectors.dense(2.0, 0.0, 3.0), 0)]
    assert [tuple(r) for r in literal_table(spark, rows, schema).collect()] == rows


def test_csv_sink_refuses_to_overwrite(spark):
    path = new_folder(spark, "test-csv")
    table = literal_table(spark, TEXTS, "id int, text string")
    write_csv(table, path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_csv(table, path)


def test_csv_na_is_text_unless_asked(spark):
    path = new_folder(spark, "test-csv")
    write_csv(literal_table(spark, [(1, "NA"), (2, "x")], "id int, c string"), path)
    assert read_csv(spark, path).where("c = 'NA'").count() == 1
    assert read_csv(spark, path, null_value="NA").where("c is null").count() == 1
    typed = read_csv(spark, path, schema="id bigint, c string")
    assert typed.dtypes == [("id", "bigint"), ("c", "string")]


def test_fills_touch_their_own_type_only(spark):
    df = literal_table(spark, [(None, None), (1, "a")], "n int, s string")
    assert fill_text(df).where("s = '' and n is null").count() == 1
    assert fill_numbers(df).where("n = 0 and s is null").count() == 1


def test_cast_label_of_text(spark):
    df = literal_table(spark, [(1, "1"), (2, ""), (3, None), (4, "x"), (5, "0.5")],
                       "id int, target string")
    labels = {r.id: r.label for r in cast_label(fill_text(df), "target").collect()}
    assert labels == {1: 1.0, 2: 0.0, 3: 0.0, 4: 0.0, 5: 0.5}


def test_keep_below_drops_bound_and_null(spark):
    df = literal_table(spark, [(1,), (4500,), (None,)], "x int")
    assert [r.x for r in keep_below(df, "x", 4500).collect()] == [1]


def test_missing_profile_beside_number_column(spark):
    df = literal_table(spark, [(1, "NA", "a"), (2, "NA", "NA"), (3, None, "c")],
                       "id int, p string, q string")
    assert {r["column"]: r.Total for r in missing_profile(df).collect()} == {
        "id": 0, "p": 2, "q": 1}
    assert {r["column"]: r.Total for r in missing_profile(df, "2").collect()}["id"] == 1


def test_number_columns_are_not_read_for_a_text_sentinel(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    plan = missing_profile(df)._jdf.queryExecution().toString()
    assert "p_retailprice" not in plan[plan.index("ReadSchema"):].split("\n")[0]


def test_drop_columns_follows_the_profiled_table(spark):
    train = literal_table(spark, [(1, "NA", "a", "e")], "id int, p string, q string, e string")
    test = literal_table(spark, [(2, "x", "NA", "e")], "id int, p string, q string, e string")
    a, b = drop_columns_missing_in(test, train, test, always=["e", "unknown"])
    assert a.columns == b.columns == ["id", "p"]


def test_class_balance(spark):
    df = literal_table(spark, [(0,), (0,), (0,), (1,)], "label int")
    assert {r.label: (r.rows, r.share) for r in class_balance(df).collect()} == {
        0: (3, 0.75), 1: (1, 0.25)}


def test_schema_report_and_preview(spark):
    df = literal_table(spark, [(2, "b"), (1, "a"), (2, "a")], "n int, s string")
    assert [tuple(r) for r in schema_report(df).collect()] == [("n", "int"), ("s", "string")]
    assert [tuple(r) for r in preview(df, 2, F.desc("n"), "s").collect()] == [(2, "a"), (2, "b")]


def test_attach_features_needs_a_key(spark):
    left = literal_table(spark, [(1, "a"), (2, "b")], "id int, s string")
    right = literal_table(spark, [(2, 0.5), (1, 0.1)], "id int, x double")
    assert sorted(tuple(r) for r in attach_features(left, right, "id").collect()) == [
        (1, "a", 0.1), (2, "b", 0.5)]
    with pytest.raises(ValueError, match="key"):
        attach_features(left, right, [])
    with pytest.raises(ValueError, match="both sides"):
        attach_features(left, right.withColumnRenamed("x", "s"), "id")


@pytest.mark.parametrize("rows_bound, hot_keys", [(10**6, 10**5), (0, 4), (0, 10**5), (0, 1)])
@pytest.mark.parametrize("weight", [None, "n"])
def test_attach_lookup_is_whole_whatever_the_way(spark, monkeypatch, rows_bound, hot_keys, weight):
    monkeypatch.setattr(limits, "BROADCAST_ROWS", rows_bound)
    monkeypatch.setattr(limits, "HOT_KEYS", hot_keys)
    # Key 0 holds a third of the rows, key 1 a third without an entry, some have no key.
    key = (F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, 1)
           .when(F.col("id") % 30 == 2, F.lit(None)).otherwise(F.col("id")))
    df = spark.range(3000).withColumn("k", key)
    lookup = (df.where("k is not null and k <> 1").groupBy("k").agg(F.count("*").alias("n"))
              .withColumn("v", F.col("k") * 10))
    result = attach_lookup(df, lookup, "k", "v", default=-1, weight=weight)
    got = {r.id: (r.k, r.v) for r in result.collect()}
    assert result.count() == 3000 and len(got) == 3000
    for k, v in got.values():
        assert v == (-1 if k is None or k == 1 else k * 10)


def test_attach_lookup_splits_off_long_heavy_keys(spark, monkeypatch):
    monkeypatch.setattr(limits, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(limits, "HOT_KEYS", 4)
    key = F.when(F.col("id") % 3 == 0, F.lit("x" * 5000)).otherwise(F.col("id").cast("string"))
    df = spark.range(600).withColumn("k", key)
    lookup = df.groupBy("k").agg(F.min("id").alias("v"))
    result = attach_lookup(df, lookup, "k", "v")
    assert result.columns == ["k", "id", "v"]
    got = {r.id: r.v for r in result.collect()}
    assert got == {i: 0 if i % 3 == 0 else i for i in range(600)}


def test_positions_and_earlier_totals_over_many_partitions(spark):
    df = spark.range(0, 5000, 1, 16).select(
        (F.pmod(F.xxhash64("id"), F.lit(100000))).alias("x"), "id", (F.col("id") % 7).alias("w")
    )
    expected = sorted((r.x, r.id, r.w) for r in df.collect())
    placed = with_position(df, ["x", "id"]).collect()
    assert {(r.x, r.id): r.position for r in placed} == {
        (x, i): n for n, (x, i, _) in enumerate(expected)}
    totals, running = {}, 0
    for x, i, w in expected:
        totals[(x, i)] = running
        running += w
    summed = with_earlier_totals(df, ["x", "id"], {"before": "w"}).collect()
    assert {(r.x, r.id): r.before for r in summed} == totals


def test_positions_of_nothing(spark):
    assert with_position(spark.range(0), ["id"]).count() == 0


def test_split_by_key_ignores_layout(spark):
    df = spark.range(2000)
    one = {r.id for r in split_by_key(df.repartition(1), "id", 80)[0].collect()}
    train, rest = split_by_key(df.repartition(13), "id", 80)
    many, held = {r.id for r in train.collect()}, {r.id for r in rest.collect()}
    assert one == many and not many & held and many | held == set(range(2000))
    assert 0.75 < len(many) / 2000 < 0.85
    assert {r.id for r in sample_by_key(df, "id", 25).collect()} <= many


def test_rows_without_a_key_are_not_lost(spark):
    df = literal_table(spark, [(None,), (1,), (2,)], "id int")
    train, rest = split_by_key(df, "id", 50)
    assert train.count() + rest.count() == 3
    assert fold_by_key(df, "id", 2).where("fold is null").count() == 0


def test_another_salt_cuts_a_part_independently(spark):
    train, _ = split_by_key(spark.range(4000), "id", 50)
    again = sample_by_key(train, "id", 50, salt="second").count() / train.count()
    assert sample_by_key(train, "id", 50).count() == train.count() and 0.4 < again < 0.6


def test_folds_cover_all_rows(spark):
    sizes = dict(fold_by_key(spark.range(2000), "id", 2).groupBy("fold").count().collect())
    assert set(sizes) == {0, 1} and sum(sizes.values()) == 2000 and min(sizes.values()) > 800


def test_random_split_is_exact_in_any_layout(spark):
    for weights, sizes in ([0.99, 0.01], [1980, 20]), ([1, 0, 2, 3], [333, 0, 667, 1000]):
        found = []
        for df in (spark.range(2000), spark.range(0, 2000, 1, 3).orderBy("id")):
            parts = random_split(df, weights, 10, "id")
            found.append([{r.id for r in part.collect()} for part in parts])
        assert found[0] == found[1] and [len(p) for p in found[0]] == sizes
        assert set().union(*found[0]) == set(range(2000))
    other = random_split(spark.range(2000), [0.99, 0.01], 11, "id")[1]
    assert {r.id for r in other.collect()} != {
        r.id for r in random_split(spark.range(2000), [0.99, 0.01], 10, "id")[1].collect()}


def test_random_split_of_repeated_and_missing_keys(spark):
    df = spark.createDataFrame([(1,)] * 50 + [(None,)] * 30 + [(n,) for n in range(2, 22)],
                               "id int")
    parts = [part.groupBy("id").count().collect() for part in random_split(df, [1, 1], 3, "id")]
    keys = [{r["id"] for r in part} for part in parts]
    assert not keys[0] & keys[1] and len(keys[0] | keys[1]) == 22
    assert sum(r["count"] for part in parts for r in part) == 100
    assert [p.count() for p in random_split(df.limit(0), [1, 1], 3, "id")] == [0, 0]
    with pytest.raises(ValueError, match="weights"):
        random_split(df, [0, 0], 3, "id")
