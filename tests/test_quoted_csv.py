"""Quoted CSV read by ranges, row numbers, and tables put together by them."""

import random

import pytest
from pyspark.sql import functions as F

from tallyfit.operators import attach_by_position, attach_features
from tallyfit.sources import csv_records, literal_table, new_folder, read_csv, with_row_numbers
from tallyfit.sources.quoted_csv import header_names

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def ranges(spark):
    """Files are cut at every so many bytes."""
    before = {k: spark.conf.get(k) for k in (SPLIT, "spark.sql.files.openCostInBytes")}

    def cut(size):
        spark.conf.set(SPLIT, str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield cut
    for name, value in before.items():
        spark.conf.set(name, value)


def save(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, content in files.items():
        (folder / f"{name}.csv").write_bytes(content.encode())
    return str(folder)


def quoted(value):
    return '"' + value.replace('"', '""') + '"'


def test_a_quote_across_every_border(spark, ranges, tmp_path):
    rows = [("1", "a\nb"), ("2", 'x "y"\n\n, z'), ("3", "plain"), ("4", '"\n"'), ("5", "é\r\nü")]
    content = "id,text\n" + "".join(f"{i},{quoted(t)}\n" for i, t in rows)
    path = save(tmp_path / "t", a=content)
    for size in (5,):
        ranges(size)
        found = read_csv(spark, path, "id string, text string", row_number="n")
        assert sorted(map(tuple, found.collect())) == [
            (i, t, n) for n, (i, t) in enumerate(rows)], size


def test_long_records_and_many_files(spark, ranges, tmp_path):
    pick = random.Random(5)
    files, expected = {}, []
    for name in "abc":
        lines = ["id,text"]
        for n in range(20):
            text = "".join(pick.choice('xy ,\n"') for _ in range(pick.choice([0, 3, 30, 300])))
            expected.append((f"{name}{n}", text))
            lines += [f"{name}{n},{quoted(text)}"] + [""] * pick.choice([0, 0, 2])
        files[name] = "\r\n".join(lines) + ("\r\n" if name == "a" else "")
    path = save(tmp_path / "t", **files)
    whole = read_csv(spark, path, whole_files=True)
    for size in (500,):
        ranges(size)
        found = read_csv(spark, path, row_number="n")
        assert [(r.id, r.text) for r in found.orderBy("n").collect()] == expected
        assert [r.n for r in found.orderBy("n").collect()] == list(range(len(expected)))
        assert sorted(map(tuple, found.drop("n").collect())) == sorted(map(tuple, whole.collect()))


def test_as_many_tasks_as_ranges(spark, ranges, tmp_path):
    path = save(tmp_path / "t", a="id,text\n" + '1,"a\nb"\n' * 4000)
    ranges(8000)
    records = csv_records(spark, path)
    assert records.count() == 4001
    tasks = spark.read.text(path).rdd.getNumPartitions()
    assert tasks >= 4 and records.select("_range").distinct().count() == tasks


def test_types_are_those_of_the_other_scan(spark, tmp_path):
    content = ("i,l,d,day,at,b,s,blank,mixed\n"
               '1,3000000000,1.5,2020-01-02,2020-01-02 03:04:05,true,"a\nb",,1\n'
               "-7,4,1e3,2021-12-31,2021-01-02 00:00:00,FALSE,x,,y\n")
    path = save(tmp_path / "t", a=content)
    found, other = read_csv(spark, path), read_csv(spark, path, whole_files=True)
    assert found.dtypes == other.dtypes
    assert sorted(map(str, found.collect())) == sorted(map(str, other.collect()))
    assert header_names('a,,A,"b,c"') == ["a0", "_c1", "A2", "b,c"]


def test_quotes_must_pair(spark, tmp_path):
    path = save(tmp_path / "t", a='id,text\n1,5" disk\n2,x\n')
    with pytest.raises(ValueError, match="whole_files"):
        read_csv(spark, path)
    assert read_csv(spark, path, whole_files=True).count() == 2


def test_headers_alone_and_no_records(spark, tmp_path):
    only = read_csv(spark, save(tmp_path / "a", a="id,text\n", b="id,text\n"))
    assert only.columns == ["id", "text"] and only.count() == 0
    assert read_csv(spark, save(tmp_path / "b", a="")).columns == []


def test_attach_by_position(spark, ranges, tmp_path):
    left = save(tmp_path / "l", a="x\n" + "".join(f'"{n}\n"\n' for n in range(500)))
    right = save(tmp_path / "r", a="y\n" + "".join(f"{n}\n" for n in range(200)),
                 b="y\n" + "".join(f"{n}\n" for n in range(200, 500)))
    ranges(300)
    a = read_csv(spark, left, "x string", row_number="n")
    b = read_csv(spark, right, "y int", multi_line=False, row_number="n")
    found = attach_by_position(a, b, "n")
    assert found.count() == 500
    assert found.where(F.col("x") != F.concat("y", F.lit("\n"))).count() == 0
    with pytest.raises(ValueError, match="unequal length"):
        attach_by_position(a, b.where("y > 3"), "n")
    with pytest.raises(ValueError, match="both sides"):
        attach_by_position(a, a, "n")


def test_row_numbers_follow_the_files(spark, ranges, tmp_path):
    path = new_folder(spark, "numbers")
    spark.range(0, 5000, 1, 3).write.parquet(path)
    ranges(2000)
    found = with_row_numbers(spark.read.parquet(path), "n")
    assert found.where("n <> id").count() == 0 and found.count() == 5000


def test_repeated_keys_are_refused(spark):
    rows = literal_table(spark, [(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    twice = literal_table(spark, [(1, 5), (1, 6), (3, 7)], "k int, w int")
    with pytest.raises(Exception, match="repeated key"):
        attach_features(rows, twice, "k").collect()
    nulls = literal_table(spark, [(1, 5), (None, 6), (None, 7)], "k int, w int")
    assert [tuple(r) for r in attach_features(rows, nulls, "k").collect()] == [(1, "a", 5)]
    assert attach_features(rows, nulls, "k", "left").count() == 3
