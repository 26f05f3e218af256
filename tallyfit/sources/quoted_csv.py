"""CSV files with line breaks inside quotes, read by as many tasks as there are input splits.

A line scan cuts files at byte ranges and cannot tell whether a line begins inside quotes. The
number of quotes in a range is odd or even whatever stands before it, so a first pass counts
them per range, and the sum over all earlier ranges of the file says how each range begins. A
second pass, in the same ranges, joins lines to records. A record that crosses the border of
ranges arrives in parts, which are put together afterwards: a range has two parts at most.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
    TimestampType,
)

from .. import limits
from .row_places import FILE, ORDER, RANGE, with_places
from .scratch import write_once

WHOLE, HEAD, MIDDLE, TAIL = 0, 1, 2, 3
_PARTS = f"{FILE} string, {RANGE} long, kind int, number long, record string"
_DATE = r"^\d{4}-\d{2}-\d{2}$"
_TRUTH = r"^(?i)(true|false)$"
_TIME = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?$"


_SHAPES = {"date": _DATE, "timestamp": _TIME, "boolean": _TRUTH}

#: Types that values may turn out to have, the narrowest first.
_TYPES = {"int": IntegerType(), "bigint": LongType(), "double": DoubleType(), "date": DateType(),
          "timestamp": TimestampType(), "boolean": BooleanType(), "string": StringType()}


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    scan = spark.read.option("lineSep", "\n").text(path)
    return with_places(scan.withColumnRenamed("value", "line"))


def _range_starts(lines: DataFrame) -> DataFrame:
    """``(file, range, inside)``: whether each range begins inside quotes. A file whose quotes do
    not pair has no reading and is refused."""
    quotes = F.length("line") - F.length(F.translate("line", '"', ""))
    counted = lines.groupBy(FILE, RANGE).agg((F.sum(quotes) % 2).alias("odd"))
    upto = Window.partitionBy(FILE).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    starts = write_once(counted.select(
        FILE, RANGE, "odd", (F.coalesce(F.sum("odd").over(upto), F.lit(0)) % 2 == 1)
        .alias("inside")), "ranges")
    broken = starts.groupBy(FILE).agg(F.sum("odd").alias("odd")).where("odd % 2 = 1").first()
    if broken:
        raise ValueError(f"quotes do not pair in {broken[FILE]}; scan it with whole_files=True")
    return starts.drop("odd")


class _Range:
    """Records of one range, of which lines come in order."""

    def __init__(self, file: str, start: int, inside: bool):
        self.file, self.start = file, start
        self.inside, self.began_inside = inside, inside
        self.open: list[str] = []
        self.records = 0

    def take(self, lines: pa.Array) -> tuple[list, list, list]:
        """Kinds, numbers in the range and texts of the records that end in these lines."""
        odd = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False) % 2
        inside = (np.cumsum(odd) + self.inside) % 2 == 1
        ends = np.flatnonzero(~inside)
        kinds, numbers, texts = [], [], []
        at = 0
        # A line that is a record of its own is taken as it is; others are joined.
        content = lines.to_pylist()
        for end in ends.tolist():
            if end > at or self.open:
                text = "\n".join([*self.open, *content[at:end + 1]])
                self.open = []
            else:
                text = content[end]
            at = end + 1
            if text in ("", "\r"):
                continue
            kinds.append(HEAD if self.began_inside else WHOLE)
            numbers.append(self.records)
            texts.append(text)
            # A record counts in the range where it begins.
            self.records += not self.began_inside
            self.began_inside = False
        self.open += content[at:]
        self.inside = bool(inside[-1]) if len(inside) else self.inside
        return kinds, numbers, texts

    def rest(self) -> tuple[list, list, list]:
        if not self.open:
            return [], [], []
        kind = MIDDLE if self.began_inside else TAIL
        return [kind], [self.records], ["\n".join(self.open)]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: _Range | None = None

    def made(own: _Range, kinds: list, numbers: list, texts: list) -> pa.RecordBatch:
        count = len(kinds)
        return pa.RecordBatch.from_arrays(
            [pa.array([own.file] * count, pa.string()), pa.array([own.start] * count, pa.int64()),
             pa.array(kinds, pa.int32()), pa.array(numbers, pa.int64()),
             pa.array(texts, pa.string())], names=[FILE, RANGE, "kind", "number", "record"])

    for batch in batches:
        if not len(batch):
            continue
        file, start = batch.column(FILE), batch.column(RANGE)
        code = file.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        place = start.to_numpy(zero_copy_only=False)
        borders = np.flatnonzero((code[1:] != code[:-1]) | (place[1:] != place[:-1])) + 1
        edges = [0, *borders.tolist(), len(batch)]
        for a, b in zip(edges, edges[1:]):
            name, at = file[a].as_py(), start[a].as_py()
            if now is None or (now.file, now.start) != (name, at):
                if now is not None:
                    yield made(now, *now.rest())
                now = _Range(name, at, batch.column("inside")[a].as_py())
            yield made(now, *now.take(batch.column("line").slice(a, b - a)))
    if now is not None:
        yield made(now, *now.rest())


def csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The records of CSV files as texts ``record``, line breaks included, with their file, the
    range in which they begin and their number there. Empty lines between records are left out.

    Inside a quoted value a quote is doubled; a quote inside a value without quotes would count
    as an opening one. Lines end with LF or CR LF. Each input split is read by a task of its
    own; the records are written down once, for the passes that follow.
    """
    lines = _lines(spark, path)
    starts = _range_starts(lines)
    if starts.count() <= limits.BROADCAST_ROWS:
        placed = lines.join(F.broadcast(starts), [FILE, RANGE])
    else:  # one row for each split is too much to broadcast
        placed = lines.join(starts, [FILE, RANGE]).repartition(FILE, RANGE).sortWithinPartitions(
            FILE, RANGE, ORDER)
    parts = placed.select(FILE, RANGE, "line", "inside").mapInArrow(_cut, _PARTS)
    parts = write_once(parts, "csv-records")
    pieces = parts.where(F.col("kind") != WHOLE)
    # A part belongs to the last record that was open when its range began.
    order = Window.partitionBy(FILE).orderBy(RANGE, "kind")
    owner = F.max(F.when(F.col("kind") == TAIL, F.col(RANGE))).over(
        order.rowsBetween(Window.unboundedPreceding, 0))
    piece = F.struct(RANGE, "kind", "record", "number")
    joined = pieces.withColumn("_owner", owner).groupBy(FILE, "_owner").agg(
        F.array_sort(F.collect_list(piece)).alias("p"))
    crossing = joined.select(
        FILE, F.col("_owner").alias(RANGE), F.col("p")[0]["number"].alias("number"),
        F.array_join("p.record", "\n").alias("record"))
    records = parts.where(F.col("kind") == WHOLE).drop("kind").unionByName(crossing)
    ended = F.when(F.endswith("record", F.lit("\r")), F.expr("left(record, length(record) - 1)"))
    return records.withColumn("record", F.coalesce(ended, F.col("record")))


def _is_header() -> Column:
    return (F.col(RANGE) == 0) & (F.col("number") == 0)


def _numbered(records: DataFrame, name: str) -> DataFrame:
    """Add the number of each row in all files, from 0, without headers. What is summed up and
    broadcast has one row for each range."""
    counts = records.where(~_is_header()).groupBy(FILE, RANGE).agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy(FILE, RANGE).rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        FILE, RANGE, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("number") - (F.col(RANGE) == 0).cast("long")
    return records.join(F.broadcast(before), [FILE, RANGE], "left").withColumn(name, place)


def header_names(header: str) -> list[str]:
    """Column names from a header record: a missing name gets a number, so does a repeated one."""
    names = next(csv.reader([header], strict=True))
    lower = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if lower.count(n.lower()) > 1 else n
            for i, n in enumerate(names)]


def _parsed(
    records: DataFrame, schema: StructType, null_value: str, more: list[str] | None = None
) -> DataFrame:
    options = {"escape": '"', "multiLine": "true", "nullValue": null_value}
    columns = F.from_csv("record", ddl(schema), options)
    more = more or []
    return records.where(~_is_header()).select(*more, columns.alias("_parsed")).select(
        *[F.col("_parsed").getField(f.name).alias(f.name) for f in schema.fields], *more)


def ddl(schema: StructType) -> str:
    """A schema as text, as the parser takes it; names may hold any character."""
    names = ["`" + f.name.replace("`", "``") + "`" for f in schema.fields]
    return ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, schema.fields))


def _inferred(strings: DataFrame) -> StructType:
    """The narrowest type that all values of a column have: int, bigint, double, date,
    timestamp, boolean, else string; one aggregate decides for all columns."""
    def fits(column: Column, kind: str) -> Column:
        shape = {k: F.rlike(column, F.lit(p)) for k, p in _SHAPES.items()}
        fine = column.try_cast(kind).isNotNull() & (F.trim(column) == column)
        return F.bool_and(column.isNull() | fine & shape.get(kind, F.lit(True)))

    kinds = [*_TYPES][:-1]
    names = strings.columns
    row = strings.agg(
        *[fits(_named(n), k).alias(f"{i}_{k}") for i, n in enumerate(names) for k in kinds],
        *[F.count(_named(n)).alias(f"{i}_n") for i, n in enumerate(names)]).first()
    empty = StructType()
    for i, name in enumerate(names):
        kind = next((k for k in kinds if row[f"{i}_{k}"] and row[f"{i}_n"]), "string")
        empty = empty.add(StructField(name, _TYPES[kind]))
    return empty


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def read_quoted_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    infer: bool = True,
    null_value: str = "\u0000",
    row_number: str | None = None,
) -> DataFrame:
    """Scan CSV files with a header whose quoted values may hold line breaks, in parallel
    within each file. Names come from the header of the first file; all files must have the
    same one. Files without a record give a table without columns. ``row_number`` names a
    column with the place of each row in all files, in order of their paths, to be added."""
    records = csv_records(spark, path)
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if schema is None:
        header = records.where(_is_header()).orderBy(FILE).first()
        if header is None:
            return spark.createDataFrame([], StructType())
        names = header_names(header["record"])
        schema = StructType([StructField(n, StringType()) for n in names])
        if infer:
            schema = _inferred(_parsed(records, schema, null_value))
    if row_number is None:
        return _parsed(records, schema, null_value)
    return _parsed(_numbered(records, row_number), schema, null_value, [row_number])
