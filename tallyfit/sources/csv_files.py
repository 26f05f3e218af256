"""CSV scans and the CSV sink.

Both sides use ``"`` as the escape character and the reader accepts line breaks inside
quotes, so free text survives a round trip unchanged. Such files are cut into records by all
tasks, see :mod:`.quoted_csv`. Pass ``multi_line=False`` for text known to have no line
breaks, which is read in one pass, and ``whole_files=True`` for files with quotes inside
values that are not quoted, which one task must read from their beginning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .quoted_csv import read_quoted_csv
from .row_places import with_row_numbers

QUOTING = {"header": True, "escape": '"'}

# With the default null marker, the empty text, the reader takes a quoted empty text for
# null. A marker that no text holds keeps "" and null apart; nothing at all is null still.
NO_TEXT = "\u0000"


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    multi_line: bool = True,
    null_value: str = NO_TEXT,
    whole_files: bool = False,
    row_number: str | None = None,
) -> DataFrame:
    """Scan CSV files with a header.

    ``row_number`` names a column to add with the place of each row in all files. Without ``schema`` the types are inferred, which reads the files once more. The text
    ``NA`` stays a string unless ``null_value="NA"`` makes it null.
    """
    if multi_line and not whole_files:
        return read_quoted_csv(spark, path, schema, True, null_value, row_number)
    reader = spark.read.options(**QUOTING, multiLine=multi_line, nullValue=null_value)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    scan = reader.csv(path)
    return scan if row_number is None else with_row_numbers(scan, row_number)


def read_csv_strings(
    spark: SparkSession, path: str | list[str], multi_line: bool = True, whole_files: bool = False
) -> DataFrame:
    """Scan CSV files with a header; every column is a string and no pass infers types."""
    if multi_line and not whole_files:
        return read_quoted_csv(spark, path, infer=False, null_value=NO_TEXT)
    return spark.read.options(**QUOTING, multiLine=multi_line, nullValue=NO_TEXT).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write one CSV file with a header per partition of ``df`` into the folder ``path``."""
    (
        df.write.options(
            **QUOTING, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
        .mode(mode)
        .csv(path)
    )
