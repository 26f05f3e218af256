"""Reading and writing tables."""

from .csv_files import read_csv, read_csv_strings, write_csv
from .quoted_csv import csv_records, read_quoted_csv
from .row_places import with_row_numbers
from .scratch import new_folder, scratch_folder, write_once
from .tables import literal_table, load, spread, text_set

__all__ = [
    "csv_records", "literal_table", "load", "new_folder", "read_csv", "read_csv_strings",
    "read_quoted_csv", "scratch_folder", "spread", "text_set", "with_row_numbers", "write_csv",
    "write_once",
]
