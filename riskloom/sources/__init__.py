from riskloom.sources.csv import cast_to, read_csv_inferred, read_csv_named, read_csv_typed, read_text_csv
from riskloom.sources.table import parse_form, read_table, request_frame

__all__ = [
    "cast_to",
    "read_csv_inferred",
    "read_csv_named",
    "read_csv_typed",
    "parse_form",
    "read_table",
    "read_text_csv",
    "request_frame",
]
