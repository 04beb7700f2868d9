"""Readers: every source becomes a DataFrame plus a load-order position."""

from starloom.sources.html import extract_first_table, html_columns
from starloom.sources.readers import (
    DAMAGED,
    Source,
    read_csv,
    read_html,
    read_json_columnar,
    read_json_records,
    read_parquet,
    read_source,
    read_tab_packed,
    split_tab_packed,
    columnar_json_rows,
    table_or_empty,
    union_slices,
)

__all__ = [
    "DAMAGED",
    "Source", "columnar_json_rows", "extract_first_table", "html_columns", "read_csv",
    "read_html", "read_json_columnar", "read_json_records", "read_parquet", "read_source",
    "read_tab_packed", "split_tab_packed", "table_or_empty", "union_slices",
]
