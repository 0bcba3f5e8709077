"""Sources and sinks: tables, text lines, CSV, model tables."""

from sylvan.sources.tables import (
    csv_roundtrip,
    lines_of,
    read_csv,
    read_csv_checked,
    read_table,
    read_text_lines,
    scan_lines,
    write_csv,
)
from sylvan.sources.model_io import load_tables, published_numbers, save_tables

__all__ = [
    "csv_roundtrip", "lines_of", "read_csv", "read_table", "read_text_lines",
    "scan_lines", "write_csv", "read_csv_checked", "load_tables", "published_numbers", "save_tables",
]
