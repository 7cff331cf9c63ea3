"""Readers: the driver's Parquet tables, files of text/CSV/JSON, and record parsers."""

from tessera.sources.tables import TABLES, Tables, read_table
from tessera.sources.files import (
    read_lines, read_whole_files, read_listed_files, write_whole_files, read_csv, read_json_lines, split_corrupt, read_parquet,
)
from tessera.sources import parsers

__all__ = [
    "TABLES", "Tables", "read_table", "read_lines", "read_whole_files", "read_listed_files", "write_whole_files", "read_csv",
    "read_json_lines", "split_corrupt", "read_parquet", "parsers",
]
