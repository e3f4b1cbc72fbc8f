"""Readers and writers."""

from firstmile.sources.files import (
    parsing_impact,
    read_parquet,
    read_text_table,
    write_parquet,
)
from firstmile.sources.keyed import Sink, keyed_table, parquet_table, read_table, versioned_table
from firstmile.sources.versions import Layout

__all__ = [
    "Layout",
    "Sink",
    "keyed_table",
    "parquet_table",
    "parsing_impact",
    "read_parquet",
    "read_table",
    "read_text_table",
    "versioned_table",
    "write_parquet",
]
