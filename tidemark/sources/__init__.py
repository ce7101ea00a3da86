"""Scans: catalog tables, Parquet paths, CSV and landing files."""

from tidemark.sources.files import read_csv, read_dated, read_landing, read_parquet
from tidemark.sources.loading import load_source, load_sources
from tidemark.sources.schemas import generations_of, read_generations, resolve_schemas, schema_changes
from tidemark.sources.tables import database_for, read_grouping, read_table

__all__ = [
    "database_for",
    "generations_of",
    "load_source",
    "load_sources",
    "read_csv",
    "read_dated",
    "read_generations",
    "read_grouping",
    "read_landing",
    "read_parquet",
    "read_table",
    "resolve_schemas",
    "schema_changes",
]
