"""Choice of writer by destination kind."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemark.sinks.catalog import write_catalog_table
from tidemark.sinks.partitions import WriteReport, write_partitions
from tidemark.sinks.text import export_csv
from tidemark.specs import DEST_KINDS, DestSpec


def write_result(df: DataFrame, dest: DestSpec, constant_keys: Sequence[str] = ()) -> WriteReport:
    kind = dest.kind.strip().lower()
    if kind not in DEST_KINDS:
        raise ValueError("destination kind must be one of: " + ", ".join(DEST_KINDS))
    if kind == "csv":
        return export_csv(df, dest)
    if dest.database:
        return write_catalog_table(df, dest, constant_keys)
    return write_partitions(df, dest, constant_keys)
