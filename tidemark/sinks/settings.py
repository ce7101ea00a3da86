"""Destination settings from three layers: destination beats environment beats technical."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.specs import DestSpec

# Technical settings a Parquet destination must have.
TECHNICAL_SETTINGS = (
    "group_files",
    "group_size_bytes",
    "compression",
    "block_size_bytes",
)


def destination_settings(
    technical: Mapping[str, object],
    environments: Mapping[str, Mapping[str, object]],
    destination: Mapping[str, object],
    environment: str,
    required: Sequence[str] = TECHNICAL_SETTINGS,
) -> dict[str, object]:
    """Merged settings of one destination; absent required ones are an error."""
    if environment not in environments:
        raise ValueError(f"unknown environment: {environment}")
    merged = {**technical, **environments[environment], **destination}
    absent = [k for k in required if k not in merged]
    if absent:
        raise ValueError("missing write settings: " + ", ".join(absent))
    return merged


def destination_spec(settings: Mapping[str, object], base_path: str, table: str, **given) -> DestSpec:
    """Merged settings as a destination. What ``DestSpec`` has no field for (the grouping of
    files, which ``compact_partitions`` does) is left to the caller; numbers may be text."""
    kinds = {"compression": str, "block_size_bytes": int, "max_records_per_file": int, "kind": str, "database": str, "file_name": str}
    known = {k: kinds[k](v) for k, v in settings.items() if k in kinds and v is not None}
    return DestSpec(base_path, table, **{**known, **given})


def effective_settings(
    destinations: DataFrame,
    environments: DataFrame,
    technical: DataFrame,
    settings: Sequence[str],
    environment_key: str = "environment",
    kind_key: str = "kind",
) -> DataFrame:
    """The same merge over tables: one row per destination, one column per setting."""
    env = environments.select(environment_key, *[F.col(s).alias(f"_env_{s}") for s in settings])
    tech = technical.select(kind_key, *[F.col(s).alias(f"_tech_{s}") for s in settings])
    return (
        destinations.join(env, environment_key, "left")
        .join(tech, kind_key, "left")
        .withColumns({s: F.coalesce(s, f"_env_{s}", f"_tech_{s}") for s in settings})
        .select(*destinations.columns)
    )
