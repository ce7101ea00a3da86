"""Checks on control rows: required fields, expected status, usable partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fields an ingestion row must carry, and the status a load starts from.
INGESTION_FIELDS = (
    "ingestion_id",
    "process_name",
    "source_database_name",
    "source_table_name",
    "sor_database_name",
    "sor_table_name",
    "partitions",
    "status",
)
LOADABLE_STATUS = "PROCESSING_SOR"
PROCESS_FIELDS = ("process_id", "process_name", "data_referencia")


def missing_fields(fields: Sequence[str]) -> Column:
    """Names of the null fields of a row, in the order given."""
    return F.array_compact(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in fields]))


def ingestion_problems(requested_id: Column | None = None) -> Column:
    """Problem codes of an ingestion row; an empty array means it can be loaded."""
    checks = [
        F.when(F.size(missing_fields(INGESTION_FIELDS)) > 0, F.lit("MISSING_FIELDS")),
        F.when(F.col("status") != LOADABLE_STATUS, F.lit("UNEXPECTED_STATUS")),
        F.when(F.size("partitions") == 0, F.lit("EMPTY_PARTITIONS")),
    ]
    if requested_id is not None:
        checks.insert(1, F.when(F.col("ingestion_id") != requested_id, F.lit("ID_MISMATCH")))
    return F.array_compact(F.array(*checks))


def required_fields(df: DataFrame, requested_id: Column | None = None) -> DataFrame:
    """Adds ``missing_fields`` and ``problems`` to a frame of ingestion rows."""
    return df.withColumns(
        {
            "missing_fields": missing_fields(INGESTION_FIELDS),
            "problems": ingestion_problems(requested_id),
        }
    )


def split_valid(df: DataFrame, problems: str = "problems") -> tuple[DataFrame, DataFrame]:
    """(rows without problems, rows with problems)."""
    ok = F.size(problems) == 0
    return df.where(ok).drop(problems), df.where(~ok)
