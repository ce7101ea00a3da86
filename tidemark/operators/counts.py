"""Row counts and touched partitions without extra passes over the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def observed(df: DataFrame, name: str | None = None) -> tuple[DataFrame, Observation]:
    """The frame plus an observation that holds ``rows`` once an action has run.

    Put it right before the action: there each task's rows are counted once even if
    earlier stages run again.
    """
    observation = Observation(name) if name else Observation()
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def source_counts(df: DataFrame, by: Sequence[str], distinct_on: Sequence[str]) -> DataFrame:
    """Rows and distinct keys per source and partition, as a report."""
    return (
        df.groupBy(*by, *distinct_on)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .groupBy(*by)
        .agg(
            F.sum("_rows").alias("rows_loaded"),
            F.count(F.lit(1)).alias("rows_after_dedup"),
        )
    )


def touched_partitions(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Partition tuples present in the output, with their row counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
