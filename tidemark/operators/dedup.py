"""Duplicate removal whose result does not depend on task order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def _orderable(field: T.StructField):
    """A map has no order of its own; its sorted entries have."""
    column = F.col(f"`{field.name}`")
    return F.sort_array(F.map_entries(column)) if isinstance(field.dataType, T.MapType) else column


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest by ``order``, ties broken by all other columns.

    Spark limits each group to one row before the shuffle as well as after it, so a key
    that holds a large share of the rows sends one row per task, not all of them.
    """
    if not keys:
        raise ValueError("duplicate removal needs at least one column")
    unknown = [c for c in [*keys, *order] if c not in df.columns]
    if unknown:
        raise ValueError("unknown columns: " + ", ".join(unknown))
    rest = [_orderable(f) for f in df.schema if f.name not in keys and f.name not in order]
    sorting = [*order, *rest] or list(keys)
    window = Window.partitionBy(*keys).orderBy(*sorting)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def drop_duplicates(df: DataFrame, fields: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """``["*"]`` compares whole rows, otherwise one row per listed columns survives."""
    if list(fields) == ["*"]:
        return distinct_rows(df)
    return first_per_key(df, list(fields), list(order))
