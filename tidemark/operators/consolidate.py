"""Bringing the outputs of several rules or source blocks together."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _tagged_union(frames: Mapping[str, DataFrame], column: str) -> DataFrame:
    tagged = [df.withColumn(column, F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def consolidate(frames: Mapping[str, DataFrame], process_id: str, column: str = "regra") -> DataFrame:
    """Union by name of all rule outputs of one process; missing columns become null."""
    if not frames:
        raise ValueError("nothing to consolidate")
    own = {name: df.where(F.col("process_id") == F.lit(process_id)) for name, df in frames.items()}
    return _tagged_union(own, column)


def two_block_sources(
    catalog: DataFrame, csv: DataFrame, column: str = "bloco_origem"
) -> DataFrame:
    """Catalog block followed by CSV block, each row tagged with its block."""
    return _tagged_union({"catalogo": catalog, "csv": csv}, column)
