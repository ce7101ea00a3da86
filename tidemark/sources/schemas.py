"""Tables whose files have grown up with different schemas.

Files of one schema are a generation, read with that schema; its columns are then brought to
the resolved ones. So a column that was added is null in older files, one that became wider
is widened, and what cannot be brought together is refused before anything is read.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
SAME, ADDED, ABSENT, WIDENED = "SAME", "ADDED", "ABSENT", "WIDENED"


def wider(one: T.DataType, other: T.DataType) -> T.DataType | None:
    """The smallest type that holds the values of both exactly; None if there is none."""
    if one == other:
        return one
    kinds = type(one), type(other)
    if all(k in INTEGRAL for k in kinds):
        return max(one, other, key=lambda t: INTEGRAL.index(type(t)))
    if set(kinds) == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if any(k in INTEGRAL[:3] for k in kinds) and any(k in (T.FloatType, T.DoubleType) for k in kinds):
        return T.DoubleType()
    if kinds == (T.DecimalType, T.DecimalType):
        scale = max(one.scale, other.scale)
        digits = max(one.precision - one.scale, other.precision - other.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else None
    return None


def _by_name(schema: T.StructType) -> dict[str, T.StructField]:
    return {f.name.lower(): f for f in schema}


def resolve_schemas(catalog: T.StructType | None, generations: Sequence[T.StructType]) -> T.StructType:
    """Catalog columns, then those that only files have, each in the widest type in use."""
    merged: dict[str, T.StructField] = {}
    for schema in ([catalog] if catalog else []) + list(generations):
        for name, field in _by_name(schema).items():
            if name not in merged:
                merged[name] = T.StructField(field.name, field.dataType)
                continue
            known = merged[name]
            both = wider(known.dataType, field.dataType)
            if both is None:
                raise ValueError(f"column {known.name} is {known.dataType.simpleString()} and {field.dataType.simpleString()}")
            merged[name] = T.StructField(known.name, both)
    return T.StructType(list(merged.values()))


def schema_changes(catalog: T.StructType, generation: T.StructType) -> dict[str, str]:
    """Column by column, what a generation's files are to the catalog's schema."""
    ours, theirs = _by_name(catalog), _by_name(generation)
    out = {f.name: ABSENT if n not in theirs else SAME if theirs[n].dataType == f.dataType else WIDENED for n, f in ours.items()}
    return out | {f.name: ADDED for n, f in theirs.items() if n not in ours}


def generations_of(spark: SparkSession, folders: Sequence[str]) -> dict[str, list[str]]:
    """Schema, as JSON, -> the folders whose files have it. One footer is read per folder: a
    write replaces a partition as a whole, so its files are of one generation."""
    found: dict[str, list[str]] = {}
    for folder in folders:
        schema = spark.read.option("mergeSchema", "false").option("recursiveFileLookup", "true").parquet(folder).schema
        found.setdefault(schema.json(), []).append(folder)
    return found


def read_generations(
    spark: SparkSession,
    base: str,
    generations: Mapping[str, Sequence[str]],
    keys: Sequence[T.StructField] = (),
    catalog: T.StructType | None = None,
) -> DataFrame:
    """One scan per generation, brought to the resolved schema. ``keys`` are the partition
    columns, whose values stand in the paths below ``base``; filters on them prune."""
    schemas = {text: T.StructType.fromJson(json.loads(text)) for text in generations}
    own = [k.name.lower() for k in keys]
    data = T.StructType([f for f in catalog if f.name.lower() not in own]) if catalog else None
    resolved = resolve_schemas(data, list(schemas.values()))
    if not schemas:
        return spark.createDataFrame([], T.StructType([*resolved, *keys]))

    def scan(text: str) -> DataFrame:
        rows = spark.read.schema(T.StructType([*schemas[text], *keys])).option("basePath", base).parquet(*generations[text])
        there = _by_name(schemas[text])
        brought = [
            (F.col(f"`{there[f.name.lower()].name}`") if f.name.lower() in there else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in resolved
        ]
        return rows.select(*brought, *[F.col(f"`{k.name}`") for k in keys])

    return reduce(DataFrame.unionByName, [scan(text) for text in generations])
