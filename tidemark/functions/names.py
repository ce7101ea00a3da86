"""Names, flags, partition maps and partition paths as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefix of partition placeholders, directory name of a null partition.
PARTITION_PREFIX = "PARTITION_"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def normalize_name(value: Column) -> Column:
    """Upper case, with anything outside ``A-Z 0-9 _`` turned into ``_``."""
    return F.regexp_replace(F.upper(value), "[^A-Z0-9_]", "_")


def sor_name(process_name: Column, entity: Column) -> Column:
    return F.concat(process_name, F.lit("_"), entity)


def zero_padded(number: Column, width: int) -> Column:
    """Number with leading zeros; a longer one keeps all its digits."""
    text = number.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def partition_context(partitions: Column) -> Column:
    """Map of partitions -> map keyed ``PARTITION_<NAME>``.

    A map's entries have no order of their own, so where names collide the entry whose
    original name is last as text wins.
    """
    named = F.transform(
        F.array_sort(F.map_entries(partitions)),
        lambda e: F.struct(F.concat(F.lit(PARTITION_PREFIX), normalize_name(e["key"])).alias("key"), e["value"].alias("value")),
    )
    return last_entries(named)


def with_value(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` and lambdas in it
    refer to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def last_entries(entries: Column) -> Column:
    """Array of ``key, value`` -> map. Of entries with one key the last wins."""

    def kept(found: Column) -> Column:
        backwards = F.reverse(F.transform(found, lambda e: e["key"]))
        return with_value(
            backwards,
            lambda keys: F.filter(found, lambda e, i: F.array_position(keys, e["key"]) == F.size(keys) - i),
        )

    return F.map_from_entries(with_value(entries, kept))


def partition_path(base: Column, table: Column, keys: Sequence[str]) -> Column:
    """``<base>/<table>/<k1=v1>/<k2=v2>/`` of a row, for manifests and reports."""
    parts = [
        F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit(NULL_PARTITION)))
        for k in keys
    ]
    return F.concat(F.concat_ws("/", F.rtrim(base, F.lit("/")), table, *parts), F.lit("/"))


def stripped(value: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.btrim(value, F.lit(" \t\n\r\x0b\x0c"))


def clean_mode(value: Column) -> Column:
    """Modes and kinds are compared trimmed and in lower case."""
    return F.lower(stripped(value))


def flag_is_true(value: Column) -> Column:
    """True only for the text ``true`` in any case; null counts as false."""
    return F.coalesce(clean_mode(value) == "true", F.lit(False))


def enabled(flag: Column) -> Column:
    """Optional flags of configuration rows: an absent one means enabled."""
    return F.coalesce(flag, F.lit(True))
