"""Which filter a source gets: override texts, override tables and precedence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import last_entries, stripped


def clean_predicate(value: Column) -> Column:
    """Blank predicates count as absent."""
    trimmed = stripped(value)
    return F.when(trimmed != "", trimmed)


def parse_override_list(text: Column) -> Column:
    """``name::predicate;name::predicate`` -> map; the last entry of a name wins.

    Items without ``::`` or with an empty side are ignored. Stays inside the row: no
    explode, no shuffle.
    """
    items = F.transform(
        F.split(F.coalesce(text, F.lit("")), ";"),
        lambda item: F.struct(
            stripped(F.substring_index(item, "::", 1)).alias("key"),
            F.when(
                F.instr(item, "::") > 0,
                stripped(F.substr(item, F.instr(item, "::") + F.lit(2))),
            ).alias("value"),
        ),
    )
    usable = F.filter(items, lambda e: (e["key"] != "") & F.coalesce(e["value"] != "", F.lit(False)))
    return last_entries(usable)


def override_rows(overrides: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Enabled rows of an override table whose predicates are a map, one row per source."""
    return (
        overrides.where(F.coalesce(F.col("enabled"), F.lit(False)))
        .select(
            *keys,
            F.explode(
                F.map_filter("predicates", lambda k, v: (k != "") & (F.coalesce(v, F.lit("")) != ""))
            ).alias("source_name", "predicate"),
        )
    )


def override_scalars(overrides: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Enabled rows of an override table that hold one predicate per source."""
    return overrides.where(
        F.coalesce(F.col("enabled"), F.lit(False)) & clean_predicate(F.col("predicate")).isNotNull()
    ).select(*keys, "source_name", "predicate")


def predicate_precedence(
    sources: DataFrame,
    argument_overrides: DataFrame,
    table_overrides: DataFrame,
    on: Sequence[str] = ("source_name",),
) -> DataFrame:
    """Argument beats control table beats configuration; null means a full scan.

    The two override frames hold ``on`` plus ``predicate``. Where a key is repeated, the
    predicate that is first as text counts, so sources never multiply.
    """
    on = list(on)

    def one_per_key(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy(*on).agg(F.min(clean_predicate(F.col("predicate"))).alias(name))

    arg = one_per_key(argument_overrides, "_arg")
    tab = one_per_key(table_overrides, "_tab")
    own = clean_predicate(F.col("predicate"))
    return (
        sources.join(arg, on, "left")
        .join(tab, on, "left")
        .withColumns(
            {
                "predicate_final": F.coalesce("_arg", "_tab", own),
                "predicate_source": F.when(F.col("_arg").isNotNull(), "ARGUMENT")
                .when(F.col("_tab").isNotNull(), "CONTROL_TABLE")
                .when(own.isNotNull(), "CONFIG")
                .otherwise("NONE"),
            }
        )
        .drop("_arg", "_tab")
    )
