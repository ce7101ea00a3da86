"""Configured sources -> named DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.predicates import clean_predicate
from tidemark.functions.templates import fill_name
from tidemark.operators.dedup import drop_duplicates
from tidemark.sources.files import read_csv, read_parquet
from tidemark.sources.tables import PRODUCTION, read_table
from tidemark.specs import SOURCE_KINDS, SourceSpec


def effective_predicate(
    source: SourceSpec,
    argument_overrides: Mapping[str, str] | None = None,
    table_overrides: Mapping[str, str] | None = None,
) -> str | None:
    """Argument, then control table, then the source's own predicate; blank is absent."""
    candidates = (
        (argument_overrides or {}).get(source.name),
        (table_overrides or {}).get(source.name),
        source.predicate,
    )
    return next((p.strip() for p in candidates if p and p.strip()), None)


def override_mapping(overrides: DataFrame | Mapping[str, str] | None, sources: Sequence[SourceSpec]) -> Mapping[str, str]:
    """Predicates for these sources, of a mapping or of a table with ``source_name`` and
    ``predicate``. At most one row per source is fetched; where a source has several, the
    predicate that is first as text counts."""
    if not isinstance(overrides, DataFrame):
        return overrides or {}
    named = overrides.where(F.col("source_name").isin(*{s.name for s in sources}))
    one = named.groupBy("source_name").agg(F.min(clean_predicate(F.col("predicate"))).alias("predicate"))
    return {r["source_name"]: r["predicate"] for r in one.collect()}


def load_source(
    spark: SparkSession,
    source: SourceSpec,
    params: Mapping[str, str] | None = None,
    predicate: str | None = None,
    environment: str = PRODUCTION,
    local: str | bool = False,
) -> DataFrame:
    """Scan, filter and de-duplicate one source; nothing runs yet.

    Placeholders in path, database and table are filled from ``params``.
    """
    names = {n: fill_name(getattr(source, n), params or {}) for n in ("path", "database", "table")}
    source = replace(source, **names)
    kind = source.kind.strip().lower()
    text = source.predicate if predicate is None else predicate
    if kind not in SOURCE_KINDS:
        raise ValueError("source kind must be one of: " + ", ".join(SOURCE_KINDS))
    if kind == "csv":
        df = read_csv(
            spark,
            source.path,
            schema=source.schema,
            predicate=text,
            params=params,
            header=source.header,
            delimiter=source.delimiter,
            quote=source.quote,
            escape=source.escape,
            infer_schema=source.infer_schema,
            encoding=source.encoding,
        )
    elif source.path is not None:
        df = read_parquet(
            spark,
            source.path,
            schema=source.schema if source.use_catalog_schema else None,
            predicate=text,
            params=params,
            merge_schema=not source.use_catalog_schema,
        )
    else:
        df = read_table(
            spark, source.database, source.table, text, params, environment, local, source.use_catalog_schema
        )
    if source.duplicate_fields is not None:
        df = drop_duplicates(df, source.duplicate_fields, source.duplicate_order)
    return df


def load_sources(
    spark: SparkSession,
    sources: Sequence[SourceSpec],
    params: Mapping[str, str] | None = None,
    argument_overrides: Mapping[str, str] | None = None,
    table_overrides: DataFrame | Mapping[str, str] | None = None,
    environment: str = PRODUCTION,
    local: str | bool = False,
    source_params: Mapping[str, Mapping[str, str]] | None = None,
) -> dict[str, DataFrame]:
    """One DataFrame per source, by view name. Two sources with one name are an error.

    ``source_params`` adds parameters for single views, such as their locked version;
    ``table_overrides`` may be the control table itself, as ``override_rows`` or
    ``override_scalars`` give it for a run.
    """
    views = [s.view for s in sources]
    repeated = sorted({v for v in views if views.count(v) > 1})
    if repeated:
        raise ValueError("view name used twice: " + ", ".join(repeated))
    table_overrides = override_mapping(table_overrides, sources)
    return {
        s.view: load_source(
            spark,
            s,
            {**(params or {}), **(source_params or {}).get(s.view, {})},
            effective_predicate(s, argument_overrides, table_overrides),
            environment,
            local,
        )
        for s in sources
    }
