"""The layer jobs. Each is one lazy plan and one write."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import nullcontext
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.templates import fill_name, uses_placeholder
from tidemark.operators.consolidate import consolidate
from tidemark.operators.gate import STRICT_GATE
from tidemark.operators.select import stable_row_id, staged_sql, surrogate_row_id, technical_columns
from tidemark.plans.context import (
    fill_constants,
    ingestion_context,
    process_parameters,
    rows_of,
    single_row,
)
from tidemark.sinks import WriteReport, write_result
from tidemark.sources import load_sources
from tidemark.sources.tables import PRODUCTION, bounded_sorts, grouped_reads
from tidemark.specs import DestSpec, LayerSpec, SourceSpec


def run_layer(
    spark: SparkSession,
    spec: LayerSpec,
    context: Mapping[str, str],
    stamps: Mapping[str, str],
    source_context: Mapping[str, Mapping[str, str]] | None = None,
    argument_overrides: Mapping[str, str] | None = None,
    table_overrides: DataFrame | Mapping[str, str] | None = None,
    environment: str = PRODUCTION,
    local: str | bool = False,
) -> WriteReport:
    """Sources -> SQL steps -> stamped columns -> destination.

    ``post_columns`` of the spec replace ``stamps`` rather than adding to them. Paths and
    names of sources and destination may hold placeholders of the context.
    """
    frames = load_sources(
        spark,
        spec.sources,
        context,
        argument_overrides,
        table_overrides,
        environment,
        local,
        source_context,
    )
    columns = fill_constants(stamps if spec.post_columns is None else spec.post_columns, context)
    result = staged_sql(spark, frames, spec.steps, context)
    if spec.row_id and spec.row_id.order:
        result = stable_row_id(result, spec.row_id.keys, spec.row_id.order, spec.row_id.column)
    elif spec.row_id:
        result = surrogate_row_id(result, spec.row_id.column)
    result = technical_columns(result, columns)
    names = ("base_path", "table", "database", "file_name")
    destination = replace(spec.destination, **{n: fill_name(getattr(spec.destination, n), context) for n in names})
    sorts = any(s.duplicate_fields and list(s.duplicate_fields) != ["*"] for s in spec.sources)
    with bounded_sorts(spark) if sorts else nullcontext(), grouped_reads(spark, spec.read_settings):
        return write_result(result, destination, tuple(columns))


def load_sor(
    spark: SparkSession,
    spec: LayerSpec,
    ledger: DataFrame,
    ingestion_id: str,
    keys: Mapping[str, str] | None = None,
    **options,
) -> WriteReport:
    """Copy one arrival into the SOR, as the version ``ingestion_id``.

    ``keys`` completes the key where ids are sequences per process, table and month.
    """
    context = ingestion_context(ledger, ingestion_id, **(keys or {}))
    return run_layer(spark, spec, context, {"ingestion_id": ingestion_id}, **options)


def resolve_source_locks(
    sources: Sequence[SourceSpec], locks: DataFrame, process_id: str, **keys: str
) -> dict[str, dict[str, str]]:
    """Locked version per source view. Sources that name no version need no lock."""
    versioned = [
        s
        for s in sources
        if s.versioned_by or any(uses_placeholder(t, "INGESTION_ID") for t in (s.predicate, s.path))
    ]
    if not versioned:
        return {}
    wanted = {s.view: s.versioned_by or s.name for s in versioned}
    rows = (
        rows_of(locks, process_id=process_id, **keys)
        .where(F.col("sor_table_name").isin(*set(wanted.values())))
        .select("sor_table_name", "ingestion_id")
        .distinct()
        .take(len(set(wanted.values())) + 1)
    )
    found = {r["sor_table_name"]: r["ingestion_id"] for r in rows if r["ingestion_id"]}
    if len(found) < len(rows):
        raise ValueError(f"process {process_id}: a table is locked twice or without a version")
    absent = sorted(set(wanted.values()) - set(found))
    if absent:
        raise ValueError(f"process {process_id}: no input lock for " + ", ".join(absent))
    return {view: {"INGESTION_ID": found[table]} for view, table in wanted.items()}


def run_rule(
    spark: SparkSession,
    spec: LayerSpec,
    process: DataFrame,
    locks: DataFrame,
    process_id: str,
    rule: str | None = None,
    run_date=None,
    keys: Mapping[str, str] | None = None,
    **options,
) -> WriteReport:
    """One rule of a process: reads SOR at the locked versions, writes SOT."""
    context = process_parameters(process, process_id, run_date, **(keys or {}))
    versions = resolve_source_locks(spec.sources, locks, process_id, **(keys or {}))
    stamps = {"process_id": process_id, **({"regra": rule} if rule else {})}
    return run_layer(spark, spec, context, stamps, source_context=versions, **options)


def consolidate_sot(
    modules: Mapping[str, DataFrame], process_id: str, destination: DestSpec
) -> WriteReport:
    """All rule outputs of a process -> consolidated SOT of that process."""
    return write_result(consolidate(modules, process_id), destination, ("process_id",))


def publish_spec(
    spark: SparkSession,
    spec: LayerSpec,
    process: DataFrame,
    process_id: str,
    locks: DataFrame | None = None,
    statuses: tuple[str, ...] = STRICT_GATE,
    run_date=None,
    keys: Mapping[str, str] | None = None,
    **options,
) -> WriteReport:
    """Official view of a process whose rules are done; otherwise nothing is written."""
    own = rows_of(process, process_id=process_id, **(keys or {}))
    ready = own.where(F.col("status").isin(*statuses))
    single_row(ready.select("process_id"), f"process {process_id} ready for publication")
    context = process_parameters(own, process_id, run_date)
    versions = (
        resolve_source_locks(spec.sources, locks, process_id, **(keys or {})) if locks is not None else {}
    )
    stamps = {"process_id": process_id, "data_referencia": context["DATA_REF"]}
    return run_layer(spark, spec, context, stamps, source_context=versions, **options)
