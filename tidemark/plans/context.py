"""Run parameters of a job, read from its one control row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tidemark.functions.names import partition_context
from tidemark.functions.quality import PROCESS_FIELDS, missing_fields, required_fields
from tidemark.functions.refdate import with_reference_context


def single_row(rows: DataFrame, what: str) -> Row:
    """The only row of ``rows``; none or several is an error. Reads at most two rows."""
    found = rows.take(2)
    if len(found) != 1:
        raise ValueError(f"{what}: expected one row, found {'none' if not found else 'several'}")
    return found[0]


def rows_of(rows: DataFrame, **keys: str) -> DataFrame:
    """Rows with these key values. Sequential ids need the rest of their key as well."""
    for name, value in keys.items():
        rows = rows.where(F.col(name) == F.lit(value))
    return rows


def ingestion_context(ledger: DataFrame, ingestion_id: str, **keys: str) -> dict[str, str]:
    """Placeholders of a SOR load, including ``PARTITION_<NAME>`` for each partition."""
    rows = required_fields(rows_of(ledger, ingestion_id=ingestion_id, **keys))
    row = single_row(
        rows.withColumn("_context", partition_context(F.col("partitions"))),
        f"ingestion {ingestion_id}",
    )
    if row["problems"]:
        detail = ", ".join([*row["problems"], *row["missing_fields"]])
        raise ValueError(f"ingestion {ingestion_id} cannot be loaded: {detail} (status {row['status']})")
    names = (
        "ingestion_id",
        "process_name",
        "source_database_name",
        "source_table_name",
        "sor_database_name",
        "sor_table_name",
    )
    return {**{n.upper(): str(row[n]) for n in names}, **{k: str(v) for k, v in row["_context"].items()}}


def process_parameters(
    process: DataFrame, process_id: str, run_date=None, **keys: str
) -> dict[str, str]:
    """Placeholders of a SOT or SPEC run, including the parts of the reference date."""
    rows = rows_of(process, process_id=process_id, **keys).select(*PROCESS_FIELDS)
    row = single_row(
        with_reference_context(
            rows.withColumn("problems", missing_fields(PROCESS_FIELDS)), "data_referencia", run_date
        ),
        f"process {process_id}",
    )
    if row["problems"] or not row["data_ref_valida"]:
        detail = ", ".join(row["problems"]) or f"data_referencia {row['data_referencia']}"
        raise ValueError(f"process {process_id} is not usable: {detail}")
    parts = (
        "data_atual",
        "ano_data_ref",
        "mes_data_ref",
        "ano_mes_data_ref",
        "mes_anterior",
        "ano_mes_anterior",
    )
    return {
        "PROCESS_ID": row["process_id"],
        "PROCESS_NAME": row["process_name"],
        "DATA_REF": row["data_referencia"],
        **{p.upper(): row[p] for p in parts},
    }


def fill_constants(columns: Mapping[str, str], context: Mapping[str, str]) -> dict[str, str]:
    """Stamped values with their placeholders filled; unknown names are an error."""
    try:
        return {k: str(v).format_map(context) for k, v in columns.items()}
    except KeyError as unknown:
        raise ValueError(f"unknown placeholder: {unknown.args[0]}") from None
