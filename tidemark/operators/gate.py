"""Publication gate, SPEC decision, month view and lineage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.readiness import required_rows
from tidemark.operators.versions import PROCESS_KEYS, VERSION_KEYS, WINDOW_KEYS, full_key

# Process states around publication, publication modes and triggers.
RULES_PROCESSED = "RULES_PROCESSED"
WAITING_SPEC_PUBLICATION = "WAITING_SPEC_PUBLICATION"
PUBLISHING_SPEC = "PUBLISHING_SPEC"
PUBLISHED = "PUBLISHED"
AUTO, AUTO_SPEC = "AUTO", "AUTO_SPEC"

STRICT_GATE = (RULES_PROCESSED,)
MANUAL_GATE = (RULES_PROCESSED, WAITING_SPEC_PUBLICATION)


def publication_gate(
    requests: DataFrame,
    process: DataFrame,
    statuses: Sequence[str] = STRICT_GATE,
    keys: Sequence[str] = PROCESS_KEYS,
) -> tuple[DataFrame, DataFrame]:
    """(publishable, refused) requests. Refused ones leave the process as it is."""
    on = full_key(keys, requests, process)
    ready = process.where(F.col("status").isin(*statuses)).select(*on)
    return requests.join(ready, on, "left_semi"), requests.join(ready, on, "left_anti")


def spec_decision(process: DataFrame, process_config: DataFrame) -> DataFrame:
    """Next step of every process whose rules are done, by publication mode."""
    auto = F.col("spec_execution_mode") == AUTO
    return (
        process.where(F.col("status") == RULES_PROCESSED)
        .join(process_config.select("process_name", "spec_execution_mode"), "process_name")
        .withColumns(
            {
                "spec_trigger": F.when(auto, AUTO_SPEC),
                "next_status": F.when(auto, PUBLISHING_SPEC).otherwise(WAITING_SPEC_PUBLICATION),
            }
        )
    )


def month_view(
    process_config: DataFrame, ingestion: DataFrame, process: DataFrame, locks: DataFrame
) -> DataFrame:
    """Per process, month and required origin: last version, its state and times, the
    last process and the version that process locked."""
    keys, versions = list(WINDOW_KEYS), list(VERSION_KEYS)
    last_load = (
        ingestion.groupBy(*versions)
        .agg(
            F.max_by(
                F.struct("ingestion_id", "status", "created_at", "loaded_at"),
                F.struct("created_at", "ingestion_id"),
            ).alias("_l"),
            F.count(F.lit(1)).alias("versions"),
        )
        .select(
            *versions,
            "versions",
            F.col("_l.ingestion_id").alias("last_ingestion_id"),
            F.col("_l.status").alias("ingestion_status"),
            F.col("_l.created_at").alias("started_at"),
            F.col("_l.loaded_at").alias("finished_at"),
        )
    )
    last_process = (
        process.groupBy(*keys)
        .agg(F.max_by(F.struct("process_id", "status"), F.struct("created_at", "process_id")).alias("_p"))
        .select(
            *keys,
            F.col("_p.process_id").alias("process_id"),
            F.col("_p.status").alias("process_status"),
        )
    )
    months = ingestion.select(*keys).distinct()
    locked = locks.select(*versions, "process_id", F.col("ingestion_id").alias("locked_ingestion_id"))
    return (
        months.join(required_rows(process_config).select("process_name", "sor_table_name"), "process_name")
        .join(last_load, versions, "left")
        .join(last_process, keys, "left")
        .join(locked, [*versions, "process_id"], "left")
        .withColumns(
            {
                "versions": F.coalesce("versions", F.lit(0)),
                "published": F.coalesce(F.col("process_status") == PUBLISHED, F.lit(False)),
            }
        )
    )


def process_lineage(
    spec_processes: DataFrame,
    locks: DataFrame,
    ingestion: DataFrame,
    keys: Sequence[str] = PROCESS_KEYS,
) -> DataFrame:
    """For each published process: which versions of which sources it was made from."""
    origin = ingestion.select(
        *VERSION_KEYS, "ingestion_id", "source_database_name", "source_table_name", "loaded_at"
    )
    own = full_key(keys, spec_processes, locks)
    return (
        spec_processes.select(*own)
        .distinct()
        .join(locks, own)
        .join(origin, [*VERSION_KEYS, "ingestion_id"], "left")
    )
