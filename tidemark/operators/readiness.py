"""Is a month complete, what is missing, and when does it start a run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.versions import LOADED, WINDOW_KEYS

# Execution modes and window states.
LOCKED, MANUAL, FIRST_ONLY, ALWAYS = "LOCKED", "MANUAL", "FIRST_ONLY", "ALWAYS"
WAITING_INPUTS = "WAITING_INPUTS"
MANUAL_REQUIRED = "MANUAL_REQUIRED"
LOCKED_FOR_EXECUTION = "LOCKED_FOR_EXECUTION"


def required_rows(process_config: DataFrame) -> DataFrame:
    """Configuration with one row per process and required origin."""
    return process_config.select(
        "process_name",
        "rules_execution_mode",
        F.size(F.array_distinct("required_origins")).alias("required_count"),
        F.explode(F.array_distinct("required_origins")).alias("sor_table_name"),
    )


def readiness(process_config: DataFrame, current: DataFrame) -> DataFrame:
    """Received map, missing list and state of every (process, month) seen so far.

    ``current`` has one row per process, month and origin, and only required origins are
    collected, so a collected group is never longer than the configured list.
    """
    config = process_config.select(
        "process_name", "rules_execution_mode", F.array_distinct("required_origins").alias("_required")
    )
    received = F.when(
        F.array_contains("_required", F.col("sor_table_name")),
        F.struct("sor_table_name", "current_ingestion_id"),
    )
    return (
        current.join(config, "process_name")
        .groupBy(*WINDOW_KEYS, "rules_execution_mode", "_required")
        .agg(F.map_from_entries(F.sort_array(F.collect_list(received))).alias("received_origins"))
        .withColumn(
            "missing_origins",
            F.sort_array(F.array_except("_required", F.map_keys("received_origins"))),
        )
        .withColumns(
            {
                "required_count": F.size("_required"),
                "received_count": F.size("received_origins"),
                "missing_count": F.size("missing_origins"),
                "window_status": F.when(F.size("missing_origins") > 0, WAITING_INPUTS)
                .when(F.col("rules_execution_mode").isin(MANUAL, LOCKED), MANUAL_REQUIRED)
                .otherwise(LOCKED_FOR_EXECUTION),
            }
        )
        .drop("_required")
    )


def missing_inputs(process_config: DataFrame, current: DataFrame) -> DataFrame:
    """One row per required origin without a loaded version in a month seen so far."""
    return readiness(process_config, current).select(
        *WINDOW_KEYS, F.explode("missing_origins").alias("sor_table_name")
    )


def execution_triggers(
    ingestion: DataFrame, process_config: DataFrame, keys: Sequence[str] = WINDOW_KEYS
) -> DataFrame:
    """Loads that start an automatic run.

    A month is ready at the latest of its origins' first loads, so readiness is two
    aggregations (with map-side combine) and needs no ordered walk: ``FIRST_ONLY`` keeps
    the load at that moment, ``ALWAYS`` also every later load of a required origin,
    ``LOCKED`` and ``MANUAL`` keep none.
    """
    keys = list(keys)
    automatic = required_rows(process_config).where(
        F.col("rules_execution_mode").isin(FIRST_ONLY, ALWAYS)
    )
    loads = (
        ingestion.where(F.col("status") == LOADED)
        .select(*keys, "sor_table_name", "ingestion_id", "loaded_at")
        .join(automatic, ["process_name", "sor_table_name"])
        .withColumn("_moment", F.struct("loaded_at", "ingestion_id", "sor_table_name"))
    )
    ready = (
        loads.groupBy(*keys, "sor_table_name", "required_count")
        .agg(F.min("_moment").alias("_first"))
        .groupBy(*keys, "required_count")
        .agg(F.count(F.lit(1)).alias("_received"), F.max("_first").alias("_ready"))
        .where(F.col("_received") == F.col("required_count"))
        .select(*keys, "_ready")
    )
    first = F.col("_moment") == F.col("_ready")
    later = (F.col("rules_execution_mode") == ALWAYS) & (F.col("_moment") > F.col("_ready"))
    return (
        loads.join(ready, keys)
        .where(first | later)
        .select(
            *keys,
            "sor_table_name",
            "ingestion_id",
            F.col("loaded_at").alias("triggered_at"),
            "rules_execution_mode",
            F.when(first, F.lit("READY")).otherwise("NEW_LOAD").alias("trigger_reason"),
        )
    )
