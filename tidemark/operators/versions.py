"""Version ids, the current version and the history kept in the ledger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import zero_padded
from tidemark.operators.dedup import first_per_key
from tidemark.operators.ordered import number_rows
from tidemark.operators.select import latest_rows

# Status of a usable version; 000001 and proc_<process>_<month>_001 as ids.
LOADED = "LOADED_SOR"
SEQUENCE_WIDTH = 6
NAMED_PREFIX, NAMED_WIDTH = "proc", 3

VERSION_KEYS = ("process_name", "sor_table_name", "data_referencia")
WINDOW_KEYS = ("process_name", "data_referencia")
PROCESS_KEYS = (*WINDOW_KEYS, "process_id")


def full_key(keys: Sequence[str], *frames: DataFrame) -> list[str]:
    """The key, which all frames must carry in full.

    Sequential ids repeat from one process or month to the next, so a shorter key would
    join rows of others. Callers whose ids are unique on their own say so with ``keys``.
    """
    absent = [k for k in keys if not all(k in f.columns for f in frames)]
    if absent:
        raise ValueError("key columns are missing: " + ", ".join(absent))
    return list(keys)


def highest_sequence(rows: DataFrame, keys: Sequence[str], id_column: str) -> DataFrame:
    """Largest trailing number of the ids of each group, as the base to continue from."""
    number = F.regexp_extract(id_column, "([0-9]+)$", 1)
    return rows.groupBy(*keys).agg(
        F.max(F.when(number != "", number).cast("long")).alias("base")
    )


def delivery_key(rows: DataFrame, key: str) -> Column:
    """What a repeated delivery is known by: the key, or the whole row where that is null."""
    whole = F.concat(F.lit("-"), F.sha2(F.to_json(F.struct(*rows.columns)), 256))
    return F.coalesce(F.concat(F.lit("+"), F.col(key).cast("string")), whole)


def first_deliveries(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Of rows with one ``key`` the first by ``order``. Rows without a key cannot be known
    again by it: of those, only exact repeats count as one."""
    return first_per_key(rows.withColumn("_delivery", delivery_key(rows, key)), ["_delivery"], order).drop("_delivery")


def assign_ingestion_id(
    events: DataFrame,
    ledger: DataFrame,
    keys: Sequence[str] = VERSION_KEYS,
    order: Sequence[str] = ("event_time", "event_id"),
    event_key: str = "event_id",
    base: DataFrame | None = None,
) -> DataFrame:
    """Zero-padded sequence per key in arrival order, continuing from the ledger, or from
    ``base`` (the keys plus ``base``) where the highest numbers are kept apart.

    An event that is delivered several times counts once, where it comes first by ``order``;
    events the ledger already knows are left out, so a repeated run adds nothing. One
    writer per ledger is assumed: two at once would hand out equal ids.
    """
    if event_key not in events.columns:
        raise ValueError(f"events have no column {event_key} to tell repeated deliveries by")
    events = first_deliveries(events, event_key, order)
    if event_key in ledger.columns:
        events = events.join(ledger.select(event_key), event_key, "left_anti")
    if base is None:
        base = highest_sequence(ledger, keys, "ingestion_id")
    numbered = number_rows(events, keys, order, "_n", base)
    return numbered.withColumn("ingestion_id", zero_padded(F.col("_n"), SEQUENCE_WIDTH)).drop("_n")


def assign_process_id(
    requests: DataFrame,
    process: DataFrame,
    keys: Sequence[str] = WINDOW_KEYS,
    order: Sequence[str] = ("created_at", "request_id"),
    named: bool = False,
    request_key: str = "request_id",
) -> DataFrame:
    """As ``assign_ingestion_id``, for requests the process table does not know yet;
    ``named`` gives ``proc_<process>_<month>_<nnn>``.

    Both frames must carry ``request_key``: without it a repeated request could not be told
    from a new one, and would get a second process.
    """
    full_key([request_key], requests, process)
    requests = first_deliveries(requests, request_key, order)
    known = process.select(request_key).where(F.col(request_key).isNotNull())
    requests = requests.join(known, request_key, "left_anti")
    numbered = number_rows(requests, keys, order, "_n", highest_sequence(process, keys, "process_id"))
    new_id: Column = (
        F.concat_ws("_", F.lit(NAMED_PREFIX), *keys, zero_padded(F.col("_n"), NAMED_WIDTH))
        if named
        else zero_padded(F.col("_n"), SEQUENCE_WIDTH)
    )
    return numbered.withColumn("process_id", new_id).drop("_n")


def current_version(ledger: DataFrame, keys: Sequence[str] = VERSION_KEYS) -> DataFrame:
    """Last load to finish per key. Failures and running loads never move it."""
    kept = [c for c in ledger.columns if c not in keys and c not in ("ingestion_id", "status")]
    return (
        ledger.where(F.col("status") == LOADED)
        .groupBy(*keys)
        .agg(
            F.max_by(
                F.struct("ingestion_id", "status", *kept), F.struct("loaded_at", "ingestion_id")
            ).alias("_last")
        )
        .select(
            *keys,
            F.col("_last.ingestion_id").alias("current_ingestion_id"),
            *[F.col(f"_last.{c}").alias(c) for c in ["status", *kept]],
        )
    )


def latest_versions(ledger: DataFrame, keys: Sequence[str] = VERSION_KEYS, n: int = 1) -> DataFrame:
    """The ``n`` newest loaded versions per key, with all their columns."""
    return latest_rows(
        ledger.where(F.col("status") == LOADED),
        keys,
        [F.desc("loaded_at"), F.desc("ingestion_id")],
        n,
    )


def ingestion_history(ledger: DataFrame) -> DataFrame:
    """All completed versions. The ledger is the history; listing order is the reader's."""
    return ledger.where(F.col("status") == LOADED)


def newest_first(history: DataFrame, keys: Sequence[str] = VERSION_KEYS) -> DataFrame:
    return history.orderBy(*keys, F.desc("loaded_at"), F.desc("ingestion_id"))


def process_list(process: DataFrame, keys: Sequence[str] = WINDOW_KEYS) -> DataFrame:
    """Executions per process and month: how many, in which state, and the latest one."""
    return process.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("executions"),
        F.count_if(F.col("status") == "RUNNING").alias("running"),
        F.count_if(F.col("status") == "RULES_PROCESSED").alias("rules_processed"),
        F.count_if(F.col("status") == "PUBLISHED").alias("published"),
        F.max_by("process_id", F.struct("created_at", "process_id")).alias("latest_process_id"),
        F.max_by("status", F.struct("created_at", "process_id")).alias("latest_status"),
    )
