"""Which version of each input a process uses, fixed when the process is created."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.names import enabled
from tidemark.functions.quality import PROCESS_FIELDS, missing_fields
from tidemark.functions.refdate import data_atual, with_reference_context
from tidemark.operators.matching import AMBIGUOUS, FOUND, NOT_FOUND
from tidemark.operators.ordered import carry_forward
from tidemark.session import durable
from tidemark.sinks.partitions import write_partitions
from tidemark.specs import DestSpec
from tidemark.operators.versions import LOADED, PROCESS_KEYS, VERSION_KEYS, full_key

# Where a lock came from, the word for "current", process outcomes.
OVERRIDE, CURRENT_SOR, LATEST = "OVERRIDE", "CURRENT_SOR", "LATEST"
INVALID_OVERRIDE, INPUT_MISSING = "INVALID_OVERRIDE", "INPUT_MISSING"
FAILED_INVALID_OVERRIDE = "FAILED_INVALID_OVERRIDE"
FAILED_INPUT_MISSING = "FAILED_INPUT_MISSING"
RUNNING = "RUNNING"


def input_slots(requests: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per process and table it names, with the override given for that table.

    Tables come from the rules and from the request's own ``input_overrides`` map. Only
    the small rules are brought to the requests. ``in_rules`` is false for an override of
    any other table.
    """
    keys = list(PROCESS_KEYS)
    tables = (
        rules.where(enabled(F.col("enabled")))
        .groupBy("process_name", "sor_table_name")
        .agg(F.max(enabled(F.col("required"))).alias("required"))
    )
    if "input_overrides" not in requests.columns:
        requests = requests.withColumn("input_overrides", F.lit(None).cast("map<string,string>"))
    ruled = requests.join(tables, "process_name").select(
        *keys,
        "sor_table_name",
        "required",
        F.lit(True).alias("in_rules"),
        F.try_element_at("input_overrides", F.col("sor_table_name")).alias("override_id"),
    )
    stray = (
        requests.select(*keys, F.explode("input_overrides").alias("sor_table_name", "override_id"))
        .join(tables, ["process_name", "sor_table_name"], "left_anti")
        .withColumns({"required": F.lit(False), "in_rules": F.lit(False)})
    )
    return ruled.unionByName(stray)


def resolve_inputs(
    requests: DataFrame, rules: DataFrame, ingestion: DataFrame, current: DataFrame
) -> DataFrame:
    """One row per process and input table: chosen version, its origin, or the problem.

    ``requests``: process_id, process_name, data_referencia and an optional
    ``input_overrides`` map. An override counts when that version of that table is loaded;
    one for a table outside the rules is invalid; ``LATEST`` means the current version.
    """
    versions = list(VERSION_KEYS)
    explicit = F.col("in_rules") & F.col("override_id").isNotNull() & (F.col("override_id") != LATEST)
    # Each row takes part in the one lookup that decides it: explicit versions among the
    # loaded ones, all others among the current ones.
    slots = input_slots(requests, rules)
    loaded = (
        ingestion.where(F.col("status") == LOADED)
        .select(*versions, F.col("ingestion_id").alias("override_id"))
        .distinct()
        .withColumn("_loaded", F.lit(True))
    )
    latest = current.select(*versions, F.col("current_ingestion_id").alias("_current"))
    stray, absent = ~F.col("in_rules"), F.col("_current").isNull() & F.col("required")
    asked = slots.where(explicit).join(loaded, [*versions, "override_id"], "left").select(
        "process_id",
        *versions,
        "required",
        F.when(F.col("_loaded"), F.col("override_id")).alias("ingestion_id"),
        F.lit(OVERRIDE).alias("lock_source"),
        F.when(F.col("_loaded").isNull(), INVALID_OVERRIDE).alias("problem"),
    )
    others = slots.where(~explicit).join(latest, versions, "left").select(
        "process_id",
        *versions,
        "required",
        F.when(~stray, F.col("_current")).alias("ingestion_id"),
        F.when(stray, OVERRIDE).otherwise(CURRENT_SOR).alias("lock_source"),
        F.when(stray, INVALID_OVERRIDE).when(absent, INPUT_MISSING).alias("problem"),
    )
    return others.unionByName(asked)


def create_input_locks(requests: DataFrame, resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(locks, process states). A process with any problem gets no lock at all.

    Groups are the tables of one process, as many as its rules name.
    """
    return _locks_of(judged_inputs(resolved)), _process_of(requests, judged_inputs(resolved))


def judged_inputs(resolved: DataFrame) -> DataFrame:
    """The resolved rows with the outcome of their process as ``_status``."""
    # the hash is sorted as a number, and decides before any text is compared
    own = Window.partitionBy(F.xxhash64(*PROCESS_KEYS), *PROCESS_KEYS)
    worst = F.min("problem").over(own)
    # INPUT_MISSING sorts before INVALID_OVERRIDE, which must win when both occur.
    invalid = F.max("problem").over(own) == INVALID_OVERRIDE
    return resolved.withColumn(
        "_status",
        F.when(invalid, FAILED_INVALID_OVERRIDE)
        .when(worst == INPUT_MISSING, FAILED_INPUT_MISSING)
        .otherwise(RUNNING),
    )


def _locks_of(judged: DataFrame) -> DataFrame:
    return judged.where((F.col("_status") == RUNNING) & F.col("ingestion_id").isNotNull()).select(
        "process_id", *VERSION_KEYS, "ingestion_id", "lock_source"
    )


def _process_of(requests: DataFrame, judged: DataFrame) -> DataFrame:
    # flags, not the texts: a text as the value of a group would have all rows sorted
    failed = [(F.col("_status") == s, s) for s in (FAILED_INVALID_OVERRIDE, FAILED_INPUT_MISSING)]
    states = judged.groupBy(*PROCESS_KEYS).agg(*[F.max(test).alias(f"_{name}") for test, name in failed])
    status = F.when(F.col(f"_{FAILED_INVALID_OVERRIDE}"), FAILED_INVALID_OVERRIDE).when(F.col(f"_{FAILED_INPUT_MISSING}"), FAILED_INPUT_MISSING)
    return requests.join(states, list(PROCESS_KEYS), "left").withColumn("status", status.otherwise(RUNNING)).drop(*[f"_{name}" for _, name in failed])


def lock_inputs(
    requests: DataFrame,
    rules: DataFrame,
    ingestion: DataFrame,
    current: DataFrame,
    destination: DestSpec,
    at: datetime,
) -> DataFrame:
    """Writes the locks of all requests that can be met, with ``locked_at``, and gives every
    request with its status.

    The inputs are resolved once and stored, and both results read that: what is locked and
    what the status says cannot differ. Locks are written below ``destination`` by its
    partition keys, such as ``process_id`` where each run locks for itself.
    """
    judged = durable(judged_inputs(resolve_inputs(requests, rules, ingestion, current)), "judged")
    locks = _locks_of(judged).withColumn("locked_at", F.lit(at).cast("timestamp"))
    write_partitions(locks, destination)
    return _process_of(requests, judged)


def lock_as_of(requests: DataFrame, rules: DataFrame, ingestion: DataFrame) -> DataFrame:
    """Version of each rule table that was current when the process was created.

    Loads and requests are put on one time line; each request takes the last load before
    it. Linear in loads plus requests, whatever the size of a group.
    """
    keys = list(VERSION_KEYS)
    loads = ingestion.where(F.col("status") == LOADED).select(
        *keys,
        F.col("loaded_at").alias("_at"),
        F.lit(0).alias("_side"),
        F.col("ingestion_id").alias("_tie"),
        F.lit(None).cast("string").alias("process_id"),
        "ingestion_id",
    )
    asked = requests.join(
        rules.where(enabled(F.col("enabled"))).select("process_name", "sor_table_name"), "process_name"
    ).select(
        *keys,
        F.col("created_at").alias("_at"),
        F.lit(1).alias("_side"),
        F.col("process_id").alias("_tie"),
        "process_id",
        F.lit(None).cast("string").alias("ingestion_id"),
    )
    line = carry_forward(
        loads.unionByName(asked), keys, ["_at", "_side", "_tie"], "ingestion_id", "_locked"
    )
    return line.where("_side = 1").select(
        "process_id", *keys, F.col("_at").alias("locked_at"), F.col("_locked").alias("ingestion_id")
    )


def locked_read(
    data: DataFrame, locks: DataFrame, keys: Sequence[str] = (*VERSION_KEYS, "ingestion_id")
) -> DataFrame:
    """Rows of the locked versions only. On partitioned data the lock prunes partitions."""
    on = full_key(keys, data, locks)
    return data.join(locks.select(*on).distinct(), on, "left_semi")


def missing_locks(
    sources: DataFrame, locks: DataFrame, keys: Sequence[str] = (*PROCESS_KEYS, "sor_table_name")
) -> DataFrame:
    """Versioned sources of a process without a lock; must be empty before reading.

    ``sources``: the keys and uses_version.
    """
    on = full_key(keys, sources, locks)
    return sources.where("uses_version").join(locks, on, "left_anti")


def version_by_process_month(
    requests: DataFrame, versions: DataFrame, keys: Sequence[str] = PROCESS_KEYS
) -> DataFrame:
    """Version recorded for a process and month; ``version_status`` says if there is one.

    The full key, as sequential ids repeat from one process to the next. A process with two
    different versions on record is ``AMBIGUOUS`` and gets none; repeated rows count once.
    """
    on = full_key(keys, requests, versions)
    one = versions.groupBy(*on).agg(
        F.min("ingestion_id").alias("_version"), (F.min("ingestion_id") == F.max("ingestion_id")).alias("_one")
    )
    status = (
        F.when(F.col("_version").isNull(), NOT_FOUND).when(F.col("_one"), FOUND).otherwise(AMBIGUOUS)
    )
    return requests.join(one, on, "left").select(
        *requests.columns,
        F.when(F.col("_one"), F.col("_version")).alias("ingestion_id"),
        status.alias("version_status"),
    )


def process_context(
    requests: DataFrame, process: DataFrame, run_date=None, keys: Sequence[str] = PROCESS_KEYS
) -> DataFrame:
    """Run context of each requested process: id, name, month and derived date parts."""
    known = with_reference_context(
        process.select(*PROCESS_FIELDS).withColumn("problems", missing_fields(PROCESS_FIELDS)),
        "data_referencia",
        run_date,
    )
    return requests.join(known, full_key(keys, requests, known), "left").withColumns(
        {
            "problems": F.coalesce("problems", F.array(F.lit("process_id"))),
            "data_ref_valida": F.coalesce("data_ref_valida", F.lit(False)),
            "data_atual": data_atual(run_date),
        }
    )
