"""Runs that leave their state in the status log, and the ledger as the log tells it.

The log is append-only: a state is the last row written, nothing is updated in place, and
a failed load leaves the version that was current before. A run writes a row ahead of its
work and one after it, and its manifest between the two. What a run that was killed left
open is settled by a sweep: the manifest tells whether its output had been put in place.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.consolidate import consolidate
from tidemark.operators.gate import PUBLISHED, PUBLISHING_SPEC, RULES_PROCESSED, STRICT_GATE
from tidemark.operators.locks import RUNNING
from tidemark.operators.versions import LOADED, PROCESS_KEYS, VERSION_KEYS, full_key
from tidemark.plans.context import ingestion_context, rows_of, single_row
from tidemark.plans.layers import load_sor, publish_spec, run_rule
from tidemark.sinks import WriteReport, append_manifest, read_manifest, write_result
from tidemark.specs import DestSpec, LayerSpec

# States of runs that failed, and of a load that is under way.
FAILURE = "PROCESSING_FAILURE"
FAILED_RULES, FAILED_SPEC = "FAILED_RULES", "FAILED_SPEC"
LOADING = "PROCESSING_SOR"

# What the state a run begins with becomes, if it ends well and if not.
OUTCOMES = {LOADING: (LOADED, FAILURE), RUNNING: (RULES_PROCESSED, FAILED_RULES), PUBLISHING_SPEC: (PUBLISHED, FAILED_SPEC)}
BEGUN, ENDED, SWEPT = 0, 1, 2  # order of a run's rows that bear the same moment


def append_status(
    spark: SparkSession,
    log_path: str,
    keys: Mapping[str, str],
    status: str,
    at: datetime,
    seq: int,
    rows: int | None = None,
    run_id: str | None = None,
) -> None:
    """One status row; ``seq`` orders rows written at the same moment."""
    columns = [F.lit(str(v)).alias(k) for k, v in keys.items()]
    spark.range(1).select(
        *columns,
        F.lit(status).alias("status"),
        F.lit(at).cast("timestamp").alias("at"),
        F.lit(seq).cast("long").alias("seq"),
        F.lit(rows).cast("long").alias("rows"),
        F.lit(run_id).cast("string").alias("run_id"),
    ).write.mode("append").parquet(log_path)


def recorded(
    spark: SparkSession,
    log_path: str,
    identity: Mapping[str, str],
    begins: str,
    work: Callable[[], WriteReport],
    manifest_path: str | None = None,
) -> WriteReport:
    """Runs ``work`` between a row with the state it ``begins`` with and one with its outcome.

    The row count comes from the write itself. With ``manifest_path`` what was written is
    listed there under the run's id, before the outcome.
    """
    done, failed = OUTCOMES[begins]
    run_id = uuid.uuid4().hex

    def record(status: str, seq: int, rows: int | None = None) -> None:
        append_status(spark, log_path, identity, status, datetime.now(timezone.utc), seq, rows, run_id)

    record(begins, BEGUN)
    try:
        report = work()
    except Exception:
        record(failed, ENDED)
        raise
    if manifest_path:
        append_manifest(spark, report, manifest_path, run_id)
    record(done, ENDED, report.rows)
    return report


def _identity(rows: DataFrame, keys: Sequence[str], what: str) -> dict[str, str]:
    return single_row(rows.select(*full_key(keys, rows)), what).asDict()


def load_and_record(
    spark: SparkSession,
    spec: LayerSpec,
    ledger: DataFrame,
    ingestion_id: str,
    log_path: str,
    keys: Mapping[str, str] | None = None,
    identity_keys: Sequence[str] = (*VERSION_KEYS, "ingestion_id"),
    manifest_path: str | None = None,
    **options,
) -> WriteReport:
    """SOR load whose beginning and end, good or bad, go to the log.

    A row that may not be loaded at all (unknown, already loaded, incomplete) is refused
    without a trace.
    """
    chosen = rows_of(ledger, ingestion_id=ingestion_id, **(keys or {}))
    identity = _identity(chosen, identity_keys, f"ingestion {ingestion_id}")
    ingestion_context(ledger, ingestion_id, **(keys or {}))
    work = lambda: load_sor(spark, spec, ledger, ingestion_id, keys, **options)
    return recorded(spark, log_path, identity, LOADING, work, manifest_path)


def run_rules_and_record(
    spark: SparkSession,
    specs: Mapping[str, LayerSpec],
    process: DataFrame,
    locks: DataFrame,
    process_id: str,
    consolidated: DestSpec,
    log_path: str,
    keys: Mapping[str, str] | None = None,
    identity_keys: Sequence[str] = PROCESS_KEYS,
    manifest_path: str | None = None,
    **options,
) -> WriteReport:
    """All rules of a process and their consolidation: RUNNING, then RULES_PROCESSED or
    FAILED_RULES.

    Only the partitions that the rules have just written are consolidated.
    """
    own = rows_of(process, process_id=process_id, **(keys or {}))
    identity = _identity(own, identity_keys, f"process {process_id}")

    def work() -> WriteReport:
        modules = {}
        for rule, spec in specs.items():
            report = run_rule(spark, spec, own, locks, process_id, rule, keys=keys, **options)
            written = spark.read.schema(report.schema).parquet(report.path)
            modules[rule] = written.where((F.col("process_id") == process_id) & (F.col("regra") == rule)).drop("regra")
        return write_result(consolidate(modules, process_id), consolidated, ("process_id",))

    return recorded(spark, log_path, identity, RUNNING, work, manifest_path)


def publish_and_record(
    spark: SparkSession,
    spec: LayerSpec,
    process: DataFrame,
    process_id: str,
    log_path: str,
    statuses: tuple[str, ...] = STRICT_GATE,
    keys: Mapping[str, str] | None = None,
    identity_keys: Sequence[str] = PROCESS_KEYS,
    manifest_path: str | None = None,
    **options,
) -> WriteReport:
    """Publication: PUBLISHING_SPEC, then PUBLISHED or FAILED_SPEC. A process whose rules are
    not done is refused without a trace."""
    own = rows_of(process, process_id=process_id, **(keys or {}))
    ready = own.where(F.col("status").isin(*statuses))
    identity = _identity(ready, identity_keys, f"process {process_id} ready for publication")
    work = lambda: publish_spec(spark, spec, own, process_id, statuses=statuses, keys=keys, **options)
    return recorded(spark, log_path, identity, PUBLISHING_SPEC, work, manifest_path)


def open_runs(log: DataFrame, before: datetime) -> DataFrame:
    """First rows of the runs that began earlier than ``before`` and have no outcome."""
    kept = [c for c in log.columns if c != "run_id"]
    runs = log.where(F.col("run_id").isNotNull()).groupBy("run_id").agg(
        F.min_by(F.struct(*kept), F.struct("at", "seq")).alias("_begun"), F.max("seq").alias("_reached")
    )
    begun = runs.where((F.col("_reached") == BEGUN) & (F.col("_begun.at") < F.lit(before)))
    return begun.select(*[F.col(f"_begun.{c}").alias(c) for c in kept], "run_id")


def settled_runs(log: DataFrame, manifest: DataFrame, before: datetime, now: datetime) -> DataFrame:
    """The outcome rows that runs killed on their way still lack.

    A run whose output is listed in the manifest had put it in place, so it ended well, with
    the rows listed; one without had not, or will be repeated: it failed.
    """
    listed = manifest.groupBy(F.col("write_id").alias("run_id")).agg(F.sum("rows").alias("_rows"), F.lit(True).alias("_written"))
    done, failed = F.lit(None).cast("string"), F.lit(FAILURE)
    for begins, (good, bad) in OUTCOMES.items():
        done = F.when(F.col("status") == begins, good).otherwise(done)
        failed = F.when(F.col("status") == begins, bad).otherwise(failed)
    ended = open_runs(log, before).join(listed, "run_id", "left")
    return ended.withColumns(
        {
            "status": F.when(F.col("_written"), done).otherwise(failed),
            "at": F.lit(now).cast("timestamp"),
            "seq": F.lit(SWEPT).cast("long"),
            "rows": F.col("_rows"),
        }
    ).select(*log.columns)


def sweep_runs(spark: SparkSession, log_path: str, manifest_path: str, before: datetime) -> None:
    """Appends the missing outcomes to the log. ``before`` must lie far enough back that no
    run that began earlier is still at work. A second sweep finds nothing to do."""
    log = spark.read.parquet(log_path)
    settled_runs(log, read_manifest(spark, manifest_path), before, datetime.now(timezone.utc)).write.mode("append").parquet(log_path)


def ledger_state(
    ledger: DataFrame, log: DataFrame, keys: Sequence[str] = (*VERSION_KEYS, "ingestion_id")
) -> DataFrame:
    """Ledger rows with the state, finish time and row count of their last log row."""
    on = full_key(keys, ledger, log)
    last = (
        log.groupBy(*on)
        .agg(F.max_by(F.struct("status", "at", "rows"), F.struct("at", "seq")).alias("_last"))
        .select(*on, "_last")
    )
    kept = [c for c in ledger.columns if c not in ("status", "loaded_at", "rows")]
    state = F.coalesce("_last.status", "status")
    return ledger.join(last, on, "left").select(
        *kept,
        state.alias("status"),
        F.when(state == LOADED, F.col("_last.at")).alias("loaded_at"),
        F.col("_last.rows").alias("rows"),
    )
