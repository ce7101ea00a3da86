"""Streaming forms, run over all files that are there and then stopped."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.streaming import emit_triggers, register_arrivals, register_batch
from workload import inputs
from workload.inputs import ARRIVALS, TABLE_CONFIG, process_config, staged, stamp, table_config
from workload.ledger import TRIGGERS

KEYS = ["process_name", "sor_table_name", "data_referencia"]


def _source(spark, sf, name):
    """The table as a stream of files."""
    schema = inputs.table(spark, sf, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf)


class _Streamed:
    """Stands in for the session, so that the batch derivations apply to a stream."""

    def __init__(self, spark, sf):
        self.read = self
        self._make = lambda path: _source(spark, sf, path.rsplit("/", 1)[1].removesuffix(".parquet"))

    def schema(self, _):
        return self

    def parquet(self, path):
        return self._make(path)


def _stream_registration(spark, sf):
    def write(path):
        events = inputs.arrivals(_Streamed(spark, sf), sf).drop("sor_table_name")
        register_arrivals(
            events, table_config(spark), f"{path}/ledger", f"{path}/checkpoint", f"{path}/rejected"
        ).awaitTermination()

    path = staged(spark, sf, "stream-registration", write)
    columns = ["event_id", *KEYS, "ingestion_id", "status"]
    schema = "event_id bigint, " + ", ".join(f"{c} string" for c in columns[1:])
    return spark.read.schema(schema).parquet(f"{path}/ledger").select(*columns)


def _stream_restart(spark, sf):
    """The same arrivals under two checkpoints: the second run must add and lose nothing."""

    def write(path):
        for run in ("first", "second"):
            events = inputs.arrivals(_Streamed(spark, sf), sf).drop("sor_table_name")
            register_arrivals(events, table_config(spark), f"{path}/ledger", f"{path}/{run}").awaitTermination()

    path = staged(spark, sf, "stream-restart", write)
    columns = ["event_id", *KEYS, "ingestion_id", "status"]
    schema = "event_id bigint, " + ", ".join(f"{c} string" for c in columns[1:])
    return spark.read.schema(schema).parquet(f"{path}/ledger").select(*columns)


def _stream_duplicates(spark, sf):
    """At-least-once delivery: a third of the events twice in one batch, a third again in the
    next; the state store drops some, the ledger knows the others."""

    def write(path):
        events = inputs.arrivals(spark, sf).drop("sor_table_name").withColumn("event_time", F.col("event_time").cast("timestamp"))
        first, second = events.where("event_id % 3 <> 0"), events.where("event_id % 3 <> 1")
        for name, sent, within in (("a", first.unionByName(first.where("event_id % 3 = 1")), "400 days"), ("b", second, None)):
            sent.write.parquet(f"{path}/in/{name}")
            stream = spark.readStream.schema(events.schema).parquet(f"{path}/in/*")
            register_arrivals(stream, table_config(spark), f"{path}/ledger", f"{path}/check-{name}", within=within).awaitTermination()

    path = staged(spark, sf, "stream-duplicates", write)
    columns = ["event_id", *KEYS, "ingestion_id", "status"]
    schema = "event_id bigint, " + ", ".join(f"{c} string" for c in columns[1:])
    return spark.read.schema(schema).parquet(f"{path}/ledger").select(*columns)


def _batch_registration(spark, sf):
    """The same arrivals in two batches that overlap; the second is run twice."""

    def write(path):
        events = inputs.arrivals(spark, sf).drop("sor_table_name")
        for batch, part in ((0, "event_id % 3 <> 0"), (1, "event_id % 3 <> 1"), (1, "event_id % 3 <> 1")):
            register_batch(events.where(part), table_config(spark), f"{path}/ledger", "job", batch, f"{path}/rejected")

    path = staged(spark, sf, "batch-registration", write)
    columns = ["event_id", *KEYS, "ingestion_id", "status"]
    schema = "event_id bigint, " + ", ".join(f"{c} string" for c in columns[1:])
    return spark.read.schema(schema).parquet(f"{path}/ledger").select(*columns)


def _stream_readiness(spark, sf):
    def write(path):
        loads = inputs.ledger(_Streamed(spark, sf), sf)
        emit_triggers(
            loads, process_config(spark), f"{path}/ledger", f"{path}/triggers", f"{path}/checkpoint"
        ).awaitTermination()

    path = staged(spark, sf, "stream-readiness", write)
    schema = (
        ", ".join(f"{c} string" for c in [*KEYS, "ingestion_id"])
        + ", triggered_at timestamp_ntz, rules_execution_mode string, trigger_reason string"
    )
    return spark.read.schema(schema).parquet(f"{path}/triggers").select(
        *KEYS,
        "ingestion_id",
        stamp("triggered_at").alias("triggered_at"),
        "rules_execution_mode",
        "trigger_reason",
    )


QUERIES = {
    "stream_registration": _stream_registration,
    "stream_restart": _stream_restart,
    "stream_duplicates": _stream_duplicates,
    "batch_registration": _batch_registration,
    "stream_readiness": _stream_readiness,
}

ORACLE = {
    "stream_registration": f"""WITH {ARRIVALS}, {TABLE_CONFIG}, mapped AS (SELECT event_id, event_time, a.process_name,
        c.mapped_table AS sor_table_name, data_referencia FROM arrivals a JOIN table_config c ON c.enabled
        AND a.process_name = c.process_name AND a.source_database_name = c.source_database_name
        AND a.source_table_name = c.source_table_name)
        SELECT event_id, process_name, sor_table_name, data_referencia, printf('%06d', row_number() OVER (
        PARTITION BY process_name, sor_table_name, data_referencia ORDER BY event_time, event_id)) AS ingestion_id,
        'PROCESSING_SOR' AS status FROM mapped""",
    "stream_readiness": TRIGGERS,
}
ORACLE["stream_duplicates"] = ORACLE["stream_registration"].replace(
    "ORDER BY event_time, event_id", "ORDER BY event_id % 3 = 0, event_time, event_id"
)
ORACLE["batch_registration"] = ORACLE["stream_duplicates"]
ORACLE["stream_restart"] = ORACLE["stream_registration"]
