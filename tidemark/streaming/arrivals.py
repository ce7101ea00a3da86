"""Arrival events -> ledger rows with their ingestion id."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.quality import LOADABLE_STATUS
from tidemark.operators.matching import register_lookup
from tidemark.operators.versions import VERSION_KEYS, assign_ingestion_id, delivery_key, highest_sequence
from tidemark.streaming.batches import (
    MONTH,
    PLACE,
    create_folder,
    finish_folds,
    fold_batches,
    in_months,
    months_of,
    other_batches,
    run_of,
    write_batch,
)

STATE = "_state"  # below the ledger, where readers of the ledger do not look


def register_batch(
    events: DataFrame,
    sor_table_config: DataFrame,
    ledger_path: str,
    run: str,
    batch_id: int = 0,
    rejected_path: str | None = None,
    keys: Sequence[str] = VERSION_KEYS,
    order: Sequence[str] = ("event_time", "event_id"),
    event_key: str = "event_id",
) -> None:
    """Registers the events of one batch: maps them, continues the sequences, appends.

    ``run`` and ``batch_id`` name the batch; registering it again replaces what it wrote,
    with the same ids. Events that are repeated in it or known from others get no second id.
    It reads the ledger's event ids of its own months, and the highest number of each key
    from a table of those, which it extends; its cost follows the batch and those months.
    One writer per ledger.
    """
    if MONTH not in keys:
        raise ValueError(f"the key must hold {MONTH}, by which the ledger is kept")
    spark = events.sparkSession
    ledger_schema = ledger_schema_of(events.schema)
    state_schema = T.StructType([*[ledger_schema[k] for k in keys], T.StructField("base", T.LongType())])
    state_path = f"{ledger_path}/{STATE}"
    create_folder(spark, state_path)

    def highest(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*[k for k in keys if k in rows.columns]).agg(F.max("base").alias("base"))

    events.persist()
    try:
        months = months_of(events)
        for path, schema, merge in ((ledger_path, ledger_schema, lambda rows: rows), (state_path, state_schema, highest)):
            finish_folds(spark, path)
            fold_batches(spark, path, schema, run, batch_id, months, merge)
        ledger = other_batches(spark, ledger_path, ledger_schema, run, batch_id, months)
        state = other_batches(spark, state_path, state_schema, run, batch_id, months).drop(*PLACE)
        # A month that was registered without such a table is taken over from its ledger.
        covered = months_of(state)
        unknown = ledger.where(in_months([m for m in months if m not in covered]))
        seed = highest_sequence(unknown, keys, "ingestion_id").select(*state.columns)
        base = highest(state.unionByName(seed))
        accepted, rejected = register_lookup(events, sor_table_config)
        fresh = assign_ingestion_id(accepted, ledger, keys, order, event_key, base).withColumn("status", F.lit(LOADABLE_STATUS))
        fresh = fresh.select(*ledger_schema.names).persist()
        try:
            # The state goes first: a crash between the two may leave a gap, never an id twice.
            reached = highest_sequence(fresh, keys, "ingestion_id").select(*state.columns)
            write_batch(highest(reached.unionByName(seed)), state_path, run, batch_id)
            write_batch(fresh, ledger_path, run, batch_id)
        finally:
            fresh.unpersist()
        if rejected_path:
            write_batch(rejected, rejected_path, run, batch_id)
    finally:
        events.unpersist()


def ledger_schema_of(events: T.StructType) -> T.StructType:
    given = ("sor_database_name", "sor_table_name", "ingestion_id", "status")
    return T.StructType([f for f in events if f.name not in given] + [T.StructField(n, T.StringType()) for n in given])


def register_arrivals(
    events: DataFrame,
    sor_table_config: DataFrame,
    ledger_path: str,
    checkpoint: str,
    rejected_path: str | None = None,
    keys: Sequence[str] = VERSION_KEYS,
    order: Sequence[str] = ("event_time", "event_id"),
    trigger: Mapping[str, object] | None = None,
    event_key: str = "event_id",
    within: str | None = None,
) -> StreamingQuery:
    """Start the stream; each micro-batch is registered by ``register_batch``.

    With ``within``, such as ``2 days``, repeats that close in event time are dropped in
    Spark's state store before they reach the ledger. Spark then also drops events that are
    later than that behind the newest, so choose it longer than any delay.

    Run one such stream per ledger. ``trigger`` is that of ``DataStreamWriter.trigger``; without
    one the stream takes what is there and stops.
    """
    spark = events.sparkSession
    if within:
        told = events.withColumn("_delivery", delivery_key(events, event_key))
        events = told.withWatermark(order[0], within).dropDuplicatesWithinWatermark(["_delivery"]).drop("_delivery")

    def batch(df: DataFrame, batch_id: int) -> None:
        run = run_of(spark, checkpoint)
        register_batch(df, sor_table_config, ledger_path, run, batch_id, rejected_path, keys, order, event_key)

    create_folder(spark, ledger_path)
    return (
        events.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
