"""Finished loads -> execution triggers, as months become complete."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.readiness import FIRST_ONLY, execution_triggers
from tidemark.operators.versions import WINDOW_KEYS
from tidemark.streaming.batches import PLACE, create_folder, finish_folds, fold_batches, months_of, other_batches, run_of, write_batch

TRIGGER_IDENTITY = [*WINDOW_KEYS, "sor_table_name", "ingestion_id"]


def emit_triggers(
    loads: DataFrame,
    process_config: DataFrame,
    ledger_path: str,
    triggers_path: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Start the stream. Each batch reads only the months its loads belong to, and there only
    the processes it has loads of.

    A month in ``FIRST_ONLY`` triggers once even if an older load arrives late; in
    ``ALWAYS`` each load triggers at most once.
    """
    spark = loads.sparkSession
    keys = list(WINDOW_KEYS)
    trigger_schema = T.StructType(
        [T.StructField(n, T.StringType()) for n in TRIGGER_IDENTITY]
        + [
            T.StructField("triggered_at", loads.schema["loaded_at"].dataType),
            T.StructField("rules_execution_mode", T.StringType()),
            T.StructField("trigger_reason", T.StringType()),
        ]
    )

    def batch(df: DataFrame, batch_id: int) -> None:
        run = run_of(spark, checkpoint)
        df.persist()
        try:
            months = months_of(df)
            for path, schema in ((ledger_path, loads.schema), (triggers_path, trigger_schema)):
                finish_folds(spark, path)
                fold_batches(spark, path, schema, run, batch_id, months)
            known = other_batches(spark, ledger_path, loads.schema, run, batch_id, months).drop(*PLACE)
            write_batch(df, ledger_path, run, batch_id)
            touched = df.select(*keys).distinct()
            relevant = known.join(touched, keys, "left_semi").unionByName(df)
            emitted = other_batches(spark, triggers_path, trigger_schema, run, batch_id, months)
            due = execution_triggers(relevant, process_config).join(
                emitted.select(*TRIGGER_IDENTITY), TRIGGER_IDENTITY, "left_anti"
            )
            started = emitted.select(*keys).distinct().withColumn("_started", F.lit(True))
            due = due.join(started, keys, "left").where(
                F.col("_started").isNull() | (F.col("rules_execution_mode") != FIRST_ONLY)
            )
            write_batch(due.select(*trigger_schema.names), triggers_path, run, batch_id)
        finally:
            df.unpersist()

    create_folder(spark, ledger_path)
    create_folder(spark, triggers_path)
    return (
        loads.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
