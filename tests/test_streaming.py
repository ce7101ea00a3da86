"""Streams over several files, restarts, repeated deliveries and late loads."""

from __future__ import annotations

import glob
import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from tidemark.operators.readiness import execution_triggers
from tidemark.streaming import emit_triggers, register_arrivals
from tidemark.streaming.batches import (
    finish_folds,
    fold_batches,
    other_batches,
    write_batch,
)

EVENT = (
    "event_id int, event_time int, process_name string, source_database_name string, source_table_name string, data_referencia string"
)
MAP = (
    "process_name string, source_database_name string, source_table_name string, sor_database_name string, sor_table_name string, enabled boolean"
)
LOAD = "process_name string, sor_table_name string, data_referencia string, ingestion_id string, status string, loaded_at int"
CONFIG = "process_name string, rules_execution_mode string, required_origins array<string>"


def test_registration_continues_over_batches_and_restarts(spark, rows, folder):
    config = rows(MAP, ("p", "db", "t", "sor_db", "p_t", True))

    def arrive(name, *events):
        rows(EVENT, *[(i, at, "p", "db", table, "202604") for i, at, table in events]).coalesce(1).write.mode("append").parquet(
            f"{folder}/in"
        )

    def run():
        stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", "1").parquet(f"{folder}/in")
        register_arrivals(
            stream, config, f"{folder}/ledger", f"{folder}/check", f"{folder}/rejected"
        ).awaitTermination()

    arrive("a", (1, 10, "t"), (2, 11, "t"), (9, 1, "unmapped"))
    arrive("b", (3, 5, "t"))
    run()
    arrive("c", (3, 5, "t"), (4, 20, "t"))
    run()
    run()
    ledger = spark.read.parquet(f"{folder}/ledger")
    ids = {r["event_id"]: r["ingestion_id"] for r in ledger.collect()}
    assert ledger.count() == 4 and sorted(ids.values()) == ["000001", "000002", "000003", "000004"]
    assert ids[4] == "000004" and ids[1] < ids[2]
    assert {r["status"] for r in ledger.collect()} == {"PROCESSING_SOR"}
    assert [r["event_id"] for r in spark.read.parquet(f"{folder}/rejected").collect()] == [9]


def test_triggers_over_batches_equal_the_batch_result(spark, rows, folder):
    config = rows(CONFIG, ("once", "FIRST_ONLY", ["a", "b"]), ("each", "ALWAYS", ["a", "b"]), ("man", "MANUAL", ["a"]))
    steps = [("a", "1", 1), ("b", "1", 2), ("a", "2", 3), ("c", "1", 4), ("b", "2", 5)]
    for origin, version, at in steps:
        rows(LOAD, *[(p, origin, "202604", version, "LOADED_SOR", at) for p in ("once", "each", "man")]).coalesce(1).write.mode(
            "append"
        ).parquet(f"{folder}/in")
        stream = spark.readStream.schema(LOAD).parquet(f"{folder}/in")
        emit_triggers(stream, config, f"{folder}/ledger", f"{folder}/triggers", f"{folder}/check").awaitTermination()
    names = ["process_name", "sor_table_name", "data_referencia", "ingestion_id", "triggered_at", "trigger_reason"]
    found = spark.read.parquet(f"{folder}/triggers").select(*names)
    expected = execution_triggers(spark.read.schema(LOAD).parquet(f"{folder}/in"), config).select(*names)
    as_text = lambda df: sorted(tuple(str(v) for v in r) for r in df.collect())
    assert as_text(found) == as_text(expected)
    assert len(as_text(found)) == 4


def test_a_late_older_load_does_not_start_a_month_twice(spark, rows, folder):
    config = rows(CONFIG, ("once", "FIRST_ONLY", ["a", "b"]))
    for origin, version, at in [("a", "2", 5), ("b", "1", 6), ("b", "0", 3)]:
        rows(LOAD, ("once", origin, "202604", version, "LOADED_SOR", at)).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(LOAD).parquet(f"{folder}/in")
        emit_triggers(stream, config, f"{folder}/ledger", f"{folder}/triggers", f"{folder}/check").awaitTermination()
    assert spark.read.parquet(f"{folder}/triggers").count() == 1


def test_a_new_checkpoint_and_an_emptied_batch(spark, rows, folder):
    """Two checkpoints, one ledger: nothing is lost and no id is given twice."""
    config = rows(MAP, ("p", "db", "t", "sor_db", "p_t", True))
    rows(EVENT, (1, 10, "p", "db", "t", "202604"), (2, 11, "p", "db", "t", "202604")).coalesce(1).write.parquet(f"{folder}/in")

    def run(check):
        stream = spark.readStream.schema(EVENT).parquet(f"{folder}/in")
        register_arrivals(stream, config, f"{folder}/ledger", f"{folder}/{check}").awaitTermination()

    run("first")
    rows(EVENT, (3, 1, "p", "db", "t", "202604")).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    run("second")
    ledger = spark.read.parquet(f"{folder}/ledger")
    assert sorted((r["event_id"], r["ingestion_id"]) for r in ledger.collect()) == [(1, "000001"), (2, "000002"), (3, "000003")]
    run_id = ledger.where("event_id = 3").first()["run_id"]
    write_batch(ledger.limit(0), f"{folder}/ledger", run_id, 0)  # the batch again, now without rows
    assert spark.read.parquet(f"{folder}/ledger").count() == 2


TIMED = EVENT.replace("event_time int", "event_time timestamp")


@pytest.mark.parametrize("within", [None, "10 days"])
def test_an_event_delivered_again_gets_no_second_id(spark, rows, folder, within):
    """Inside a batch, in the next batch, and under a new checkpoint."""
    config = rows(MAP, ("p", "db", "t", "sor_db", "p_t", True))

    def run(check, *events):
        data = rows(EVENT, *[(i, at, "p", "db", "t", "202604") for i, at in events])
        data.withColumn("event_time", F.timestamp_seconds("event_time")).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(TIMED).parquet(f"{folder}/in")
        register_arrivals(stream, config, f"{folder}/ledger", f"{folder}/{check}", within=within).awaitTermination()

    run("a", (1, 10), (1, 10), (2, 20), (None, 5), (None, 5))
    run("a", (2, 20), (3, 15), (1, 10))
    run("b", (3, 15), (4, 1))
    found = sorted((r["ingestion_id"], r["event_id"]) for r in spark.read.parquet(f"{folder}/ledger").collect() if r["event_id"])
    assert [e for _, e in found] == [1, 2, 3, 4] and len({i for i, _ in found}) == 4


def test_a_batch_reads_its_own_months_only(spark, rows, folder):
    schema = rows("a int, data_referencia string", (1, "x")).schema
    for batch in range(3):
        write_batch(rows("a int, data_referencia string", (batch, "202601"), (batch, f"20260{batch + 2}"), (batch, None)), f"{folder}/t", "r", batch)
    read = other_batches(spark, f"{folder}/t", schema, "r", 2, ["202602", None, "209901"])
    assert sorted((r["a"], r["data_referencia"]) for r in read.collect() if r["data_referencia"]) == [(0, "202602")]
    assert read.where("data_referencia IS NULL").count() == 2
    plan = read._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "data_referencia" in filters and "run_id" in filters
    assert not [f for f in read.inputFiles() if "202601" in f or "202603" in f]
    assert other_batches(spark, f"{folder}/t", schema, "r", 2, ["209901"]).count() == 0


def test_folded_folders_stay_few_and_lose_nothing(spark, rows, folder):
    schema = rows("a int, data_referencia string", (1, "x")).schema
    path = f"{folder}/t"
    for batch in range(14):
        fold_batches(spark, path, schema, "r", batch, ["202601"], most=2)
        write_batch(rows("a int, data_referencia string", (batch, "202601")), path, "r", batch)
        assert len(glob.glob(f"{path}/data_referencia=202601/*/*")) <= 8
    whole = spark.read.schema("a int, data_referencia string, run_id string, batch_id long").parquet(path)
    assert sorted(r["a"] for r in whole.collect()) == list(range(14))
    # a batch that runs again still replaces its own rows
    write_batch(rows("a int, data_referencia string", (99, "202601")), path, "r", 13)
    assert sorted(r["a"] for r in spark.read.schema(whole.schema).parquet(path).collect()) == [*range(13), 99]


def test_a_fold_that_was_cut_short(spark, rows, folder):
    schema = rows("a int, data_referencia string", (1, "x")).schema
    path, home = f"{folder}/t", "data_referencia=202601"
    for batch in range(2):
        write_batch(rows("a int, data_referencia string", (batch, "202601")), path, "r", batch)
    old = [f"{home}/run_id=r/batch_id={b}" for b in range(2)]
    count = lambda: spark.read.schema("a int, data_referencia string").parquet(path).count()
    for moved in (False, True):  # before and after the folded folder took its place
        rows("a int", (0,), (1,)).coalesce(1).write.parquet(f"{path}/_folding/x")
        with open(f"{path}/_folding/x.json", "w") as f:
            json.dump({"from": "_folding/x", "old": old}, f)
        if moved:
            os.makedirs(f"{path}/{home}/run_id=folded-1")
            shutil.move(f"{path}/_folding/x", f"{path}/{home}/run_id=folded-1/batch_id=1")
        finish_folds(spark, path)
        assert count() == 2 and not os.listdir(f"{path}/_folding")
    assert not any(os.path.exists(f"{path}/{o}") for o in old)
    read = other_batches(spark, path, schema, "r", 5, ["202601"])
    assert sorted(r["a"] for r in read.collect()) == [0, 1]


def test_a_ledger_without_kept_numbers_is_continued(spark, rows, folder):
    """Two tables are in an older ledger; the second is first touched in a later batch."""
    config = rows(MAP, ("p", "db", "t", "sor_db", "p_t", True), ("p", "db", "u", "sor_db", "p_u", True))
    ledger = EVENT + ", sor_database_name string, sor_table_name string, ingestion_id string, status string"
    earlier = [(100 + i, 1, "p", "db", t, "202604", "sor_db", f"p_{t}", n, "LOADED_SOR") for i, (t, n) in enumerate([("t", "000007"), ("u", "000009")])]
    write_batch(rows(ledger, *earlier), f"{folder}/ledger", "older", 0)
    for n, table in enumerate("tut"):
        rows(EVENT, (n, 10, "p", "db", table, "202604")).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(EVENT).parquet(f"{folder}/in")
        register_arrivals(stream, config, f"{folder}/ledger", f"{folder}/check").awaitTermination()
    found = {r["event_id"]: r["ingestion_id"] for r in spark.read.parquet(f"{folder}/ledger").where("event_id < 100").collect()}
    assert found == {0: "000008", 1: "000010", 2: "000009"}
