"""Lookups, versions, readiness, locks, gate and state changes on small fixtures."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.operators.consolidate import consolidate
from tidemark.operators.gate import publication_gate, spec_decision
from tidemark.operators.locks import create_input_locks, lock_as_of, locked_read, resolve_inputs
from tidemark.operators.matching import exactly_one_match, register_lookup
from tidemark.operators.readiness import execution_triggers, missing_inputs, readiness
from tidemark.operators.transitions import INGESTION_MOVES, checked_transitions, latest_status
from tidemark.operators.versions import current_version, latest_versions, newest_first

LEDGER = (
    "process_name string, sor_table_name string, data_referencia string, ingestion_id string, status string, loaded_at int"
)
RULES = "process_name string, sor_table_name string, required boolean, enabled boolean"
CONFIG = (
    "process_name string, rules_execution_mode string, spec_execution_mode string, required_origins array<string>"
)


def test_register_lookup(rows):
    config = rows(
        "process_name string, source_database_name string, source_table_name string, sor_database_name string, "
        "sor_table_name string, enabled boolean",
        ("seguros", "db", "contrato", "sor_db", "seguros_contratos", None),
        ("seguros", "db", "cliente", "sor_db", "seguros_clientes", False),
        ("seguros", "db", "contrato", "sor_db", "seguros_contratos", True),
    )
    events = rows(
        "e int, process_name string, source_database_name string, source_table_name string",
        (1, "seguros", "db", "contrato"), (2, "seguros", "db", "cliente"), (3, "seguros", "db", None),
    )
    accepted, rejected = register_lookup(events, config)
    assert [(r["e"], r["sor_table_name"]) for r in accepted.collect()] == [(1, "seguros_contratos")]
    assert {r["e"] for r in rejected.collect()} == {2, 3}


def test_exactly_one_match(rows):
    config = rows("p string, t string, sql string", ("a", "x", "1"), ("b", None, "2"), ("c", None, "3"), ("c", "y", "4"))
    asked = rows("p string, t string", ("a", "x"), ("a", "y"), ("b", "z"), ("c", "y"), ("c", "z"), ("b", None))
    found = {
        (r["p"], r["t"]): (r["match_status"], r["sql"])
        for r in exactly_one_match(asked, config, ["p"], ["sql"], wildcard="t").collect()
    }
    assert found == {
        ("a", "x"): ("OK", "1"),
        ("a", "y"): ("NOT_FOUND", None),
        ("b", "z"): ("OK", "2"),
        ("b", None): ("OK", "2"),
        ("c", "y"): ("AMBIGUOUS", None),
        ("c", "z"): ("OK", "3"),
    }
    plain = exactly_one_match(asked, config.drop("t"), ["p"], ["sql"])
    assert plain.where("match_status = 'AMBIGUOUS'").count() == 2


def test_current_version_follows_finish_order(rows):
    ledger = rows(
        LEDGER,
        ("p", "t", "202604", "000002", "LOADED_SOR", 5),
        ("p", "t", "202604", "000001", "LOADED_SOR", 9),
        ("p", "t", "202604", "000003", "PROCESSING_FAILURE", 10),
        ("p", "t", "202604", "000004", "PROCESSING_SOR", None),
        ("p", "t", "202605", "000001", "LOADED_SOR", 1),
    )
    month = {r["data_referencia"]: r["current_ingestion_id"] for r in current_version(ledger).collect()}
    assert month == {"202604": "000001", "202605": "000001"}
    coarse = current_version(ledger, ("process_name", "sor_table_name")).first()
    assert (coarse["current_ingestion_id"], coarse["data_referencia"]) == ("000001", "202604")
    assert [r["ingestion_id"] for r in newest_first(latest_versions(ledger, n=2)).collect()] == ["000001", "000002", "000001"]


CONFIG_ROWS = (
    ("first", "FIRST_ONLY", "AUTO", ["a", "b"]),
    ("always", "ALWAYS", "MANUAL", ["a", "b", "a"]),
    ("manual", "MANUAL", "AUTO", ["a"]),
    ("locked", "LOCKED", "AUTO", ["a"]),
    ("never", "ALWAYS", "AUTO", ["a", "orig9"]),
)


def loads(rows):
    steps = [("a", "000001", 1), ("a", "000002", 2), ("b", "000001", 3), ("c", "000001", 4), ("b", "000002", 5)]
    return rows(
        LEDGER,
        *[(c[0], o, "202604", i, "LOADED_SOR", at) for c in CONFIG_ROWS for o, i, at in steps],
        ("first", "a", "202605", "000001", "LOADED_SOR", 1),
        ("first", "b", "202605", "000001", "PROCESSING_FAILURE", 2),
    )


def test_triggers_by_mode(rows):
    found = sorted(
        (r["process_name"], r["triggered_at"], r["trigger_reason"])
        for r in execution_triggers(loads(rows), rows(CONFIG, *CONFIG_ROWS)).collect()
    )
    assert found == [("always", 3, "READY"), ("always", 5, "NEW_LOAD"), ("first", 3, "READY")]


def test_readiness_and_missing(rows):
    config, current = rows(CONFIG, *CONFIG_ROWS), current_version(loads(rows))
    found = {(r["process_name"], r["data_referencia"]): r for r in readiness(config, current).collect()}
    state = {k: r["window_status"] for k, r in found.items()}
    assert state == {
        ("first", "202604"): "LOCKED_FOR_EXECUTION",
        ("first", "202605"): "WAITING_INPUTS",
        ("always", "202604"): "LOCKED_FOR_EXECUTION",
        ("manual", "202604"): "MANUAL_REQUIRED",
        ("locked", "202604"): "MANUAL_REQUIRED",
        ("never", "202604"): "WAITING_INPUTS",
    }
    assert found["first", "202604"]["received_origins"] == {"a": "000002", "b": "000002"}
    assert {(r["process_name"], r["sor_table_name"]) for r in missing_inputs(config, current).collect()} == {
        ("first", "b"), ("never", "orig9"),
    }


def test_locks_and_their_failures(rows):
    ledger = rows(
        LEDGER,
        *[("p", t, "202604", f"{t}_{n}", "LOADED_SOR", n) for t in ("a", "b") for n in (1, 2)],
        ("p", "a", "202604", "a_bad", "PROCESSING_FAILURE", 3),
        ("q", "a", "202604", "a_q", "LOADED_SOR", 1),
    )
    rules = rows(
        RULES, ("p", "a", None, None), ("p", "b", True, True), ("p", "opt", False, True), ("p", "off", True, False),
        ("q", "a", True, True), ("q", "z", True, True),
    )
    request = "process_id string, process_name string, data_referencia string, input_overrides map<string,string>"
    asked = rows(
        request,
        ("current", "p", "202604", None),
        ("chosen", "p", "202604", {"a": "a_1", "b": "LATEST"}),
        ("unknown", "p", "202604", {"a": "zzz"}),
        ("failed", "p", "202604", {"a": "a_bad"}),
        ("other", "p", "202604", {"a": "b_1"}),
        ("outside", "p", "202604", {"x": "a_1"}),
        ("missing", "q", "202604", None),
        ("both", "q", "202604", {"a": "zzz"}),
        ("no_rules", "r", "202604", None),
    )
    resolved = resolve_inputs(asked, rules, ledger, current_version(ledger))
    locks, process = create_input_locks(asked, resolved)
    assert {r["process_id"]: r["status"] for r in process.collect()} == {
        "current": "RUNNING",
        "chosen": "RUNNING",
        "unknown": "FAILED_INVALID_OVERRIDE",
        "failed": "FAILED_INVALID_OVERRIDE",
        "other": "FAILED_INVALID_OVERRIDE",
        "outside": "FAILED_INVALID_OVERRIDE",
        "missing": "FAILED_INPUT_MISSING",
        "both": "FAILED_INVALID_OVERRIDE",
        "no_rules": "RUNNING",
    }
    assert {(r["process_id"], r["sor_table_name"], r["ingestion_id"], r["lock_source"]) for r in locks.collect()} == {
        ("current", "a", "a_2", "CURRENT_SOR"),
        ("current", "b", "b_2", "CURRENT_SOR"),
        ("chosen", "a", "a_1", "OVERRIDE"),
        ("chosen", "b", "b_2", "CURRENT_SOR"),
    }


def test_lock_as_of_is_a_photograph(rows):
    ledger = rows(LEDGER, ("p", "a", "m", "1", "LOADED_SOR", 10), ("p", "a", "m", "2", "LOADED_SOR", 20), ("p", "a", "m", "3", "PROCESSING_FAILURE", 15))
    asked = rows("process_id string, process_name string, data_referencia string, created_at int", *[(str(t), "p", "m", t) for t in (5, 10, 17, 20, 99)])
    found = lock_as_of(asked, rows(RULES, ("p", "a", True, True)), ledger).collect()
    assert {r["process_id"]: r["ingestion_id"] for r in found} == {"5": None, "10": "1", "17": "1", "20": "2", "99": "2"}


def test_gate_and_decision(rows):
    process = rows(
        "process_id string, process_name string, status string",
        ("1", "first", "RULES_PROCESSED"), ("2", "always", "RULES_PROCESSED"), ("3", "first", "RUNNING"),
        ("4", "first", "WAITING_SPEC_PUBLICATION"),
    )
    asked = rows("process_id string", ("1",), ("3",), ("4",), ("9",))
    with pytest.raises(ValueError, match="process_name"):
        publication_gate(asked, process)
    ok, refused = publication_gate(asked, process, keys=["process_id"])
    assert {r[0] for r in ok.collect()} == {"1"} and {r[0] for r in refused.collect()} == {"3", "4", "9"}
    ok, _ = publication_gate(asked, process, ("RULES_PROCESSED", "WAITING_SPEC_PUBLICATION"), ["process_id"])
    assert {r[0] for r in ok.collect()} == {"1", "4"}
    months = "process_id string, process_name string, data_referencia string"
    running = rows(months + ", status string", ("1", "first", "202604", "RULES_PROCESSED"), ("1", "first", "202605", "RUNNING"))
    ok, refused = publication_gate(rows(months, ("1", "first", "202604"), ("1", "first", "202605")), running)
    assert [r.data_referencia for r in ok.collect()] == ["202604"] and [r.data_referencia for r in refused.collect()] == ["202605"]
    found = spec_decision(process, rows(CONFIG, *CONFIG_ROWS)).collect()
    assert {(r["process_id"], r["spec_trigger"], r["next_status"]) for r in found} == {
        ("1", "AUTO_SPEC", "PUBLISHING_SPEC"), ("2", None, "WAITING_SPEC_PUBLICATION"),
    }


def test_transitions(rows):
    log = rows(
        "id string, status string, at int, seq int",
        ("a", "PROCESSING_SOR", 1, 1), ("a", "LOADED_SOR", 2, 1), ("a", "PROCESSING_SOR", 3, 1),
        ("b", "LOADED_SOR", 1, 1), ("b", "PROCESSING_SOR", 1, 0), ("c", "LOADED_SOR", 1, 1),
    )
    found = {(r["id"], r["at"], r["seq"]): (r["previous_status"], r["allowed"]) for r in checked_transitions(log, ["id"], INGESTION_MOVES).collect()}
    assert found == {
        ("a", 1, 1): (None, True),
        ("a", 2, 1): ("PROCESSING_SOR", True),
        ("a", 3, 1): ("LOADED_SOR", False),
        ("b", 1, 0): (None, True),
        ("b", 1, 1): ("PROCESSING_SOR", True),
        ("c", 1, 1): (None, False),
    }
    assert {r["id"]: r["status"] for r in latest_status(log, ["id"]).collect()} == {
        "a": "PROCESSING_SOR", "b": "LOADED_SOR", "c": "LOADED_SOR",
    }


def test_consolidate_keeps_one_process_and_all_columns(rows):
    frames = {
        "x": rows("process_id string, a int", ("1", 1), ("2", 2)),
        "y": rows("process_id string, b string", ("1", "z")),
    }
    found = consolidate(frames, "1").orderBy("regra").collect()
    assert [(r["regra"], r["a"], r["b"]) for r in found] == [("x", 1, None), ("y", None, "z")]
    assert consolidate(frames, "1").where(F.col("process_id") == "2").count() == 0


def test_sequential_ids_of_different_processes_do_not_mix(rows):
    """Process 000001 exists in two processes; one fails, the other must not."""
    ledger = rows(LEDGER, ("p", "a", "202604", "000001", "LOADED_SOR", 1), ("q", "a", "202604", "000001", "PROCESSING_SOR", 1))
    rules = rows(RULES, ("p", "a", True, True), ("q", "a", True, True))
    asked = rows("process_id string, process_name string, data_referencia string", ("000001", "p", "202604"), ("000001", "q", "202604"))
    locks, process = create_input_locks(asked, resolve_inputs(asked, rules, ledger, current_version(ledger)))
    assert {r["process_name"]: r["status"] for r in process.collect()} == {"p": "RUNNING", "q": "FAILED_INPUT_MISSING"}
    assert [r["process_name"] for r in locks.collect()] == ["p"]
    ok, refused = publication_gate(asked, process, ("RUNNING",))
    assert ([r["process_name"] for r in ok.collect()], [r["process_name"] for r in refused.collect()]) == (["p"], ["q"])
    data = rows("process_name string, sor_table_name string, data_referencia string, ingestion_id string", ("p", "a", "202604", "000001"), ("q", "a", "202604", "000001"))
    assert [r["process_name"] for r in locked_read(data, locks).collect()] == ["p"]


def test_locks_prune_partitions(spark, rows, folder):
    rows("v int, ingestion_id string", *[(i, f"{i:06d}") for i in range(20)]).write.partitionBy("ingestion_id").parquet(f"{folder}/t")
    rows("process_id string, ingestion_id string", ("1", "000007"), ("2", "000008")).write.parquet(f"{folder}/locks")
    data = spark.read.schema("v int, ingestion_id string").parquet(f"{folder}/t")
    locked = locked_read(data, spark.read.parquet(f"{folder}/locks").where("process_id = '1'"), ["ingestion_id"])
    assert [r["v"] for r in locked.collect()] == [7]
    assert "dynamicpruning" in locked._jdf.queryExecution().executedPlan().toString()


def test_transitions_of_one_large_id_are_spread(spark):
    log = spark.range(2000).selectExpr("if(id < 0, 'b', 'a') AS id", "if(id % 2 = 0, 'PROCESSING_SOR', 'LOADED_SOR') AS status", "timestamp_seconds(id * 60) AS at", "id AS seq")
    checked = checked_transitions(log, ["id"], INGESTION_MOVES)
    assert checked.where("previous_status IS NULL").count() == 1 and checked.count() == 2000
    windows = [line for line in checked._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [last(status" in line]
    assert windows and all(line.rsplit("], [", 2)[-2].count("#") > 1 for line in windows)


def test_the_full_key_prunes_versions_and_months(spark, rows, folder):
    """Only the files of locked versions and months are read, and of those the locked keys."""
    schema = "v int, process_name string, sor_table_name string, ingestion_id string, data_referencia string"
    data = [(10 * i + m, p, "t", f"{i:06d}", f"20260{m}") for i in range(5) for m in range(1, 5) for p in ("p", "q")]
    rows(schema, *data).write.partitionBy("ingestion_id", "data_referencia").parquet(f"{folder}/t")
    lock = "process_id string, process_name string, sor_table_name string, data_referencia string, ingestion_id string"
    rows(lock, ("1", "p", "t", "202602", "000003"), ("1", "p", "t", "202603", "000001"), ("2", "q", "t", "202604", "000004")).write.parquet(f"{folder}/locks")
    locked = locked_read(spark.read.schema(schema).parquet(f"{folder}/t"), spark.read.parquet(f"{folder}/locks").where("process_id = '1'"))
    assert sorted((r["process_name"], r["v"]) for r in locked.collect()) == [("p", 13), ("p", 32)]
    plan = locked._jdf.queryExecution()
    pruned = plan.optimizedPlan().toString()
    assert pruned.count("dynamicpruning#") >= 2 and "dynamicpruning" in plan.executedPlan().toString()


def test_each_input_takes_part_in_one_lookup_only(rows):
    """Repeated requests, null keys, overrides of all kinds; only rows that name a version go
    to the loaded ones, and no text is sorted to find the outcome of a process."""
    ledger = rows(
        LEDGER,
        ("p", "a", "202401", "v1", "LOADED_SOR", 1),
        ("p", "a", "202401", "v2", "LOADED_SOR", 2),
        ("p", "b", "202401", "v3", "PROCESSING_FAILURE", 3),
        ("p", "b", "202402", "v4", "LOADED_SOR", 4),
    )
    rules = rows(RULES, ("p", "a", True, True), ("p", "b", True, None))
    asked = rows(
        "process_id string, process_name string, data_referencia string, input_overrides map<string,string>",
        ("1", "p", "202401", {"a": "v1"}),
        ("2", "p", "202401", {"a": "v1", "b": "v3"}),
        ("3", "p", "202402", {"b": "LATEST", "z": "v9"}),
        ("4", "p", "202402", {"b": "v4", "a": None}),
        ("5", "p", None, None),
        (None, "p", "202401", {"a": "LATEST"}),
        ("6", "none", "202401", None),
        ("1", "p", "202401", {"a": "v1"}),
    )
    resolved = resolve_inputs(asked, rules, ledger, current_version(ledger))
    found = sorted(map(str, ((r.process_id, r.sor_table_name, r.ingestion_id, r.lock_source, r.problem) for r in resolved.collect())))
    missing, invalid = "INPUT_MISSING", "INVALID_OVERRIDE"
    assert found == sorted(
        map(
            str,
            [
                *2 * [("1", "a", "v1", "OVERRIDE", None), ("1", "b", None, "CURRENT_SOR", missing)],
                ("2", "a", "v1", "OVERRIDE", None),
                ("2", "b", None, "OVERRIDE", invalid),
                ("3", "a", None, "CURRENT_SOR", missing),
                ("3", "b", "v4", "CURRENT_SOR", None),
                ("3", "z", None, "OVERRIDE", invalid),
                ("4", "a", None, "CURRENT_SOR", missing),
                ("4", "b", "v4", "OVERRIDE", None),
                ("5", "a", None, "CURRENT_SOR", missing),
                ("5", "b", None, "CURRENT_SOR", missing),
                (None, "a", "v2", "CURRENT_SOR", None),
                (None, "b", None, "CURRENT_SOR", missing),
            ],
        )
    )
    _, process = create_input_locks(asked, resolved)
    failed = {"1": "FAILED_INPUT_MISSING", "2": "FAILED_INVALID_OVERRIDE", "3": "FAILED_INVALID_OVERRIDE", "4": "FAILED_INPUT_MISSING", "5": "RUNNING", None: "RUNNING", "6": "RUNNING"}
    assert {(r.process_id, r.status) for r in process.collect()} == set(failed.items())
    assert "SortAggregate" not in process.select("process_id", "status")._jdf.queryExecution().executedPlan().toString().split("Window")[0]
    whole = resolved._jdf.queryExecution().optimizedPlan().toString()
    assert "concat(-" not in whole  # nobody is looked up under a version that nobody has
