"""Layer jobs and their failures; one write job per layer."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidemark import DestSpec, LayerSpec, SourceSpec
from tidemark.operators.versions import current_version
from tidemark.plans import layers
from tidemark.plans import (
    append_status,
    consolidate_sot,
    ledger_state,
    load_and_record,
    load_sor,
    open_runs,
    publish_spec,
    resolve_source_locks,
    run_rule,
    sweep_runs,
)
from tidemark.sinks import append_manifest, destination_settings, destination_spec
from tidemark.specs import RowId

INGESTION = (
    "ingestion_id string, process_name string, source_database_name string, source_table_name string, "
    "sor_database_name string, sor_table_name string, partitions map<string,string>, status string"
)
PROCESS = "process_id string, process_name string, data_referencia string, status string"


@pytest.fixture
def lake(spark, rows, folder):
    rows(
        "num_contrato string, vlr_cred_mes double, data_referencia string, dia_base string",
        ("1", 50.0, "202509", "15"), ("1", 50.0, "202509", "15"), ("2", 500.0, "202509", "15"),
        ("3", 700.0, "202509", "16"), ("4", 900.0, "202603", "15"),
    ).write.partitionBy("data_referencia", "dia_base").parquet(f"{folder}/origem/contrato")
    return folder


def ledger(rows, **changes):
    row = {
        "ingestion_id": "carga_71", "process_name": "frota", "source_database_name": "db_origem",
        "source_table_name": "contrato", "sor_database_name": "sor_db", "sor_table_name": "frota_viagens",
        "partitions": {"data-referencia": "202509", "dia_base": "15"}, "status": "PROCESSING_SOR", **changes,
    }
    return rows(INGESTION, tuple(row.values()))


def sor_spec(lake):
    return LayerSpec(
        domain="sor",
        sources=[
            SourceSpec(
                "contrato",
                path=lake + "/origem/contrato",
                schema="num_contrato string, vlr_cred_mes double, data_referencia string, dia_base string",
                predicate="data_referencia = '{PARTITION_DATA_REFERENCIA}' AND dia_base = '{PARTITION_DIA_BASE}'",
                duplicate_fields=["num_contrato"],
            )
        ],
        steps=["SELECT num_contrato, vlr_cred_mes, data_referencia, dia_base FROM contrato;"],
        destination=DestSpec(lake + "/sor", "frota_viagens", partition_keys=["ingestion_id"]),
        post_columns={"ingestion_id": "{INGESTION_ID}"},
    )


SOR = "num_contrato string, vlr_cred_mes double, data_referencia string, dia_base string, ingestion_id string"
SOT = "num_contrato string, vlr_cred_mes double, process_id string, regra string"


def rule_spec(lake, predicate="ingestion_id = '{INGESTION_ID}'"):
    return LayerSpec(
        domain="sot",
        sources=[SourceSpec("contratos", table="frota_viagens", path=lake + "/sor/frota_viagens", schema=SOR, predicate=predicate)],
        steps=["SELECT * FROM contratos WHERE vlr_cred_mes > 100", "SELECT num_contrato, vlr_cred_mes FROM query_temp_1"],
        destination=DestSpec(lake + "/sot", "modulos", partition_keys=["process_id", "regra"]),
    )


def test_three_layers(spark, rows, lake):
    assert load_sor(spark, sor_spec(lake), ledger(rows), "carga_71").rows == 2
    assert load_sor(spark, sor_spec(lake), ledger(rows), "carga_71").rows == 2
    later = ledger(rows, ingestion_id="carga_72", partitions={"data-referencia": "202509", "dia_base": "16"})
    assert load_sor(spark, sor_spec(lake), later, "carga_72").rows == 1

    process = rows(PROCESS, ("000731", "frota", "202509", "RUNNING"))
    locks = rows("process_id string, sor_table_name string, ingestion_id string", ("000731", "frota_viagens", "carga_71"))
    assert run_rule(spark, rule_spec(lake), process, locks, "000731", "valor").rows == 1
    modules = spark.read.schema(SOT).parquet(lake + "/sot/modulos")
    assert [tuple(r) for r in modules.collect()] == [("2", 500.0, "000731", "valor")]

    consolidated = DestSpec(lake + "/sot", "contratos", partition_keys=["process_id"])
    assert consolidate_sot({"valor": modules.drop("regra")}, "000731", consolidated).rows == 1

    spec = LayerSpec(
        domain="spec",
        sources=[SourceSpec("contratos_sot", path=consolidated.path, schema=SOT, predicate="process_id = '{PROCESS_ID}'")],
        steps=["SELECT num_contrato, vlr_cred_mes, process_id FROM contratos_sot"],
        destination=DestSpec(lake + "/spec", "contratos", partition_keys=["data_referencia", "process_id"]),
    )
    with pytest.raises(ValueError, match="ready for publication"):
        publish_spec(spark, spec, process, "000731")
    done = process.withColumn("status", F.lit("RULES_PROCESSED"))
    assert publish_spec(spark, spec, done, "000731").rows == 1
    found = spark.read.schema("num_contrato string, vlr_cred_mes double, data_referencia string, process_id string").parquet(lake + "/spec/contratos")
    assert [tuple(r) for r in found.collect()] == [("2", 500.0, "202509", "000731")]
    # post_columns replace the default stamps
    only = replace(spec, post_columns={"process_id": "{PROCESS_ID}"}, destination=DestSpec(lake + "/spec", "so_processo", partition_keys=["process_id"]))
    publish_spec(spark, only, done, "000731")
    assert "data_referencia" not in spark.read.parquet(lake + "/spec/so_processo").columns


@pytest.mark.parametrize(
    "changes",
    [{"status": "LOADED_SOR"}, {"partitions": {}}, {"process_name": None}, {"ingestion_id": "carga_00"}],
)
def test_sor_load_refuses_unusable_rows(spark, rows, lake, changes):
    with pytest.raises(ValueError, match="carga_71"):
        load_sor(spark, sor_spec(lake), ledger(rows, **changes), "carga_71")


def test_locks_are_needed_only_by_versioned_sources(rows, lake):
    locks = rows("process_id string, sor_table_name string, ingestion_id string", ("000731", "frota_viagens", "carga_01"))
    versioned, free = rule_spec(lake).sources[0], SourceSpec("aux", table="aux", predicate="process_id = '{PROCESS_ID}'")
    assert resolve_source_locks([free], locks.limit(0), "000731") == {}
    assert resolve_source_locks([versioned, free], locks, "000731") == {"contratos": {"INGESTION_ID": "carga_01"}}
    with pytest.raises(ValueError, match="frota_viagens"):
        resolve_source_locks([versioned], locks, "000732")
    with pytest.raises(ValueError, match="locked twice"):
        resolve_source_locks([versioned], locks.union(locks.withColumn("ingestion_id", F.lit("x"))), "000731")


def test_repeated_sequential_ids_need_their_full_key(spark, rows, lake):
    both = ledger(rows, ingestion_id="000001").union(ledger(rows, ingestion_id="000001", process_name="credito"))
    with pytest.raises(ValueError, match="several"):
        load_sor(spark, sor_spec(lake), both, "000001")
    assert load_sor(spark, sor_spec(lake), both, "000001", keys={"process_name": "frota"}).rows == 2


def test_a_rule_reads_each_source_at_its_own_version(spark, rows, lake):
    columns = "num_contrato string, v int, ingestion_id string"
    for name, value in (("contratos", 1), ("clientes", 10)):
        rows(columns, *[("1", value * n, f"00000{n}") for n in (1, 2, 3)]).write.partitionBy("ingestion_id").parquet(
            f"{lake}/sor/{name}"
        )
    locks = rows(
        "process_id string, sor_table_name string, ingestion_id string",
        ("000731", "contratos", "000003"), ("000731", "clientes", "000002"), ("000732", "contratos", "000001"),
    )
    sources = [
        SourceSpec(n, path=f"{lake}/sor/{n}", schema=columns, predicate="ingestion_id = '{INGESTION_ID}'", versioned_by=n)
        for n in ("contratos", "clientes")
    ]
    spec = LayerSpec(
        domain="sot",
        sources=sources,
        steps=["SELECT num_contrato, a.v AS x, b.v AS y, '{DATA_REF}' AS ref, '{MES_ANTERIOR}' AS m FROM contratos a JOIN clientes b USING (num_contrato)"],
        destination=DestSpec(lake + "/sot", "juncao", partition_keys=["process_id"]),
    )
    process = rows(PROCESS, ("000731", "frota", "202601", "RUNNING"))
    run_rule(spark, spec, process, locks, "000731")
    found = spark.read.schema("num_contrato string, x int, y int, ref string, m string, process_id string").parquet(lake + "/sot/juncao")
    assert [tuple(r) for r in found.collect()] == [("1", 3, 20, "202601", "12", "000731")]


def test_outcomes_are_recorded(spark, rows, lake):
    """Good load, then a failing one: the good version stays current."""
    log = lake + "/log"
    book = ledger(rows).union(ledger(rows, ingestion_id="carga_72"))
    own = {"identity_keys": ("process_name", "sor_table_name", "ingestion_id")}  # this ledger has no month of its own
    load_and_record(spark, sor_spec(lake), book, "carga_71", log, **own)
    broken = replace(sor_spec(lake), steps=["SELECT num_contrato, raise_error('boom') AS x FROM contrato"])
    with pytest.raises(Exception, match="boom"):
        load_and_record(spark, broken, book, "carga_72", log, **own)
    with pytest.raises(ValueError):
        load_and_record(spark, sor_spec(lake), book, "carga_00", log, **own)
    state = ledger_state(book, spark.read.parquet(log), own["identity_keys"])
    assert {(r["ingestion_id"], r["status"], r["rows"]) for r in state.collect()} == {
        ("carga_71", "LOADED_SOR", 2), ("carga_72", "PROCESSING_FAILURE", None),
    }
    assert current_version(state, ("process_name", "sor_table_name")).first()["current_ingestion_id"] == "carga_71"


def test_overrides_reach_the_scan(spark, rows, lake):
    load_sor(spark, sor_spec(lake), ledger(rows), "carga_71")
    process = rows(PROCESS, ("000731", "frota", "202509", "RUNNING"))
    locks = rows("process_id string, sor_table_name string, ingestion_id string")
    spec = rule_spec(lake, predicate=None)
    report = run_rule(spark, spec, process, locks, "000731", "valor", argument_overrides={"frota_viagens": "vlr_cred_mes > 1000"})
    assert report.rows == 0
    with pytest.raises(ValueError, match="process 000732"):
        run_rule(spark, spec, process, locks, "000732", "valor")
    with pytest.raises(ValueError, match="202613"):
        run_rule(spark, spec, process.withColumn("data_referencia", F.lit("202613")), locks, "000731", "valor")


def test_a_layer_evaluates_its_plan_once(spark, rows, lake):
    """Two executions: the control row is looked up, then one write. Nothing else runs
    the data plan: no listing of touched partitions, no count."""
    context_rows = ledger(rows)
    store = spark._jsparkSession.sharedState().statusStore()

    def executions_with_jobs():
        listed = store.executionsList()
        return [
            listed.apply(i).description() for i in range(listed.size()) if listed.apply(i).jobs().size() > 0
        ]

    before = len(executions_with_jobs())
    load_sor(spark, sor_spec(lake), context_rows, "carga_71")
    assert len(executions_with_jobs()) - before == 2


def test_a_killed_run_is_settled_by_the_manifest(spark, rows, lake):
    """Killed before its output was in place, after it, and still at work."""
    log, manifest = lake + "/log", lake + "/manifest"
    book = ledger(rows)
    own = {"identity_keys": ("process_name", "sor_table_name", "ingestion_id")}
    report = load_and_record(spark, sor_spec(lake), book, "carga_71", log, manifest_path=manifest, **own)
    old, new = datetime(2026, 1, 1, tzinfo=timezone.utc), datetime.now(timezone.utc)
    identity = {"process_name": "frota", "sor_table_name": "t"}
    for run, at, begins in (("cut", old, "PROCESSING_SOR"), ("done", old, "RUNNING"), ("spec", old, "PUBLISHING_SPEC"), ("young", new, "RUNNING")):
        append_status(spark, log, {**identity, "ingestion_id": run}, begins, at, 0, run_id=run)
    append_manifest(spark, report, manifest, "done")
    cutoff = new - timedelta(hours=1)
    assert {r["run_id"] for r in open_runs(spark.read.parquet(log), cutoff).collect()} == {"cut", "done", "spec"}
    for _ in range(2):
        sweep_runs(spark, log, manifest, cutoff)
    found = [(r["ingestion_id"], r["status"], r["rows"]) for r in spark.read.parquet(log).where("seq > 0").collect()]
    assert len(found) == 4 and set(found) == {
        ("cut", "PROCESSING_FAILURE", None), ("done", "RULES_PROCESSED", 2), ("carga_71", "LOADED_SOR", 2), ("spec", "FAILED_SPEC", None),
    }


def test_options_of_a_layer_run(spark, rows, lake):
    """Overrides from a control table, read settings for this job only, a row number."""
    load_sor(spark, sor_spec(lake), ledger(rows), "carga_71")
    process = rows(PROCESS, ("000731", "frota", "202509", "RUNNING"))
    locks = rows("process_id string, sor_table_name string, ingestion_id string")
    control = rows("source_name string, predicate string", ("frota_viagens", "vlr_cred_mes > 1000"), ("frota_viagens", " "), ("other", "x = 1"))
    spec = rule_spec(lake, predicate=None)
    assert run_rule(spark, spec, process, locks, "000731", "valor", table_overrides=control).rows == 0
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    numbered = replace(spec, row_id=RowId("n", order=["num_contrato"]), read_settings={"group_files": "none", "group_size_bytes": 1 << 20})
    report = run_rule(spark, numbered, process, locks, "000731", "valor")
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    found = [r["n"] for r in spark.read.schema(report.schema).parquet(report.path).collect()]
    assert sorted(found) == list(range(1, report.rows + 1)) and report.rows
    unique = run_rule(spark, replace(spec, row_id=RowId("n")), process, locks, "000731", "valor")
    assert unique.rows == report.rows
    with pytest.raises(ValueError, match="read settings"):
        run_rule(spark, replace(spec, read_settings={}), process, locks, "000731", "valor")
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_merged_settings_become_a_destination():
    merged = destination_settings(
        {"group_files": "inPartition", "group_size_bytes": "1", "compression": "snappy", "block_size_bytes": "1024"},
        {"dev": {"compression": "gzip"}}, {"compression": "zstd", "database": "db"}, "dev",
    )
    dest = destination_spec(merged, "/lake", "t", partition_keys=["k"])
    assert (dest.compression, dest.block_size_bytes, dest.database, dest.path, dest.partition_keys) == ("zstd", 1024, "db", "/lake/t", ["k"])


def test_a_load_that_removes_duplicates_sorts_in_bounded_tasks(spark, rows, lake, monkeypatch):
    """Small splits and many parts while such a load runs; other loads, and the session
    afterwards, are as they were."""
    parts = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    settings = lambda: [spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get(parts, None)]
    write, seen, before = layers.write_result, [], settings()
    monkeypatch.setattr(layers, "write_result", lambda *a: seen.append(settings()) or write(*a))
    spec = sor_spec(lake)
    plain = replace(spec, sources=[replace(s, duplicate_fields=None) for s in spec.sources])
    for each in (spec, plain):
        assert load_sor(spark, each, ledger(rows), "carga_71").rows > 0
        assert settings() == before
    assert seen == [[str(1 << 24), "1024"], before]
