"""Layer jobs end to end: each result is written, then read back."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from tidemark import DestSpec, LayerSpec, SourceSpec
from tidemark.plans import (
    consolidate_sot,
    load_and_record,
    load_sor,
    publish_and_record,
    publish_spec,
    run_rule,
    run_rules_and_record,
    settled_runs,
)
from tidemark.sinks import read_manifest
from workload.inputs import CONTRACT, contract, ledger, requests, staged, table
from workload.steps import DEDUP

SOR_COLUMNS = ["num_contrato", "num_parcela", "quantidade", "vlr_cred_mes", "data_base", "ingestion_id"]
SINCE = "1996-01-01"
PROCESS_FILTER = {"load": "status = 'PROCESSING_SOR'", "publish": "status = 'RULES_PROCESSED'"}


def _first_load(spark, sf):
    """Ledger with partitions, and the id of the oldest load that still has to run."""
    rows = ledger(spark, sf).withColumn(
        "partitions", F.create_map(F.lit("desde"), F.lit(SINCE), F.lit("data-referencia"), "data_referencia")
    )
    chosen = rows.where(PROCESS_FILTER["load"]).agg(F.min("ingestion_id")).first()[0]
    return rows, chosen


def _first_process(spark, sf):
    process = requests(spark, sf)
    return process, process.where(PROCESS_FILTER["publish"]).agg(F.min("process_id")).first()[0]


def _read_back(spark, path, columns, like):
    types = {f.name: f.dataType.simpleString() for f in like.schema}
    schema = ", ".join(f"{c} {types.get(c, 'string')}" for c in columns)
    return spark.read.schema(schema).parquet(path).select(*columns)


def _sor_path(spark, sf):
    def write(path):
        rows, ingestion_id = _first_load(spark, sf)
        spec = LayerSpec(
            domain="sor",
            sources=[
                SourceSpec(
                    "contrato",
                    "parquet",
                    table="contrato",
                    path=f"{sf}/lineitem.parquet",
                    predicate="l_shipdate >= '{PARTITION_DESDE}'",
                    duplicate_fields=["l_orderkey", "l_linenumber"],
                    duplicate_order=[
                        "l_partkey",
                        "l_suppkey",
                        "l_quantity",
                        "l_extendedprice",
                        "l_returnflag",
                        "l_shipdate",
                    ],
                )
            ],
            steps=[
                "SELECT l_orderkey AS num_contrato, l_linenumber AS num_parcela, l_quantity AS quantidade, "
                "l_extendedprice AS vlr_cred_mes, date_format(l_shipdate, 'yyyyMM') AS data_base FROM contrato"
            ],
            destination=DestSpec(path, "contratos_sor", partition_keys=["ingestion_id"]),
            post_columns={"ingestion_id": "{INGESTION_ID}"},
        )
        for _ in range(2):  # the second run replaces the first
            load_sor(spark, spec, rows, ingestion_id)

    return staged(spark, sf, "sor", write) + "/contratos_sor"


def _sor(spark, sf):
    return _read_back(spark, _sor_path(spark, sf), SOR_COLUMNS, contract(spark, sf))


RULES = {
    "regra_valor": [
        "SELECT * FROM contratos_sor WHERE vlr_cred_mes > 100",
        "SELECT num_contrato, num_parcela, vlr_cred_mes, data_base FROM query_temp_1 WHERE vlr_cred_mes > 20000",
    ],
    "regra_quantidade": [
        "SELECT c.num_contrato, c.num_parcela, c.quantidade, c.data_base FROM contratos_sor c WHERE c.quantidade < 10"
    ],
}
SOT_COLUMNS = ["num_contrato", "num_parcela", "vlr_cred_mes", "quantidade", "data_base", "process_id", "regra"]


def _sot_path(spark, sf):
    def write(path):
        process, process_id = _first_process(spark, sf)
        _, ingestion_id = _first_load(spark, sf)
        locks = process.where(F.col("process_id") == process_id).select(
            "process_id", F.lit("contratos_sor").alias("sor_table_name"), F.lit(ingestion_id).alias("ingestion_id")
        )
        sor_schema = _sor(spark, sf).schema
        for rule, steps in RULES.items():
            spec = LayerSpec(
                domain="sot",
                sources=[
                    SourceSpec(
                        "contratos_sor",
                        "parquet",
                        path=_sor_path(spark, sf),
                        schema=sor_schema,
                        predicate="ingestion_id = '{INGESTION_ID}'",
                    )
                ],
                steps=steps,
                destination=DestSpec(path, "modulos_sot", partition_keys=["process_id", "regra"]),
            )
            run_rule(spark, spec, process, locks, process_id, rule)

    return staged(spark, sf, "sot", write) + "/modulos_sot"


def _modules(spark, sf):
    return _read_back(spark, _sot_path(spark, sf), SOT_COLUMNS, contract(spark, sf))


def _consolidated_path(spark, sf):
    def write(path):
        _, process_id = _first_process(spark, sf)
        modules = _modules(spark, sf)
        frames = {rule: modules.where(F.col("regra") == rule).drop("regra") for rule in RULES}
        consolidate_sot(frames, process_id, DestSpec(path, "contratos_sot", partition_keys=["process_id"]))

    return staged(spark, sf, "consolidated", write) + "/contratos_sot"


def _consolidated(spark, sf):
    return _read_back(spark, _consolidated_path(spark, sf), SOT_COLUMNS, contract(spark, sf))


def _spec_path(spark, sf):
    def write(path):
        process, process_id = _first_process(spark, sf)
        spec = LayerSpec(
            domain="spec",
            sources=[
                SourceSpec(
                    "contratos_sot",
                    "parquet",
                    path=_consolidated_path(spark, sf),
                    schema=_consolidated(spark, sf).schema,
                    predicate="process_id = '{PROCESS_ID}'",
                )
            ],
            steps=["SELECT num_contrato, vlr_cred_mes, quantidade, process_id FROM contratos_sot"],
            destination=DestSpec(path, "contratos_spec", partition_keys=["data_referencia", "process_id"]),
        )
        publish_spec(spark, spec, process, process_id)

    return staged(spark, sf, "spec", write) + "/contratos_spec"


def _publish_spec(spark, sf):
    columns = ["num_contrato", "vlr_cred_mes", "quantidade", "process_id", "data_referencia"]
    return _read_back(spark, _spec_path(spark, sf), columns, contract(spark, sf))


def _life_cycle(spark, sf):
    """Load, rules and publication of two processes, each step in the log. The second load
    breaks off; the second publication fails; a process that is not ready is refused."""

    def write(path):
        log, manifest = f"{path}/log", f"{path}/manifest"
        rows, _ = _first_load(spark, sf)
        first, second = [r["ingestion_id"] for r in rows.where(PROCESS_FILTER["load"]).select("ingestion_id").orderBy("ingestion_id").take(2)]
        source = SourceSpec("contrato", "parquet", path=f"{sf}/lineitem.parquet", predicate="l_shipdate >= '{PARTITION_DESDE}'")
        layout = "SELECT l_orderkey AS num_contrato, l_quantity AS quantidade, l_extendedprice AS vlr_cred_mes FROM contrato"
        sor = LayerSpec("sor", [source], [layout], DestSpec(path, "sor", partition_keys=["ingestion_id"]))
        broken = LayerSpec("sor", [source], [layout.replace("l_orderkey AS", "raise_error('cut') AS")], sor.destination)
        versions = {"keys": {}, "manifest_path": manifest}
        load_and_record(spark, sor, rows, first, log, **versions)
        _refused(lambda: load_and_record(spark, broken, rows, second, log, **versions))
        process = requests(spark, sf).where("status = 'RULES_PROCESSED'")
        one, two = [r["process_id"] for r in process.select("process_id").orderBy("process_id").take(2)]
        locks = requests(spark, sf).where(F.col("process_id").isin(one, two)).select(
            "process_id", F.lit("sor").alias("sor_table_name"), F.lit(first).alias("ingestion_id")
        )
        schema = "num_contrato bigint, quantidade double, vlr_cred_mes double, ingestion_id string"
        read = SourceSpec("sor", path=f"{path}/sor", schema=schema, predicate="ingestion_id = '{INGESTION_ID}'", versioned_by="sor")
        rules = {
            name: LayerSpec("sot", [read], [f"SELECT num_contrato, vlr_cred_mes, quantidade FROM sor WHERE {test}"], DestSpec(path, "modulos", partition_keys=["process_id", "regra"]))
            for name, test in (("valor", "vlr_cred_mes > 20000"), ("quantidade", "quantidade < 10"))
        }
        sot = DestSpec(path, "sot", partition_keys=["process_id"])
        for process_id in (one, two):
            run_rules_and_record(spark, rules, process, locks, process_id, sot, log, manifest_path=manifest)
        source = SourceSpec("sot", path=f"{path}/sot", schema="num_contrato bigint, quantidade double, regra string, process_id string", predicate="process_id = '{PROCESS_ID}'")
        spec = LayerSpec("spec", [source], ["SELECT num_contrato, quantidade FROM sot"], DestSpec(path, "spec", partition_keys=["data_referencia", "process_id"]))
        broken = LayerSpec("spec", [source], ["SELECT raise_error('cut') AS num_contrato, quantidade FROM sot"], spec.destination)
        publish_and_record(spark, spec, process, one, log, manifest_path=manifest)
        _refused(lambda: publish_and_record(spark, broken, process, two, log, manifest_path=manifest))
        running = requests(spark, sf).where("status = 'RUNNING'")
        waiting = running.agg(F.min("process_id")).first()[0]
        _refused(lambda: publish_and_record(spark, spec, running, waiting, log, manifest_path=manifest))

    path = staged(spark, sf, "life-cycle", write)
    log = spark.read.option("mergeSchema", "true").parquet(f"{path}/log")
    written = read_manifest(spark, f"{path}/manifest").groupBy(F.col("write_id").alias("run_id")).agg(F.sum("rows").alias("listed"))
    return log.join(written, "run_id", "left").select(
        F.coalesce("ingestion_id", "process_id").alias("id"), "status", "rows", F.when(F.col("rows").isNotNull(), F.col("listed")).alias("listed")
    )


def _refused(run):
    try:
        run()
    except Exception:  # noqa: BLE001
        return
    raise AssertionError("the run should have failed")


def _recovered_runs(spark, sf):
    """Runs of all kinds: ended, killed after their output was in place, killed before, too
    young to judge."""
    e = table(spark, sf, "events").select(
        F.concat(F.lit("run_"), F.col("event_id").cast("string")).alias("run_id"),
        F.concat(F.lit("proc_"), (F.col("event_id") % 50).cast("string")).alias("process_id"),
        F.element_at(F.array(*map(F.lit, ("PROCESSING_SOR", "RUNNING", "PUBLISHING_SPEC"))), (F.col("event_id") % 3 + 1).cast("int")).alias("status"),
        F.col("ts").cast("timestamp").alias("at"),
        "event_id",
    )
    row = lambda status, seq: e.select("process_id", status.alias("status"), "at", F.lit(seq).cast("long").alias("seq"), F.lit(None).cast("long").alias("rows"), "run_id", "event_id")
    log = row(F.col("status"), 0).unionByName(row(F.lit("LOADED_SOR"), 1).where("event_id % 4 = 0")).drop("event_id")
    files = e.where("event_id % 5 < 2").select(F.col("run_id").alias("write_id"), F.explode(F.sequence(F.lit(1), F.lit(2))).alias("f"), "event_id")
    manifest = files.select("write_id", (F.col("event_id") % 7 + F.col("f")).alias("rows"))
    moments = [datetime(2024, 1, d, tzinfo=timezone.utc) for d in (20, 31)]
    return settled_runs(log, manifest, *moments).select("run_id", "process_id", "status", "rows")


QUERIES = {
    "life_cycle": _life_cycle,
    "recovered_runs": _recovered_runs,
    "load_sor": _sor,
    "run_rule": _modules,
    "consolidate_sot": _consolidated,
    "publish_spec": _publish_spec,
}

SINCE_DEDUP = DEDUP.replace("FROM contrato)", f"FROM contrato WHERE data_base >= '{SINCE[:4] + SINCE[5:7]}')")
_SOR = (
    CONTRACT
    + f", loaded AS (SELECT *, (SELECT printf('ing_%010d', min(event_id)) FROM events WHERE event_type = 'signup') "
    f"AS ingestion_id FROM ({SINCE_DEDUP})), chosen AS (SELECT printf('proc_%010d', min(o_orderkey)) AS process_id, "
    "printf('2023%02d', arg_min(o_custkey, o_orderkey) % 12 + 1) AS data_referencia FROM orders WHERE o_orderstatus = 'F')"
)
_SOT = (
    "SELECT num_contrato, num_parcela, vlr_cred_mes, CAST(NULL AS DOUBLE) AS quantidade, data_base, process_id, "
    "'regra_valor' AS regra FROM loaded, chosen WHERE vlr_cred_mes > 20000 "
    "UNION ALL SELECT num_contrato, num_parcela, NULL, quantidade, data_base, process_id, 'regra_quantidade' "
    "FROM loaded, chosen WHERE quantidade < 10"
)
_LATE = (
    f"late AS (SELECT l_orderkey AS num_contrato, l_quantity AS quantidade, l_extendedprice AS valor FROM lineitem WHERE l_shipdate >= DATE '{SINCE}'), "
    "sizes AS (SELECT count(*) AS sor, count(*) FILTER (valor > 20000) + count(*) FILTER (quantidade < 10) AS sot FROM late), "
    "loads AS (SELECT printf('ing_%010d', event_id) AS id, row_number() OVER (ORDER BY event_id) AS n FROM events WHERE event_type = 'signup'), "
    "runs AS (SELECT printf('proc_%010d', o_orderkey) AS id, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders WHERE o_orderstatus = 'F'), "
    "steps(kind, n, status, counted) AS (VALUES ('load', 1, 'PROCESSING_SOR', NULL), ('load', 1, 'LOADED_SOR', 'sor'), "
    "('load', 2, 'PROCESSING_SOR', NULL), ('load', 2, 'PROCESSING_FAILURE', NULL), ('run', 1, 'RUNNING', NULL), ('run', 1, 'RULES_PROCESSED', 'sot'), "
    "('run', 2, 'RUNNING', NULL), ('run', 2, 'RULES_PROCESSED', 'sot'), ('run', 1, 'PUBLISHING_SPEC', NULL), ('run', 1, 'PUBLISHED', 'sot'), "
    "('run', 2, 'PUBLISHING_SPEC', NULL), ('run', 2, 'FAILED_SPEC', NULL))"
)
_COUNTED = "CASE counted WHEN 'sor' THEN sor WHEN 'sot' THEN sot END"
ORACLE = {
    "life_cycle": f"WITH {_LATE} SELECT coalesce(l.id, r.id) AS id, status, {_COUNTED} AS rows, {_COUNTED} AS listed FROM steps s "
    "LEFT JOIN loads l ON s.kind = 'load' AND l.n = s.n LEFT JOIN runs r ON s.kind = 'run' AND r.n = s.n, sizes",
    "recovered_runs": "SELECT 'run_' || event_id AS run_id, 'proc_' || (event_id % 50) AS process_id, CASE WHEN event_id % 5 < 2 THEN "
    "['LOADED_SOR', 'RULES_PROCESSED', 'PUBLISHED'][event_id % 3 + 1] ELSE ['PROCESSING_FAILURE', 'FAILED_RULES', 'FAILED_SPEC'][event_id % 3 + 1] END "
    "AS status, CASE WHEN event_id % 5 < 2 THEN 2 * (event_id % 7) + 3 END AS rows FROM events WHERE event_id % 4 <> 0 AND ts < TIMESTAMP '2024-01-20'",
    "load_sor": f"WITH {_SOR} SELECT {', '.join(SOR_COLUMNS)} FROM loaded",
    "run_rule": f"WITH {_SOR} {_SOT}",
    "consolidate_sot": f"WITH {_SOR} {_SOT}",
    "publish_spec": f"WITH {_SOR}, sot AS ({_SOT}) SELECT num_contrato, vlr_cred_mes, quantidade, process_id, data_referencia "
    "FROM sot JOIN chosen USING (process_id)",
}
