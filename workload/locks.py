"""Input locks, locked reads, the publication gate, views over the ledger."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from tidemark import DestSpec
from tidemark.functions.names import zero_padded
from tidemark.operators.versions import PROCESS_KEYS
from tidemark.operators.gate import (
    MANUAL_GATE,
    month_view,
    process_lineage,
    publication_gate,
    spec_decision,
)
from tidemark.operators.locks import (
    create_input_locks,
    lock_as_of,
    lock_inputs,
    locked_read,
    missing_locks,
    process_context,
    resolve_inputs,
    version_by_process_month,
)
from tidemark.sinks import write_partitions
from workload.inputs import (
    CURRENT,
    LEDGER,
    PROCESS_CONFIG,
    REQUESTS,
    RULES,
    current,
    ledger,
    process_config,
    requests,
    rules,
    staged,
    stamp,
    stamp_sql,
    table,
)

KEYS = ["process_name", "sor_table_name", "data_referencia"]


def _requests(spark, sf):
    """Requests with overrides by priority: oldest loaded version, LATEST, unknown id,
    none, a version that failed."""
    versions = (
        ledger(spark, sf)
        .where("sor_table_name = 'orig0'")
        .groupBy("process_name", "data_referencia")
        .agg(
            F.min(F.when(F.col("status") == "LOADED_SOR", F.col("ingestion_id"))).alias("_oldest"),
            F.min(F.when(F.col("status") == "PROCESSING_FAILURE", F.col("ingestion_id"))).alias("_failed"),
        )
    )
    chosen = (
        F.when(F.col("priority") == "1-URGENT", F.col("_oldest"))
        .when(F.col("priority") == "2-HIGH", F.lit("LATEST"))
        .when(F.col("priority") == "3-MEDIUM", F.lit("ing_unknown"))
        .when(F.col("priority") == "5-LOW", F.col("_failed"))
    )
    return (
        requests(spark, sf)
        .join(versions, ["process_name", "data_referencia"], "left")
        .withColumn("input_overrides", F.when(chosen.isNotNull(), F.create_map(F.lit("orig0"), chosen)))
    )


def _resolved(spark, sf):
    return resolve_inputs(_requests(spark, sf), rules(spark), ledger(spark, sf), current(spark, sf))


def _resolve_input_versions(spark, sf):
    return _resolved(spark, sf).select("process_id", *KEYS, "ingestion_id", "lock_source", "problem")


def _create_input_locks(spark, sf):
    locks, _ = create_input_locks(requests(spark, sf), _resolved(spark, sf))
    return locks


def _input_lock_table(spark, sf):
    """Locks as they are written, each with the status of its process."""
    keys = ["process_name", "data_referencia"]

    def write(path):
        at = datetime(2024, 2, 1, 12, tzinfo=timezone.utc)
        given = _requests(spark, sf), rules(spark), ledger(spark, sf), current(spark, sf)
        for _ in range(2):  # a second run replaces the first
            process = lock_inputs(*given, DestSpec(path, "locks", partition_keys=keys), at)
        process.select(*PROCESS_KEYS, "status").write.parquet(f"{path}/process")

    path = staged(spark, sf, "lock-table", write)
    columns = [*PROCESS_KEYS, "sor_table_name", "ingestion_id", "lock_source"]
    locks = spark.read.schema(", ".join(f"{c} string" for c in columns) + ", locked_at timestamp").parquet(f"{path}/locks")
    process = spark.read.schema(", ".join(f"{c} string" for c in [*PROCESS_KEYS, "status"])).parquet(f"{path}/process")
    when = F.date_format("locked_at", "yyyyMMddHH").alias("locked_at")
    return process.join(locks.select(*columns, when), list(PROCESS_KEYS), "left").select("process_id", "status", "sor_table_name", "ingestion_id", "lock_source", "locked_at")


def _process_outcomes(spark, sf):
    _, process = create_input_locks(requests(spark, sf), _resolved(spark, sf))
    return process.select("process_id", "status")


def _locks(spark, sf):
    locks, _ = create_input_locks(requests(spark, sf), _resolved(spark, sf))
    return locks


def _lock_as_of(spark, sf):
    return lock_as_of(requests(spark, sf), rules(spark), ledger(spark, sf)).select(
        "process_id", *KEYS, stamp("locked_at").alias("locked_at"), "ingestion_id"
    )


def _sor_data(spark, sf):
    """SOR rows: each event's payload belongs to the version that loaded it."""
    e = table(spark, sf, "events")
    return e.select(
        F.concat(F.lit("ing_"), zero_padded(F.col("event_id"), 10)).alias("ingestion_id"),
        F.concat(F.lit("orig"), (F.col("event_id") % 5).cast("string")).alias("sor_table_name"),
        F.col("event_id").alias("num_contrato"),
        F.col("value").alias("vlr_cred_mes"),
    )


def _locked_read(spark, sf):
    # these ids name one load each, whatever its process and month
    return locked_read(_sor_data(spark, sf), _locks(spark, sf), ("sor_table_name", "ingestion_id"))


def _locked_read_pruned(spark, sf):
    """A table kept by version and month, read by the full key: ids repeat from one product
    and table to the next, and the lock's versions and months alone are read."""
    rows = _sequenced(ledger(spark, sf))

    def write(path):
        write_partitions(rows, DestSpec(*path.rsplit("/", 1), partition_keys=["ingestion_id", "data_referencia"]))

    data = spark.read.schema(rows.schema).parquet(staged(spark, sf, "sor-by-version", write))
    locks = _sequenced(current(spark, sf).withColumnRenamed("current_ingestion_id", "ingestion_id")).where("data_referencia < '202305'")
    return locked_read(data, locks).select(*KEYS, "ingestion_id", "source_table_name", "versao")


def _sequenced(rows):
    """Versions numbered anew, 000000 to 000003 in every product, table and month."""
    number = F.substring("ingestion_id", -10, 10).cast("long")
    return rows.select(*KEYS, zero_padded(number % 4, 6).alias("ingestion_id"), "source_table_name", F.col("ingestion_id").alias("versao"))


def _missing_locks(spark, sf):
    sources = requests(spark, sf).join(rules(spark), "process_name").select(
        *PROCESS_KEYS, "sor_table_name", (F.col("sor_table_name") != "orig2").alias("uses_version")
    )
    return missing_locks(sources, _locks(spark, sf)).select("process_id", "sor_table_name")


def _gate(statuses):
    def query(spark, sf):
        # Everything is asked for; orders beyond the known processes are refused too.
        process = requests(spark, sf).where("priority <> '5-LOW'")
        ok, refused = publication_gate(requests(spark, sf).select(*PROCESS_KEYS), process, statuses)
        both = ok.withColumn("outcome", F.lit("PUBLISH")).unionByName(refused.withColumn("outcome", F.lit("REFUSED")))
        return both.select("process_id", "outcome")

    return query


def _spec_decision(spark, sf):
    return spec_decision(requests(spark, sf), process_config(spark)).select(
        "process_id", "spec_execution_mode", "spec_trigger", "next_status"
    )


def _month_view(spark, sf):
    process = requests(spark, sf)
    return month_view(process_config(spark), ledger(spark, sf), process, _locks(spark, sf)).select(
        *KEYS,
        "versions",
        "last_ingestion_id",
        "ingestion_status",
        stamp("started_at").alias("started_at"),
        stamp("finished_at").alias("finished_at"),
        "process_id",
        "process_status",
        "locked_ingestion_id",
        "published",
    )


def _version_by_process_month(spark, sf):
    """Every product has a process 000001 in each month; prod0 has two versions on record."""
    versions = current(spark, sf).where("sor_table_name = 'orig1' OR sor_table_name = 'orig2' AND process_name = 'prod0'").select(
        "process_name", "data_referencia", F.lit("000001").alias("process_id"), F.col("current_ingestion_id").alias("ingestion_id")
    )
    asked = table(spark, sf, "customer").select(
        "c_custkey",
        F.concat(F.lit("prod"), (F.col("c_custkey") % 7).cast("string")).alias("process_name"),
        F.concat(F.lit("2023"), zero_padded(F.col("c_nationkey") % 13 + 1, 2)).alias("data_referencia"),
        F.lit("000001").alias("process_id"),
    )
    return version_by_process_month(asked, versions.unionByName(versions))


def _process_context(spark, sf):
    process = requests(spark, sf).select(
        "process_id",
        F.when(F.col("priority") != "3-MEDIUM", F.col("process_name")).alias("process_name"),
        F.when(F.col("priority") != "2-HIGH", F.col("data_referencia")).alias("data_referencia"),
    )
    asked = table(spark, sf, "lineitem").select(
        F.concat(F.lit("proc_"), zero_padded(F.col("l_orderkey"), 10)).alias("process_id"), "l_linenumber"
    )
    df = process_context(asked, process, F.to_date(F.lit("2024-02-29")), keys=("process_id",))
    return df.withColumn("problems", F.array_join("problems", ","))


def _process_lineage(spark, sf):
    published = requests(spark, sf).where("status = 'PUBLISHED'")
    return process_lineage(published, _locks(spark, sf), ledger(spark, sf)).withColumn(
        "loaded_at", stamp("loaded_at")
    )


QUERIES = {
    "resolve_input_versions": _resolve_input_versions,
    "create_input_locks": _create_input_locks,
    "process_outcomes": _process_outcomes,
    "lock_as_of": _lock_as_of,
    "locked_read": _locked_read,
    "input_lock_table": _input_lock_table,
    "locked_read_pruned": _locked_read_pruned,
    "missing_locks": _missing_locks,
    "publication_gate": _gate(("RULES_PROCESSED",)),
    "publication_gate_manual": _gate((*MANUAL_GATE, "PUBLISHED")),
    "spec_decision": _spec_decision,
    "month_view": _month_view,
    "version_by_process_month": _version_by_process_month,
    "process_context": _process_context,
    "process_lineage": _process_lineage,
}

_K = ", ".join(KEYS)
RESOLVED = f"""{LEDGER}, {CURRENT}, {REQUESTS}, {RULES}, picks AS (SELECT process_name, data_referencia,
      min(ingestion_id) FILTER (status = 'LOADED_SOR') AS oldest, min(ingestion_id) FILTER (status = 'PROCESSING_FAILURE') AS failed
      FROM ledger WHERE sor_table_name = 'orig0' GROUP BY ALL),
    overrides AS (SELECT * FROM (SELECT process_id, 'orig0' AS sor_table_name, CASE priority WHEN '1-URGENT' THEN oldest
      WHEN '2-HIGH' THEN 'LATEST' WHEN '3-MEDIUM' THEN 'ing_unknown' WHEN '5-LOW' THEN failed END AS override_id
      FROM requests LEFT JOIN picks USING (process_name, data_referencia)) WHERE override_id IS NOT NULL),
    pairs AS (SELECT process_id, sor_table_name, q.required FROM requests JOIN rules q USING (process_name)),
    slots AS (SELECT process_id, sor_table_name, coalesce(p.required, false) AS required, p.required IS NULL AS stray, override_id
      FROM pairs p FULL JOIN overrides USING (process_id, sor_table_name)),
    resolved AS (SELECT s.process_id, r.process_name, s.sor_table_name, r.data_referencia,
      CASE WHEN stray THEN NULL WHEN override_id IS NOT NULL AND override_id <> 'LATEST' THEN l.ingestion_id
        ELSE c.ingestion_id END AS ingestion_id,
      CASE WHEN stray OR (override_id IS NOT NULL AND override_id <> 'LATEST') THEN 'OVERRIDE' ELSE 'CURRENT_SOR' END AS lock_source,
      CASE WHEN stray THEN 'INVALID_OVERRIDE'
        WHEN override_id IS NOT NULL AND override_id <> 'LATEST' THEN CASE WHEN l.ingestion_id IS NULL THEN 'INVALID_OVERRIDE' END
        WHEN c.ingestion_id IS NULL AND required THEN 'INPUT_MISSING' END AS problem
      FROM slots s JOIN requests r USING (process_id)
      LEFT JOIN ledger l ON l.ingestion_id = s.override_id AND l.status = 'LOADED_SOR' AND l.process_name = r.process_name
        AND l.sor_table_name = s.sor_table_name AND l.data_referencia = r.data_referencia
      LEFT JOIN current_sor c ON c.process_name = r.process_name AND c.sor_table_name = s.sor_table_name
        AND c.data_referencia = r.data_referencia),
    outcomes AS (SELECT process_id, CASE WHEN bool_or(problem IS NOT DISTINCT FROM 'INVALID_OVERRIDE') THEN 'FAILED_INVALID_OVERRIDE'
      WHEN bool_or(problem IS NOT DISTINCT FROM 'INPUT_MISSING') THEN 'FAILED_INPUT_MISSING' ELSE 'RUNNING' END AS status
      FROM resolved GROUP BY process_id),
    locks AS (SELECT r.process_id, {_K}, ingestion_id, lock_source FROM resolved r JOIN outcomes o USING (process_id)
      WHERE o.status = 'RUNNING' AND ingestion_id IS NOT NULL)"""

_GATE = (
    "SELECT process_id, CASE WHEN priority <> '5-LOW' AND status IN ({}) THEN 'PUBLISH' ELSE 'REFUSED' END AS outcome FROM requests"
)

ORACLE = {
    "resolve_input_versions": f"WITH {RESOLVED} SELECT process_id, {_K}, ingestion_id, lock_source, problem FROM resolved",
    "create_input_locks": f"WITH {RESOLVED} SELECT * FROM locks",
    "input_lock_table": f"""WITH {RESOLVED} SELECT process_id, status, sor_table_name, ingestion_id, lock_source,
        CASE WHEN sor_table_name IS NOT NULL THEN '2024020112' END AS locked_at FROM outcomes LEFT JOIN locks USING (process_id)""",
    "process_outcomes": f"WITH {RESOLVED} SELECT process_id, status FROM outcomes",
    "lock_as_of": f"""WITH {LEDGER}, {REQUESTS}, {RULES}, loads AS (SELECT * FROM ledger WHERE status = 'LOADED_SOR'),
        asked AS (SELECT r.process_id, r.process_name, q.sor_table_name, r.data_referencia, r.created_at
          FROM requests r JOIN rules q USING (process_name))
        SELECT a.process_id, a.process_name, a.sor_table_name, a.data_referencia, {stamp_sql('a.created_at')} AS locked_at,
        l.ingestion_id FROM asked a ASOF LEFT JOIN loads l ON a.process_name = l.process_name AND a.sor_table_name = l.sor_table_name
        AND a.data_referencia = l.data_referencia AND a.created_at >= l.loaded_at""",
    "locked_read": f"""WITH {RESOLVED} SELECT printf('ing_%010d', event_id) AS ingestion_id, 'orig' || (event_id % 5) AS sor_table_name,
        event_id AS num_contrato, value AS vlr_cred_mes FROM events WHERE (printf('ing_%010d', event_id), 'orig' || (event_id % 5))
        IN (SELECT (ingestion_id, sor_table_name) FROM locks)""",
    "missing_locks": f"""WITH {RESOLVED}, all_rules(process_name, sor_table_name) AS (SELECT DISTINCT process_name, sor_table_name
        FROM rules UNION ALL SELECT 'prod4', 'orig9') SELECT process_id, a.sor_table_name FROM requests JOIN all_rules a USING (process_name)
        WHERE a.sor_table_name <> 'orig2' AND NOT EXISTS (SELECT 1 FROM locks l WHERE l.process_id = requests.process_id
        AND l.sor_table_name = a.sor_table_name)""",
    "publication_gate": f"WITH {REQUESTS} " + _GATE.format("'RULES_PROCESSED'"),
    "publication_gate_manual": f"WITH {REQUESTS} " + _GATE.format("'RULES_PROCESSED', 'WAITING_SPEC_PUBLICATION', 'PUBLISHED'"),
    "spec_decision": f"""WITH {REQUESTS}, {PROCESS_CONFIG} SELECT process_id, spec_execution_mode,
        CASE spec_execution_mode WHEN 'AUTO' THEN 'AUTO_SPEC' END AS spec_trigger, CASE spec_execution_mode WHEN 'AUTO'
        THEN 'PUBLISHING_SPEC' ELSE 'WAITING_SPEC_PUBLICATION' END AS next_status
        FROM requests JOIN process_config USING (process_name) WHERE status = 'RULES_PROCESSED'""",
    "month_view": f"""WITH {RESOLVED}, {PROCESS_CONFIG}, months AS (SELECT DISTINCT process_name, data_referencia FROM ledger),
        last_load AS (SELECT *, count(*) OVER (PARTITION BY {_K}) AS versions, row_number() OVER (PARTITION BY {_K}
          ORDER BY created_at DESC, ingestion_id DESC) AS pos FROM ledger),
        last_process AS (SELECT *, row_number() OVER (PARTITION BY process_name, data_referencia
          ORDER BY created_at DESC, process_id DESC) AS pos FROM requests)
        SELECT m.process_name, q.sor_table_name, m.data_referencia, coalesce(l.versions, 0) AS versions, l.ingestion_id AS last_ingestion_id,
          l.status AS ingestion_status, {stamp_sql('l.created_at')} AS started_at, {stamp_sql('l.loaded_at')} AS finished_at,
          p.process_id, p.status AS process_status, k.ingestion_id AS locked_ingestion_id,
          coalesce(p.status = 'PUBLISHED', false) AS published
        FROM months m JOIN required q ON q.process_name = m.process_name
        LEFT JOIN last_load l ON l.pos = 1 AND l.process_name = m.process_name AND l.sor_table_name = q.sor_table_name
          AND l.data_referencia = m.data_referencia
        LEFT JOIN last_process p ON p.pos = 1 AND p.process_name = m.process_name AND p.data_referencia = m.data_referencia
        LEFT JOIN locks k ON k.process_id = p.process_id AND k.sor_table_name = q.sor_table_name""",
    "locked_read_pruned": f"""WITH {LEDGER}, {CURRENT}, locks AS (SELECT process_name, sor_table_name, data_referencia,
        CAST(right(ingestion_id, 10) AS BIGINT) % 4 AS n FROM current_sor WHERE data_referencia < '202305')
        SELECT l.process_name, l.sor_table_name, l.data_referencia, printf('%06d', n) AS ingestion_id, source_table_name,
        ingestion_id AS versao FROM ledger l JOIN locks k ON k.process_name = l.process_name AND k.sor_table_name = l.sor_table_name
        AND k.data_referencia = l.data_referencia AND CAST(right(ingestion_id, 10) AS BIGINT) % 4 = n""",
    "version_by_process_month": f"""WITH {LEDGER}, {CURRENT}, asked AS (SELECT c_custkey, 'prod' || (c_custkey % 7) AS process_name,
        printf('2023%02d', c_nationkey % 13 + 1) AS data_referencia FROM customer),
        recorded AS (SELECT process_name, data_referencia, min(ingestion_id) AS version, count(DISTINCT ingestion_id) AS n
        FROM current_sor WHERE sor_table_name = 'orig1' OR sor_table_name = 'orig2' AND process_name = 'prod0' GROUP BY ALL)
        SELECT c_custkey, process_name, data_referencia, '000001' AS process_id, CASE WHEN n = 1 THEN version END AS ingestion_id,
        CASE WHEN n IS NULL THEN 'NOT_FOUND' WHEN n = 1 THEN 'OK' ELSE 'AMBIGUOUS' END AS version_status
        FROM asked LEFT JOIN recorded USING (process_name, data_referencia)""",
    "process_context": f"""WITH {REQUESTS}, known AS (SELECT process_id, CASE WHEN priority <> '3-MEDIUM' THEN process_name END AS process_name,
        CASE WHEN priority <> '2-HIGH' THEN data_referencia END AS data_referencia, true AS found FROM requests),
        j AS (SELECT printf('proc_%010d', l_orderkey) AS process_id, l_linenumber, k.process_name, k.data_referencia, k.found,
        strptime(k.data_referencia || '01', '%Y%m%d') AS d FROM lineitem LEFT JOIN known k ON k.process_id = printf('proc_%010d', l_orderkey))
        SELECT process_id, l_linenumber, process_name, data_referencia, d IS NOT NULL AS data_ref_valida, strftime(d, '%Y') AS ano_data_ref,
        strftime(d, '%m') AS mes_data_ref, strftime(d, '%Y%m') AS ano_mes_data_ref, strftime(d - INTERVAL 1 MONTH, '%Y%m') AS ano_mes_anterior,
        strftime(d - INTERVAL 1 MONTH, '%m') AS mes_anterior, '20240229' AS data_atual, CASE WHEN found IS NULL THEN 'process_id' ELSE
        concat_ws(',', CASE WHEN process_name IS NULL THEN 'process_name' END, CASE WHEN data_referencia IS NULL THEN 'data_referencia' END)
        END AS problems FROM j""",
    "process_lineage": f"""WITH {RESOLVED} SELECT k.process_id, k.process_name, k.sor_table_name, k.data_referencia, k.ingestion_id,
        k.lock_source, l.source_database_name, l.source_table_name, {stamp_sql('l.loaded_at')} AS loaded_at
        FROM requests r JOIN locks k USING (process_id) LEFT JOIN ledger l ON l.ingestion_id = k.ingestion_id WHERE r.status = 'PUBLISHED'""",
}
