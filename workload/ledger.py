"""Version ids, current versions, readiness, triggers and state changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.names import zero_padded
from tidemark.operators.readiness import execution_triggers, missing_inputs, readiness
from tidemark.operators.transitions import (
    INGESTION_MOVES,
    PROCESS_MOVES,
    checked_transitions,
    latest_status,
)
from tidemark.operators.versions import (
    assign_ingestion_id,
    assign_process_id,
    current_version,
    ingestion_history,
    latest_versions,
    process_list,
)
from workload.inputs import (
    ARRIVALS,
    CURRENT,
    LEDGER,
    PROCESS_CONFIG,
    REQUESTS,
    arrivals,
    current,
    ledger,
    process_config,
    requests,
    stamp,
    stamp_sql,
    table,
)

KEYS = ["process_name", "sor_table_name", "data_referencia"]


def _earlier_ledger(spark, sf):
    """Versions issued before the arrivals: the sequences must go on from these."""
    o = table(spark, sf, "orders")
    return o.select(
        F.concat(F.lit("prod"), (F.col("o_custkey") % 5).cast("string")).alias("process_name"),
        F.concat(F.lit("orig"), (F.col("o_orderkey") % 4).cast("string")).alias("sor_table_name"),
        F.concat(F.lit("2023"), zero_padded(F.col("o_custkey") % 12 + 1, 2)).alias("data_referencia"),
        zero_padded(F.col("o_orderkey") % 1000, 6).alias("ingestion_id"),
    )


def _assign_ingestion_id(spark, sf):
    return assign_ingestion_id(arrivals(spark, sf), _earlier_ledger(spark, sf)).select(
        "event_id", *KEYS, "ingestion_id"
    )


def _process_requests(spark, sf):
    return requests(spark, sf).withColumnRenamed("process_id", "request_id").drop("status")


def _earlier_process(spark, sf):
    return table(spark, sf, "customer").select(
        F.concat(F.lit("prod"), (F.col("c_custkey") % 5).cast("string")).alias("process_name"),
        F.concat(F.lit("2023"), zero_padded(F.col("c_nationkey") % 12 + 1, 2)).alias("data_referencia"),
        F.concat(F.lit("proc_x_"), zero_padded(F.col("c_custkey") % 50, 3)).alias("process_id"),
        F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("proc_"), zero_padded(F.col("c_custkey"), 10))).alias("request_id"),
    )


def _assign_process_id(named):
    def query(spark, sf):
        return assign_process_id(
            _process_requests(spark, sf), _earlier_process(spark, sf), named=named
        ).select("request_id", "process_name", "data_referencia", "process_id")

    return query


def _current_version(spark, sf):
    return current_version(ledger(spark, sf)).select(
        *KEYS, "current_ingestion_id", "status", stamp("loaded_at").alias("updated_at")
    )


def _latest_n_versions(spark, sf):
    return latest_versions(ledger(spark, sf), n=3).select(*KEYS, "ingestion_id", stamp("loaded_at").alias("loaded_at"))


def _ingestion_history(spark, sf):
    return ingestion_history(ledger(spark, sf)).select(*KEYS, "ingestion_id", stamp("loaded_at").alias("loaded_at"))


def _origins_received(spark, sf):
    df = readiness(process_config(spark), current(spark, sf))
    received = F.transform(
        F.sort_array(F.map_entries("received_origins")), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return df.select(
        "process_name",
        "data_referencia",
        F.array_join(received, ",").alias("received"),
        F.array_join("missing_origins", ",").alias("missing"),
        F.col("received_count").cast("long").alias("received_count"),
        F.col("missing_count").cast("long").alias("missing_count"),
        "window_status",
    )


def _missing_inputs(spark, sf):
    return missing_inputs(process_config(spark), current(spark, sf)).select(*KEYS)


def _execution_triggers(spark, sf):
    return execution_triggers(ledger(spark, sf), process_config(spark)).select(
        *KEYS, "ingestion_id", stamp("triggered_at").alias("triggered_at"), "rules_execution_mode", "trigger_reason"
    )


def _status_rows(spark, sf):
    """Status rows per ingestion: many users' events on one id, so some moves are illegal."""
    status = (
        F.when(F.col("event_type").isin("signup", "view"), "PROCESSING_SOR")
        .when(F.col("event_type") == "error", "PROCESSING_FAILURE")
        .otherwise("LOADED_SOR")
    )
    return table(spark, sf, "events").select(
        F.concat(F.lit("ing_"), zero_padded(F.col("user_id"), 5)).alias("ingestion_id"),
        status.alias("status"),
        F.col("ts").alias("at"),
        F.col("event_id").alias("seq"),
    )


def _ingestion_transitions(spark, sf):
    return checked_transitions(_status_rows(spark, sf), ["ingestion_id"], INGESTION_MOVES).select(
        "ingestion_id", "seq", "status", "previous_status", "allowed"
    )


_PROCESS_STATUS = ("LOCKING_INPUTS", "RUNNING", "RULES_PROCESSED", "PUBLISHED")


def _process_rows(spark, sf):
    status = F.element_at(
        F.array(*[F.lit(s) for s in _PROCESS_STATUS]), (F.col("l_linenumber") % 4 + 1).cast("int")
    )
    return table(spark, sf, "lineitem").select(
        F.concat(F.lit("proc_"), zero_padded(F.col("l_orderkey"), 10)).alias("process_id"),
        status.alias("status"),
        F.col("l_shipdate").alias("at"),
        F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount").alias("seq"),
    )


def _process_transitions(spark, sf):
    return checked_transitions(_process_rows(spark, sf), ["process_id"], PROCESS_MOVES).select(
        "process_id",
        stamp("at").alias("changed_at"),
        F.col("seq.l_linenumber").alias("line"),
        F.col("seq.l_partkey").alias("part"),
        "status",
        "previous_status",
        "allowed",
    )


def _latest_status(spark, sf):
    return latest_status(_status_rows(spark, sf), ["ingestion_id"]).select(
        "ingestion_id", "status", stamp("updated_at").alias("updated_at"), "changes"
    )


def _process_list(spark, sf):
    return process_list(requests(spark, sf))


QUERIES = {
    "assign_ingestion_id": _assign_ingestion_id,
    "assign_process_id": _assign_process_id(False),
    "assign_process_id_named": _assign_process_id(True),
    "current_version": _current_version,
    "latest_n_versions": _latest_n_versions,
    "ingestion_history": _ingestion_history,
    "origins_received": _origins_received,
    "missing_inputs": _missing_inputs,
    "execution_triggers": _execution_triggers,
    "ingestion_transitions": _ingestion_transitions,
    "process_transitions": _process_transitions,
    "latest_status": _latest_status,
    "process_list": _process_list,
}

_K = ", ".join(KEYS)
_EARLIER = (
    "earlier AS (SELECT 'prod' || (o_custkey % 5) AS process_name, 'orig' || (o_orderkey % 4) AS sor_table_name, "
    "printf('2023%02d', o_custkey % 12 + 1) AS data_referencia, max(o_orderkey % 1000) AS base FROM orders GROUP BY ALL)"
)
_EARLIER_PROCESS = (
    "earlier AS (SELECT 'prod' || (c_custkey % 5) AS process_name, printf('2023%02d', c_nationkey % 12 + 1) AS data_referencia, "
    "max(c_custkey % 50) AS base FROM customer GROUP BY ALL), known AS (SELECT printf('proc_%010d', c_custkey) AS id "
    "FROM customer WHERE c_custkey % 2 = 0)"
)
_NUMBER = (
    "row_number() OVER (PARTITION BY process_name, data_referencia ORDER BY created_at, process_id) + coalesce(base, 0)"
)
_ALLOWED = {
    name: "concat(coalesce(previous_status, ''), '>', status) IN ("
    + ", ".join(f"'{a or ''}>{b}'" for a, b in moves)
    + ")"
    for name, moves in (("ingestion", INGESTION_MOVES), ("process", PROCESS_MOVES))
}
_STATUS_ROWS = (
    "status_rows AS (SELECT printf('ing_%05d', user_id) AS ingestion_id, CASE WHEN event_type IN ('signup', 'view') "
    "THEN 'PROCESSING_SOR' WHEN event_type = 'error' THEN 'PROCESSING_FAILURE' ELSE 'LOADED_SOR' END AS status, "
    "ts, event_id AS seq FROM events)"
)

TRIGGERS = f"""WITH {LEDGER}, {PROCESS_CONFIG}, loads AS (SELECT l.*, c.rules_execution_mode,
      (SELECT count(*) FROM required q WHERE q.process_name = l.process_name) AS n_required,
      row_number() OVER (PARTITION BY {_K} ORDER BY loaded_at, ingestion_id) = 1 AS first_load
    FROM ledger l JOIN required USING (process_name, sor_table_name) JOIN process_config c USING (process_name)
    WHERE status = 'LOADED_SOR' AND c.rules_execution_mode IN ('FIRST_ONLY', 'ALWAYS')),
    walked AS (SELECT *, sum(CASE WHEN first_load THEN 1 ELSE 0 END) OVER w AS got,
      row_number() OVER w AS pos FROM loads
      WINDOW w AS (PARTITION BY process_name, data_referencia ORDER BY loaded_at, ingestion_id, sor_table_name
        ROWS UNBOUNDED PRECEDING)),
    ready AS (SELECT *, min(pos) OVER (PARTITION BY process_name, data_referencia) AS first_ready
      FROM walked WHERE got = n_required)
    SELECT {_K}, ingestion_id, {stamp_sql('loaded_at')} AS triggered_at, rules_execution_mode,
      CASE WHEN pos = first_ready THEN 'READY' ELSE 'NEW_LOAD' END AS trigger_reason
    FROM ready WHERE rules_execution_mode = 'ALWAYS' OR pos = first_ready"""

ASSIGNED = f"""WITH {ARRIVALS}, {_EARLIER} SELECT event_id, {_K}, printf('%06d',
    row_number() OVER (PARTITION BY {_K} ORDER BY event_time, event_id) + coalesce(base, 0)) AS ingestion_id
    FROM arrivals LEFT JOIN earlier USING ({_K})"""

ORACLE = {
    "assign_ingestion_id": ASSIGNED,
    "assign_process_id": f"WITH {REQUESTS}, {_EARLIER_PROCESS} SELECT process_id AS request_id, process_name, data_referencia, "
    f"printf('%06d', {_NUMBER}) AS process_id FROM requests LEFT JOIN earlier USING (process_name, data_referencia) "
    "WHERE process_id NOT IN (SELECT id FROM known)",
    "assign_process_id_named": f"WITH {REQUESTS}, {_EARLIER_PROCESS} SELECT process_id AS request_id, process_name, "
    f"data_referencia, printf('proc_%s_%s_%03d', process_name, data_referencia, {_NUMBER}) AS process_id "
    "FROM requests LEFT JOIN earlier USING (process_name, data_referencia) WHERE process_id NOT IN (SELECT id FROM known)",
    "current_version": f"WITH {LEDGER}, {CURRENT} SELECT {_K}, ingestion_id AS current_ingestion_id, status, "
    f"{stamp_sql('loaded_at')} AS updated_at FROM current_sor",
    "latest_n_versions": f"WITH {LEDGER} SELECT {_K}, ingestion_id, {stamp_sql('loaded_at')} AS loaded_at FROM (SELECT *, "
    f"row_number() OVER (PARTITION BY {_K} ORDER BY loaded_at DESC, ingestion_id DESC) AS pos FROM ledger "
    "WHERE status = 'LOADED_SOR') WHERE pos <= 3",
    "ingestion_history": f"WITH {LEDGER} SELECT {_K}, ingestion_id, {stamp_sql('loaded_at')} AS loaded_at FROM ledger "
    "WHERE status = 'LOADED_SOR'",
    "origins_received": f"""WITH {LEDGER}, {CURRENT}, {PROCESS_CONFIG}, windows AS (SELECT DISTINCT process_name, data_referencia
        FROM current_sor), j AS (SELECT w.*, c.rules_execution_mode AS m, r.sor_table_name AS o, s.ingestion_id AS i FROM windows w
        JOIN process_config c USING (process_name) JOIN required r USING (process_name) LEFT JOIN current_sor s
        ON s.process_name = w.process_name AND s.data_referencia = w.data_referencia AND s.sor_table_name = r.sor_table_name)
        SELECT process_name, data_referencia, coalesce(string_agg(o || '=' || i, ',' ORDER BY o) FILTER (i IS NOT NULL), '') AS received,
        coalesce(string_agg(o, ',' ORDER BY o) FILTER (i IS NULL), '') AS missing, count(i) AS received_count,
        count(*) FILTER (i IS NULL) AS missing_count, CASE WHEN count(*) FILTER (i IS NULL) > 0 THEN 'WAITING_INPUTS'
        WHEN any_value(m) IN ('MANUAL', 'LOCKED') THEN 'MANUAL_REQUIRED' ELSE 'LOCKED_FOR_EXECUTION' END AS window_status
        FROM j GROUP BY process_name, data_referencia""",
    "missing_inputs": f"""WITH {LEDGER}, {CURRENT}, {PROCESS_CONFIG} SELECT DISTINCT w.process_name, r.sor_table_name, w.data_referencia
        FROM current_sor w JOIN required r USING (process_name) WHERE NOT EXISTS (SELECT 1 FROM current_sor s
        WHERE s.process_name = w.process_name AND s.data_referencia = w.data_referencia AND s.sor_table_name = r.sor_table_name)""",
    "execution_triggers": TRIGGERS,
    "ingestion_transitions": f"WITH {_STATUS_ROWS}, p AS (SELECT *, lag(status) OVER (PARTITION BY ingestion_id ORDER BY ts, seq) "
    f"AS previous_status FROM status_rows) SELECT ingestion_id, seq, status, previous_status, {_ALLOWED['ingestion']} AS allowed FROM p",
    "process_transitions": f"""WITH s AS (SELECT printf('proc_%010d', l_orderkey) AS process_id, CASE l_linenumber % 4
        WHEN 0 THEN 'LOCKING_INPUTS' WHEN 1 THEN 'RUNNING' WHEN 2 THEN 'RULES_PROCESSED' ELSE 'PUBLISHED' END AS status, *
        FROM lineitem), p AS (SELECT *, lag(status) OVER (PARTITION BY process_id ORDER BY l_shipdate, l_linenumber, l_partkey,
        l_suppkey, l_extendedprice, l_quantity, l_discount) AS previous_status FROM s) SELECT process_id,
        {stamp_sql('l_shipdate')} AS changed_at, l_linenumber AS line, l_partkey AS part, status, previous_status,
        {_ALLOWED['process']} AS allowed FROM p""",
    "latest_status": f"WITH {_STATUS_ROWS} SELECT ingestion_id, arg_max(status, (ts, seq)) AS status, "
    f"{stamp_sql('max(ts)')} AS updated_at, count(*) AS changes FROM status_rows GROUP BY ingestion_id",
    "process_list": f"WITH {REQUESTS} SELECT process_name, data_referencia, count(*) AS executions, "
    "count(*) FILTER (status = 'RUNNING') AS running, count(*) FILTER (status = 'RULES_PROCESSED') AS rules_processed, "
    "count(*) FILTER (status = 'PUBLISHED') AS published, arg_max(process_id, (created_at, process_id)) AS latest_process_id, "
    "arg_max(status, (created_at, process_id)) AS latest_status FROM requests GROUP BY ALL",
}
