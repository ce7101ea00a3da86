"""Input frames derived from the test tables, and the same derivations in SQL.

contract <- lineitem, ledger <- events, requests <- orders; the small configuration
tables are literal, as they are in real use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import zero_padded
from tidemark.operators.versions import current_version
from tidemark.session import scratch_path

_STAGED: dict[tuple[str, str, str], str] = {}
_SCHEMAS: dict[str, T.StructType] = {}


def table(spark, sf: str, name: str) -> DataFrame:
    """A test table. Its schema is read from the file footers once, not on every scan."""
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = SparkSession.active().read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def staged(spark: SparkSession, sf: str, label: str, write) -> str:
    """Path of an intermediate that several queries read; written once per application."""
    key = (spark.sparkContext.applicationId, sf, label)
    if key not in _STAGED:
        path = scratch_path(spark, label)
        write(path)
        _STAGED[key] = path
    return _STAGED[key]


def cents(amount: Column | str) -> Column:
    """Money as whole cents, so that sums do not depend on the order of addition."""
    return F.round((F.col(amount) if isinstance(amount, str) else amount) * 100).cast("long")


def stamp(ts: Column | str) -> Column:
    """Wall-clock time with six decimals, whatever the session's time zone."""
    text = (F.col(ts) if isinstance(ts, str) else ts).cast("string")
    return F.rpad(F.when(F.instr(text, ".") > 0, text).otherwise(F.concat(text, F.lit("."))), 26, "0")


# ---- contract <- lineitem -------------------------------------------------------------

CONTRACT_SELECT = """
    l_orderkey AS num_contrato, l_linenumber AS num_parcela, l_partkey AS cod_produto,
    l_suppkey AS cod_parceiro, l_quantity AS quantidade, l_extendedprice AS vlr_cred_mes,
    l_returnflag AS situacao"""


def contract(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("num_contrato"),
        F.col("l_linenumber").alias("num_parcela"),
        F.col("l_partkey").alias("cod_produto"),
        F.col("l_suppkey").alias("cod_parceiro"),
        F.col("l_quantity").alias("quantidade"),
        F.col("l_extendedprice").alias("vlr_cred_mes"),
        F.col("l_returnflag").alias("situacao"),
        F.date_format("l_shipdate", "yyyyMM").alias("data_base"),
        F.date_format("l_shipdate", "dd").alias("dia_base"),
    )


CONTRACT = f"""contrato AS (SELECT {CONTRACT_SELECT},
    strftime(l_shipdate, '%Y%m') AS data_base, strftime(l_shipdate, '%d') AS dia_base
    FROM lineitem)"""


# ---- ledger <- events -----------------------------------------------------------------


def _label(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def _month(number: Column) -> Column:
    return F.concat(F.lit("2023"), zero_padded(number % 12 + 1, 2))


def arrivals(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.select(
        "event_id",
        F.col("ts").alias("event_time"),
        _label("prod", F.col("user_id") % 5).alias("process_name"),
        _label("db", F.col("user_id") % 3).alias("source_database_name"),
        _label("tab", F.col("event_id") % 5).alias("source_table_name"),
        _label("orig", F.col("event_id") % 5).alias("sor_table_name"),
        _month(F.col("user_id")).alias("data_referencia"),
        "event_type",
        "value",
    )


ARRIVALS = """arrivals AS (SELECT event_id, ts AS event_time, 'prod' || (user_id % 5) AS process_name,
    'db' || (user_id % 3) AS source_database_name, 'tab' || (event_id % 5) AS source_table_name,
    'orig' || (event_id % 5) AS sor_table_name, printf('2023%02d', user_id % 12 + 1) AS data_referencia,
    event_type, value FROM events)"""


def ledger(spark: SparkSession, sf: str) -> DataFrame:
    a = arrivals(spark, sf)
    status = (
        F.when(F.col("event_type") == "error", "PROCESSING_FAILURE")
        .when(F.col("event_type") == "signup", "PROCESSING_SOR")
        .otherwise("LOADED_SOR")
    )
    finish = F.expr("event_time + make_dt_interval(0, 0, cast(event_id * 7 % 90 as int), 0)")
    return a.select(
        F.concat(F.lit("ing_"), zero_padded(F.col("event_id"), 10)).alias("ingestion_id"),
        "process_name",
        "source_database_name",
        "source_table_name",
        F.lit("sor_db").alias("sor_database_name"),
        "sor_table_name",
        "data_referencia",
        status.alias("status"),
        F.col("event_time").alias("created_at"),
        finish.alias("loaded_at"),
    )


LEDGER = (
    ARRIVALS
    + """, ledger AS (SELECT printf('ing_%010d', event_id) AS ingestion_id, process_name,
    source_database_name, source_table_name, 'sor_db' AS sor_database_name, sor_table_name,
    data_referencia, CASE event_type WHEN 'error' THEN 'PROCESSING_FAILURE'
    WHEN 'signup' THEN 'PROCESSING_SOR' ELSE 'LOADED_SOR' END AS status,
    event_time AS created_at, event_time + to_minutes(event_id * 7 % 90) AS loaded_at FROM arrivals)"""
)


def current(spark: SparkSession, sf: str) -> DataFrame:
    return current_version(ledger(spark, sf))


CURRENT = """current_sor AS (SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY process_name, sor_table_name, data_referencia
    ORDER BY loaded_at DESC, ingestion_id DESC) AS pos FROM ledger WHERE status = 'LOADED_SOR')
    WHERE pos = 1)"""


# ---- requests <- orders ---------------------------------------------------------------


def requests(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    status = (
        F.when(F.col("o_orderstatus") == "F", "RULES_PROCESSED")
        .when(F.col("o_orderstatus") == "O", "RUNNING")
        .otherwise("PUBLISHED")
    )
    created = F.expr(
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(o_orderkey % 43200 as int), 0)"
    )
    return o.select(
        F.concat(F.lit("proc_"), zero_padded(F.col("o_orderkey"), 10)).alias("process_id"),
        _label("prod", F.col("o_custkey") % 5).alias("process_name"),
        _month(F.col("o_custkey")).alias("data_referencia"),
        status.alias("status"),
        created.alias("created_at"),
        F.col("o_orderpriority").alias("priority"),
    )


REQUESTS = """requests AS (SELECT printf('proc_%010d', o_orderkey) AS process_id,
    'prod' || (o_custkey % 5) AS process_name, printf('2023%02d', o_custkey % 12 + 1) AS data_referencia,
    CASE o_orderstatus WHEN 'F' THEN 'RULES_PROCESSED' WHEN 'O' THEN 'RUNNING' ELSE 'PUBLISHED' END AS status,
    TIMESTAMP '2024-01-01' + to_minutes(o_orderkey % 43200) AS created_at, o_orderpriority AS priority
    FROM orders)"""


# ---- literal configuration ------------------------------------------------------------

PROCESS_CONFIG_ROWS = (
    ("prod0", "FIRST_ONLY", "AUTO", ("orig0", "orig1", "orig2")),
    ("prod1", "ALWAYS", "MANUAL", ("orig0", "orig3")),
    ("prod2", "ALWAYS", "AUTO", ("orig1", "orig9")),
    ("prod3", "LOCKED", "MANUAL", ("orig2", "orig3", "orig4")),
    ("prod4", "MANUAL", "AUTO", ("orig0",)),
)

RULES_ROWS = (
    ("prod0", "orig0", True, True),
    ("prod0", "orig1", True, None),
    ("prod0", "orig2", False, True),
    ("prod1", "orig0", None, True),
    ("prod1", "orig3", True, True),
    ("prod2", "orig1", True, True),
    ("prod2", "orig9", True, True),
    ("prod3", "orig2", True, True),
    ("prod3", "orig9", False, True),
    ("prod4", "orig4", True, True),
    ("prod4", "orig9", True, False),
)

TABLE_CONFIG_ROWS = tuple(
    (f"prod{p}", f"db{d}", f"tab{t}", "sor_db", f"prod{p}_orig{t}", (p + t) % 4 != 0)
    for p in range(5)
    for d in range(2)
    for t in range(4)
)


def _literal(v) -> str:
    if isinstance(v, tuple):
        return "array(" + ", ".join(_literal(x) for x in v) + ")"
    return "NULL" if v is None else str(v).lower() if isinstance(v, bool) else f"'{v}'"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(_literal(v) for v in r) + ")" for r in rows)


def _config(spark: SparkSession, rows, columns: str) -> DataFrame:
    return spark.sql(f"SELECT * FROM VALUES {_values(rows)} AS t({columns})")


def process_config(spark: SparkSession) -> DataFrame:
    return _config(
        spark, PROCESS_CONFIG_ROWS, "process_name, rules_execution_mode, spec_execution_mode, required_origins"
    )


def rules(spark: SparkSession) -> DataFrame:
    return _config(spark, RULES_ROWS, "process_name, sor_table_name, required, enabled")


def table_config(spark: SparkSession) -> DataFrame:
    return _config(
        spark,
        TABLE_CONFIG_ROWS,
        "process_name, source_database_name, source_table_name, sor_database_name, sor_table_name, enabled",
    )


PROCESS_CONFIG = (
    "process_config(process_name, rules_execution_mode, spec_execution_mode) AS (VALUES "
    + _values(r[:3] for r in PROCESS_CONFIG_ROWS)
    + "), required(process_name, sor_table_name) AS (VALUES "
    + _values((r[0], o) for r in PROCESS_CONFIG_ROWS for o in r[3])
    + ")"
)
RULES = (
    "rules AS (SELECT process_name, sor_table_name, coalesce(required, true) AS required FROM (VALUES "
    + _values(RULES_ROWS)
    + ") AS r(process_name, sor_table_name, required, enabled) WHERE coalesce(enabled, true))"
)
TABLE_CONFIG = (
    "table_config(process_name, source_database_name, source_table_name, sor_database_name, "
    "mapped_table, enabled) AS (VALUES " + _values(TABLE_CONFIG_ROWS) + ")"
)


def stamp_sql(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"
