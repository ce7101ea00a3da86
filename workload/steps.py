"""Projections, filters, SQL steps, stamps, duplicate removal and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.counts import source_counts, touched_partitions
from tidemark.operators.dedup import drop_duplicates
from tidemark.operators.select import (
    ROW_ID,
    stable_row_id,
    staged_sql,
    surrogate_row_id,
    technical_columns,
)
from workload.inputs import CONTRACT, contract

ALL = "num_contrato, num_parcela, cod_produto, cod_parceiro, quantidade, vlr_cred_mes, situacao, data_base, dia_base"
COLUMNS = ALL.split(", ")


def _sql(*texts, view="contrato", **params):
    return lambda spark, sf: staged_sql(spark, {view: contract(spark, sf)}, texts, params)


def _technical_columns(spark, sf):
    return technical_columns(
        contract(spark, sf).select("num_contrato", "num_parcela", "vlr_cred_mes", "situacao"),
        {"ingestion_id": "000008", "situacao": "CARREGADO"},
    )


def _surrogate_row_id(spark, sf):
    """Every row has an id and no id occurs twice; the ids themselves are not repeatable."""
    return surrogate_row_id(contract(spark, sf)).agg(
        F.count(ROW_ID).alias("n_ids"), F.count_distinct(ROW_ID).alias("n_distinct_ids")
    )


def _stable_row_id(spark, sf):
    order = [c for c in COLUMNS if c != "data_base"]
    return stable_row_id(contract(spark, sf), ["data_base"], order).select(
        "data_base", "num_contrato", "num_parcela", "vlr_cred_mes", ROW_ID
    )


QUERIES = {
    "layout_projection": _sql("SELECT num_contrato, vlr_cred_mes, data_base, dia_base FROM contrato"),
    "select_star": _sql("SELECT * FROM contrato"),
    "row_filter": _sql("SELECT * FROM contrato WHERE vlr_cred_mes > {MINIMO}", MINIMO="30000"),
    "qualified_alias": _sql("SELECT c.num_contrato, c.vlr_cred_mes FROM contratos_sor c", view="contratos_sor"),
    "staged_sql": _sql(
        "SELECT * FROM tabela_contrato WHERE vlr_cred_mes > 30000",
        "SELECT num_contrato, vlr_cred_mes, data_base FROM query_temp_1;",
        view="tabela_contrato",
    ),
    "technical_columns": _technical_columns,
    "surrogate_row_id": _surrogate_row_id,
    "stable_row_id": _stable_row_id,
    "dedup_all": lambda spark, sf: drop_duplicates(
        contract(spark, sf).select("num_contrato", "situacao", "data_base"), ["*"]
    ),
    "dedup_key": lambda spark, sf: drop_duplicates(contract(spark, sf), ["num_contrato", "num_parcela"]),
    "source_counts": lambda spark, sf: source_counts(
        contract(spark, sf), ["data_base"], ["num_contrato", "num_parcela"]
    ),
    "touched_partitions": lambda spark, sf: touched_partitions(
        contract(spark, sf), ["data_base", "situacao"]
    ),
}

DEDUP = (
    f"SELECT {ALL} FROM (SELECT *, row_number() OVER (PARTITION BY num_contrato, num_parcela "
    "ORDER BY cod_produto, cod_parceiro, quantidade, vlr_cred_mes, situacao, data_base, dia_base) AS pos "
    "FROM contrato) WHERE pos = 1"
)

ORACLE = {
    "layout_projection": f"WITH {CONTRACT} SELECT num_contrato, vlr_cred_mes, data_base, dia_base FROM contrato",
    "select_star": f"WITH {CONTRACT} SELECT * FROM contrato",
    "row_filter": f"WITH {CONTRACT} SELECT * FROM contrato WHERE vlr_cred_mes > 30000",
    "qualified_alias": f"WITH {CONTRACT} SELECT num_contrato, vlr_cred_mes FROM contrato",
    "staged_sql": f"WITH {CONTRACT}, query_temp_1 AS (SELECT * FROM contrato WHERE vlr_cred_mes > 30000) "
    "SELECT num_contrato, vlr_cred_mes, data_base FROM query_temp_1",
    "technical_columns": f"WITH {CONTRACT} SELECT num_contrato, num_parcela, vlr_cred_mes, "
    "'CARREGADO' AS situacao, '000008' AS ingestion_id FROM contrato",
    "surrogate_row_id": "SELECT count(*) AS n_ids, count(*) AS n_distinct_ids FROM lineitem",
    "stable_row_id": f"WITH {CONTRACT} SELECT data_base, num_contrato, num_parcela, vlr_cred_mes, "
    "row_number() OVER (PARTITION BY data_base ORDER BY num_contrato, num_parcela, cod_produto, "
    f"cod_parceiro, quantidade, vlr_cred_mes, situacao, dia_base) AS {ROW_ID} FROM contrato",
    "dedup_all": f"WITH {CONTRACT} SELECT DISTINCT num_contrato, situacao, data_base FROM contrato",
    "dedup_key": f"WITH {CONTRACT} {DEDUP}",
    "source_counts": f"WITH {CONTRACT} SELECT data_base, count(*) AS rows_loaded, "
    "count(DISTINCT (num_contrato, num_parcela)) AS rows_after_dedup FROM contrato GROUP BY data_base",
    "touched_partitions": f"WITH {CONTRACT} SELECT data_base, situacao, count(*) AS rows FROM contrato GROUP BY ALL",
}
