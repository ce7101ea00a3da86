"""Reference dates, names, templates, flags and checks over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.names import (
    flag_is_true,
    normalize_name,
    partition_context,
    partition_path,
    sor_name,
)
from tidemark.functions.predicates import parse_override_list
from tidemark.functions.quality import required_fields
from tidemark.functions.refdate import (
    ano_data_ref,
    ano_mes_anterior,
    ano_mes_data_ref,
    data_atual,
    mes_anterior,
    mes_data_ref,
    parse_data_ref,
    with_reference_context,
)
from tidemark.functions.templates import fill_template, unresolved_names
from workload.inputs import LEDGER, ledger, table

# Valid month, valid day, month 13, 30 February, bare year: one form per priority.
_FORMS = {
    "1-URGENT": ("yyyyMM", "%Y%m"),
    "2-HIGH": ("yyyyMMdd", "%Y%m%d"),
    "3-MEDIUM": ("yyyy'13'", "%Y13"),
    "4-NOT SPECIFIED": ("yyyy'0230'", "%Y0230"),
    "5-LOW": ("yyyy", "%Y"),
}


def _refs(spark, sf):
    ref = F.lit(None).cast("string")
    for priority, (pattern, _) in _FORMS.items():
        ref = F.when(F.col("o_orderpriority") == priority, F.date_format("o_orderdate", pattern)).otherwise(ref)
    return table(spark, sf, "orders").select("o_orderkey", "o_orderdate", ref.alias("ref"))


_REFS = (
    "refs AS (SELECT o_orderkey, o_orderdate, CASE o_orderpriority "
    + " ".join(f"WHEN '{p}' THEN strftime(o_orderdate, '{d}')" for p, (_, d) in _FORMS.items())
    + " END AS ref FROM orders), parsed AS (SELECT *, CASE length(ref) "
    "WHEN 6 THEN try_strptime(ref || '01', '%Y%m%d') WHEN 8 THEN try_strptime(ref, '%Y%m%d') END AS d FROM refs)"
)


def _ref_columns(**columns):
    def query(spark, sf):
        day = parse_data_ref(F.col("ref"))
        return _refs(spark, sf).select("o_orderkey", *[make(day).alias(n) for n, make in columns.items()])

    return query


def _reference_context(spark, sf):
    return with_reference_context(
        _refs(spark, sf), "ref", F.to_date(F.lit("2024-03-31"))
    ).drop("o_orderdate")


def _days(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderpriority",
        F.date_format("o_orderdate", "yyyyMM").alias("mes"),
        F.date_format("o_orderdate", "dd").alias("dia"),
    )


def _partition_context(spark, sf):
    partitions = F.create_map(F.lit("data-referencia"), "mes", F.lit("dia base"), "dia")
    return _days(spark, sf).select(
        "o_orderkey", F.explode(partition_context(partitions)).alias("placeholder", "valor")
    )


def _bind_parameters(spark, sf):
    context = F.create_map(
        F.lit("PARTITION_DATA_REFERENCIA"), "mes", F.lit("PARTITION_DIA_BASE"), "dia"
    )
    template = F.when(
        F.col("o_orderpriority") == "5-LOW", F.lit("data_base = '{DATA_REF}' AND dia = '{PARTITION_DIA_BASE}'")
    ).otherwise(F.lit("data_referencia = '{PARTITION_DATA_REFERENCIA}' AND dia_base = '{PARTITION_DIA_BASE}'"))
    return _days(spark, sf).select(
        "o_orderkey",
        fill_template(template, context).alias("predicate"),
        F.array_join(unresolved_names(template, context), ",").alias("unresolved"),
    )


def _normalize_name(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        normalize_name(F.col("p_type")).alias("tipo"),
        normalize_name(F.concat_ws("-", "p_brand", "p_name")).alias("nome"),
    )


def _sor_name(spark, sf):
    segment = F.lower("c_mktsegment")
    return table(spark, sf, "customer").select(
        "c_custkey", sor_name(segment, F.lit("contratos")).alias("sor_table_name")
    )


def _partition_path(spark, sf):
    rows = _days(spark, sf).withColumn("dia", F.when(F.col("dia") != "01", F.col("dia")))
    return rows.select(
        "o_orderkey",
        partition_path(F.lit("/lake/sor//"), F.lit("contratos"), ["mes", "dia"]).alias("path"),
    )


def _flag_normalize(spark, sf):
    raw = (
        F.when(F.col("event_type") == "error", F.lit(" TRUE "))
        .when(F.col("event_type") == "click", F.lit("False"))
        .when(F.col("event_type") == "view", F.lit("true"))
        .when(F.col("event_type") == "signup", F.lit("yes"))
    )
    return table(spark, sf, "events").select("event_id", flag_is_true(raw).alias("flag"))


def _override_text():
    key = F.col("o_custkey").cast("string")
    return F.concat(
        F.lit("mal_formatado; contrato :: id > "),
        key,
        F.lit(";cliente::;::x = 1;parcela::a::b = "),
        "o_orderpriority",
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit(";contrato::id < "), key)).otherwise(F.lit("")),
    )


def _parse_override_list(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.explode(parse_override_list(_override_text())).alias("source_name", "predicate"),
    )


def _required_fields(spark, sf):
    rows = ledger(spark, sf).withColumns(
        {
            "source_table_name": F.when(F.col("source_table_name") != "tab3", F.col("source_table_name")),
            "sor_database_name": F.when(F.col("source_database_name") != "db2", F.col("sor_database_name")),
            "partitions": F.when(
                F.col("sor_table_name") != "orig1",
                F.create_map(F.lit("data_referencia"), "data_referencia"),
            ).otherwise(F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))),
        }
    )
    return required_fields(rows).select(
        "ingestion_id",
        F.array_join("missing_fields", ",").alias("missing_fields"),
        F.array_join("problems", ",").alias("problems"),
    )


QUERIES = {
    "parse_data_ref": _ref_columns(data=lambda d: F.date_format(d, "yyyy-MM-dd"), valida=lambda d: d.isNotNull()),
    "ano_mes_parts": _ref_columns(ano_data_ref=ano_data_ref, mes_data_ref=mes_data_ref),
    "ano_mes_data_ref": lambda spark, sf: _refs(spark, sf).select(
        "o_orderkey", ano_mes_data_ref(F.col("ref")).alias("ano_mes_data_ref")
    ),
    "ano_mes_anterior": _ref_columns(ano_mes_anterior=ano_mes_anterior, mes_anterior=mes_anterior),
    "data_atual": lambda spark, sf: table(spark, sf, "orders").select(
        "o_orderkey", data_atual(F.col("o_orderdate")).alias("data_atual")
    ),
    "reference_context": _reference_context,
    "normalize_name": _normalize_name,
    "partition_context": _partition_context,
    "bind_parameters": _bind_parameters,
    "sor_name": _sor_name,
    "partition_path": _partition_path,
    "flag_normalize": _flag_normalize,
    "parse_override_list": _parse_override_list,
    "required_fields": _required_fields,
}

_PREVIOUS = "date_trunc('month', d) - INTERVAL 1 MONTH"

ORACLE = {
    "parse_data_ref": f"WITH {_REFS} SELECT o_orderkey, strftime(d, '%Y-%m-%d') AS data, d IS NOT NULL AS valida FROM parsed",
    "ano_mes_parts": f"WITH {_REFS} SELECT o_orderkey, strftime(d, '%Y') AS ano_data_ref, strftime(d, '%m') AS mes_data_ref FROM parsed",
    "ano_mes_data_ref": f"WITH {_REFS} SELECT o_orderkey, left(ref, 6) AS ano_mes_data_ref FROM refs",
    "ano_mes_anterior": f"WITH {_REFS} SELECT o_orderkey, strftime({_PREVIOUS}, '%Y%m') AS ano_mes_anterior, "
    f"strftime({_PREVIOUS}, '%m') AS mes_anterior FROM parsed",
    "data_atual": "SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS data_atual FROM orders",
    "reference_context": f"WITH {_REFS} SELECT o_orderkey, ref, d IS NOT NULL AS data_ref_valida, "
    "strftime(d, '%Y') AS ano_data_ref, strftime(d, '%m') AS mes_data_ref, strftime(d, '%Y%m') AS ano_mes_data_ref, "
    f"strftime({_PREVIOUS}, '%Y%m') AS ano_mes_anterior, strftime({_PREVIOUS}, '%m') AS mes_anterior, "
    "'20240331' AS data_atual FROM parsed",
    "normalize_name": "SELECT p_partkey, regexp_replace(upper(p_type), '[^A-Z0-9_]', '_', 'g') AS tipo, "
    "regexp_replace(upper(p_brand || '-' || p_name), '[^A-Z0-9_]', '_', 'g') AS nome FROM part",
    "partition_context": "SELECT o_orderkey, 'PARTITION_DATA_REFERENCIA' AS placeholder, strftime(o_orderdate, '%Y%m') AS valor "
    "FROM orders UNION ALL SELECT o_orderkey, 'PARTITION_DIA_BASE', strftime(o_orderdate, '%d') FROM orders",
    "bind_parameters": "SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN "
    "'data_base = ''{DATA_REF}'' AND dia = ''' || strftime(o_orderdate, '%d') || '''' ELSE "
    "'data_referencia = ''' || strftime(o_orderdate, '%Y%m') || ''' AND dia_base = ''' || strftime(o_orderdate, '%d') || '''' "
    "END AS predicate, CASE WHEN o_orderpriority = '5-LOW' THEN 'DATA_REF' ELSE '' END AS unresolved FROM orders",
    "sor_name": "SELECT c_custkey, lower(c_mktsegment) || '_contratos' AS sor_table_name FROM customer",
    "partition_path": "SELECT o_orderkey, '/lake/sor/contratos/mes=' || strftime(o_orderdate, '%Y%m') || '/dia=' || "
    "CASE strftime(o_orderdate, '%d') WHEN '01' THEN '__HIVE_DEFAULT_PARTITION__' ELSE strftime(o_orderdate, '%d') END || '/' "
    "AS path FROM orders",
    "flag_normalize": "SELECT event_id, event_type IN ('error', 'view') AS flag FROM events",
    "parse_override_list": "SELECT o_orderkey, 'contrato' AS source_name, "
    "CASE o_orderstatus WHEN 'F' THEN 'id < ' ELSE 'id > ' END || o_custkey AS predicate FROM orders "
    "UNION ALL SELECT o_orderkey, 'parcela', 'a::b = ' || o_orderpriority FROM orders",
    "required_fields": f"WITH {LEDGER}, marked AS (SELECT *, source_table_name = 'tab3' AS no_table, "
    "source_database_name = 'db2' AS no_db FROM ledger) SELECT ingestion_id, "
    "concat_ws(',', CASE WHEN no_table THEN 'source_table_name' END, CASE WHEN no_db THEN 'sor_database_name' END) AS missing_fields, "
    "concat_ws(',', CASE WHEN no_table OR no_db THEN 'MISSING_FIELDS' END, "
    "CASE WHEN status <> 'PROCESSING_SOR' THEN 'UNEXPECTED_STATUS' END, "
    "CASE WHEN sor_table_name = 'orig1' THEN 'EMPTY_PARTITIONS' END) AS problems FROM marked",
}
