"""Configuration lookups, predicate precedence, consolidation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import SourceSpec
from tidemark.functions.predicates import (
    override_rows,
    override_scalars,
    parse_override_list,
    predicate_precedence,
)
from tidemark.operators.consolidate import consolidate, two_block_sources
from tidemark.operators.matching import exactly_one_match, register_lookup
from tidemark.sinks.settings import effective_settings
from tidemark.sources import load_sources, read_csv
from workload.inputs import (
    ARRIVALS,
    CONTRACT,
    TABLE_CONFIG,
    arrivals,
    contract,
    staged,
    table,
    table_config,
)


def _source(number):
    return F.concat(F.lit("src"), number.cast("string"))


def _predicate_precedence(spark, sf):
    sources = table(spark, sf, "customer").select(
        _source(F.col("c_custkey")).alias("source_name"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.concat(F.lit("segmento = "), "c_mktsegment")).alias("predicate"),
    )
    # The argument is one text per run; here one entry per customer, latest order wins.
    texts = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(
        "o_orderkey",
        F.explode(
            parse_override_list(
                F.concat(_source(F.col("o_custkey")), F.lit("::pedido = "), F.col("o_orderkey").cast("string"))
            )
        ).alias("source_name", "predicate"),
    )
    argument = texts.groupBy("source_name").agg(F.max_by("predicate", "o_orderkey").alias("predicate"))
    control = (
        table(spark, sf, "events")
        .groupBy(_source(F.col("user_id")).alias("source_name"))
        .agg(F.max("event_id").alias("_id"), F.max_by("event_type", "event_id").alias("_type"))
        .select(
            "source_name",
            F.when(F.col("_type") == "error", F.lit("  "))
            .otherwise(F.concat(F.lit("evento = "), F.col("_id").cast("string")))
            .alias("predicate"),
        )
    )
    return predicate_precedence(sources, argument, control)


def _predicate_override_lookup(spark, sf):
    e = table(spark, sf, "events")
    enabled = F.when(F.col("event_type") != "view", F.col("event_type") != "error")
    by_run = e.select(
        F.col("event_id").cast("string").alias("scope"),
        enabled.alias("enabled"),
        F.create_map(
            F.lit("contrato"),
            F.concat(F.lit("tipo = "), "event_type"),
            F.lit("cliente"),
            F.when(F.col("event_type") == "click", F.concat(F.lit("usuario = "), F.col("user_id").cast("string"))).otherwise(""),
            F.lit(""),
            F.lit("x = 1"),
        ).alias("predicates"),
    )
    by_table = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("scope"),
        F.lit("pedido").alias("source_name"),
        (F.col("o_orderstatus") != "P").alias("enabled"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.lit("prioridade = "), "o_orderpriority")).alias("predicate"),
    )
    return override_rows(by_run, ["scope"]).unionByName(override_scalars(by_table, ["scope"]))


def _map_source_to_sor(spark, sf):
    events = arrivals(spark, sf).select(
        "event_id", "process_name", "source_database_name", "source_table_name"
    )
    accepted, rejected = register_lookup(events, table_config(spark))
    return accepted.select("event_id", F.lit("ACCEPTED").alias("outcome"), "sor_table_name").unionByName(
        rejected.select("event_id", F.lit("REJECTED").alias("outcome"), F.lit(None).cast("string").alias("sor_table_name"))
    )


def _exactly_one_match(spark, sf):
    """Executions per customer segment: 0, 1 or several candidates, and wildcards."""
    requests = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")
    )
    config = table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("nation"),
        F.when(F.col("s_acctbal") > 5000, F.lit("BUILDING")).when(F.col("s_acctbal") > 2500, F.lit("HOUSEHOLD")).alias("segment"),
        F.col("s_name").alias("sql_path"),
    )
    return exactly_one_match(requests, config, ["nation"], ["sql_path"], wildcard="segment")


def _modules(spark, sf):
    base = contract(spark, sf)
    process = F.when(F.col("situacao") == "R", F.lit("proc_b")).otherwise(F.lit("proc_a"))
    return {
        "regra_valor": base.where("vlr_cred_mes > 20000").select(
            process.alias("process_id"), "num_contrato", "num_parcela", "vlr_cred_mes"
        ),
        "regra_quantidade": base.where("quantidade < 10").select(
            process.alias("process_id"), "num_contrato", "num_parcela", "quantidade"
        ),
    }


def _two_block_sources(spark, sf):
    columns = ["num_contrato", "vlr_cred_mes", "data_base"]
    source = contract(spark, sf).select(*columns)
    path = staged(
        spark, sf, "block-csv", lambda p: source.where("vlr_cred_mes <= 30000").write.option("header", "true").csv(p)
    )
    return two_block_sources(source.where("vlr_cred_mes > 30000"), read_csv(spark, path, schema=source.schema))


def _destination_settings(spark, sf):
    """Settings of one destination per supplier and kind: own, else environment, else technical."""
    supplier = table(spark, sf, "supplier")
    destinations = supplier.select(
        F.col("s_suppkey").alias("destination"),
        (F.col("s_nationkey") % 3).cast("string").alias("environment"),
        F.when(F.col("s_acctbal") < 0, "csv").otherwise("catalogo").alias("kind"),
        F.when(F.col("s_acctbal") > 8000, "gzip").alias("compression"),
        F.when(F.col("s_acctbal") > 9000, F.col("s_name")).alias("s3_destino"),
    )
    nation = table(spark, sf, "nation")
    environments = nation.groupBy((F.col("n_nationkey") % 3).cast("string").alias("environment")).agg(
        F.min(F.when(F.col("n_regionkey") == 9, F.lit("zstd"))).alias("compression"),
        F.min("n_name").alias("s3_destino"),
    )
    technical = spark.sql(
        "SELECT * FROM VALUES ('catalogo', 'snappy', 'none'), ('csv', NULL, 'none') AS t(kind, compression, s3_destino)"
    )
    return effective_settings(destinations, environments, technical, ["compression", "s3_destino"])


def _overrides_into_run(spark, sf):
    """A control table of overrides as it is given to a run: its predicate beats the source's
    own, disabled and blank ones count for nothing, and the argument beats it."""
    overrides = table(spark, sf, "nation").select(
        F.concat(F.lit("contrato"), (F.col("n_nationkey") % 4).cast("string")).alias("source_name"),
        F.when(F.col("n_nationkey") % 4 == 2, "  ").otherwise(F.concat(F.lit("l_linenumber > "), (F.col("n_nationkey") % 4 + 1).cast("string"))).alias("predicate"),
        (F.col("n_nationkey") % 4 != 3).alias("enabled"),
    )
    sources = [
        SourceSpec(f"v{n}", "parquet", table=f"contrato{n}", path=f"{sf}/lineitem.parquet", predicate="l_linenumber = 1") for n in range(5)
    ]
    frames = load_sources(
        spark, sources, argument_overrides={"contrato1": "l_linenumber > 5"}, table_overrides=override_scalars(overrides, [])
    )
    parts = [df.select(F.lit(view).alias("source"), "l_linenumber", "l_quantity") for view, df in frames.items()]
    return reduce(DataFrame.unionAll, parts).groupBy("source", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "overrides_into_run": _overrides_into_run,
    "predicate_precedence": _predicate_precedence,
    "predicate_override_lookup": _predicate_override_lookup,
    "map_source_to_sor": _map_source_to_sor,
    "exactly_one_match": _exactly_one_match,
    "consolidate_modules": lambda spark, sf: consolidate(_modules(spark, sf), "proc_a"),
    "two_block_sources": _two_block_sources,
    "destination_settings": _destination_settings,
}

ORACLE = {
    "overrides_into_run": "SELECT source, l_linenumber, count(*) AS n FROM lineitem, (VALUES ('v0', 1, 99), ('v1', 5, 99), ('v2', 0, 1), "
    "('v3', 0, 1), ('v4', 0, 1)) AS s(source, above, upto) WHERE l_linenumber > above AND l_linenumber <= upto GROUP BY ALL",
    "predicate_precedence": """WITH src AS (SELECT 'src' || c_custkey AS source_name,
        CASE WHEN c_mktsegment <> 'BUILDING' THEN 'segmento = ' || c_mktsegment END AS predicate FROM customer),
        arg AS (SELECT 'src' || o_custkey AS source_name, 'pedido = ' || max(o_orderkey) AS p FROM orders
          WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey),
        ctl AS (SELECT 'src' || user_id AS source_name, CASE WHEN arg_max(event_type, event_id) <> 'error'
          THEN 'evento = ' || max(event_id) END AS p FROM events GROUP BY user_id)
        SELECT source_name, predicate, coalesce(arg.p, ctl.p, predicate) AS predicate_final,
          CASE WHEN arg.p IS NOT NULL THEN 'ARGUMENT' WHEN ctl.p IS NOT NULL THEN 'CONTROL_TABLE'
          WHEN predicate IS NOT NULL THEN 'CONFIG' ELSE 'NONE' END AS predicate_source
        FROM src LEFT JOIN arg USING (source_name) LEFT JOIN ctl USING (source_name)""",
    "predicate_override_lookup": """SELECT CAST(event_id AS VARCHAR) AS scope, 'contrato' AS source_name,
          'tipo = ' || event_type AS predicate FROM events WHERE event_type NOT IN ('error', 'view')
        UNION ALL SELECT CAST(event_id AS VARCHAR), 'cliente', 'usuario = ' || user_id FROM events WHERE event_type = 'click'
        UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'pedido', 'prioridade = ' || o_orderpriority FROM orders
          WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'""",
    "map_source_to_sor": f"""WITH {ARRIVALS}, {TABLE_CONFIG} SELECT event_id,
        CASE WHEN c.mapped_table IS NULL THEN 'REJECTED' ELSE 'ACCEPTED' END AS outcome, c.mapped_table AS sor_table_name
        FROM arrivals a LEFT JOIN table_config c ON c.enabled AND a.process_name = c.process_name
        AND a.source_database_name = c.source_database_name AND a.source_table_name = c.source_table_name""",
    "exactly_one_match": """WITH config AS (SELECT s_nationkey AS nation, CASE WHEN s_acctbal > 5000 THEN 'BUILDING'
          WHEN s_acctbal > 2500 THEN 'HOUSEHOLD' END AS segment, s_name FROM supplier),
        m AS (SELECT c_custkey, c_nationkey AS nation, c_mktsegment AS segment, count(s_name) AS matches, min(s_name) AS s_name
          FROM customer LEFT JOIN config ON nation = c_nationkey AND (segment IS NULL OR segment = c_mktsegment) GROUP BY ALL)
        SELECT c_custkey, nation, segment, matches, CASE WHEN matches = 0 THEN 'NOT_FOUND' WHEN matches > 1 THEN 'AMBIGUOUS'
          ELSE 'OK' END AS match_status, CASE WHEN matches = 1 THEN s_name END AS sql_path FROM m""",
    "consolidate_modules": f"""WITH {CONTRACT} SELECT 'proc_a' AS process_id, num_contrato, num_parcela, vlr_cred_mes,
          CAST(NULL AS DOUBLE) AS quantidade, 'regra_valor' AS regra FROM contrato WHERE vlr_cred_mes > 20000 AND situacao <> 'R'
        UNION ALL SELECT 'proc_a', num_contrato, num_parcela, NULL, quantidade, 'regra_quantidade' FROM contrato
          WHERE quantidade < 10 AND situacao <> 'R'""",
    "two_block_sources": f"""WITH {CONTRACT} SELECT num_contrato, vlr_cred_mes, data_base,
        CASE WHEN vlr_cred_mes > 30000 THEN 'catalogo' ELSE 'csv' END AS bloco_origem FROM contrato""",
    "destination_settings": """WITH env AS (SELECT n_nationkey % 3 AS e, min(n_name) AS n FROM nation GROUP BY 1)
        SELECT s_suppkey AS destination, CAST(s_nationkey % 3 AS VARCHAR) AS environment,
          CASE WHEN s_acctbal < 0 THEN 'csv' ELSE 'catalogo' END AS kind,
          CASE WHEN s_acctbal > 8000 THEN 'gzip' WHEN s_acctbal >= 0 THEN 'snappy' END AS compression,
          CASE WHEN s_acctbal > 9000 THEN s_name ELSE env.n END AS s3_destino
        FROM supplier JOIN env ON e = s_nationkey % 3""",
}
