"""Scans and sources."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import SourceSpec
from tidemark.operators.select import staged_sql
from tidemark.session import shared_folder
from tidemark.sinks import write_partitions
from tidemark.sources import (
    load_source,
    load_sources,
    read_csv,
    read_dated,
    read_grouping,
    read_landing,
    read_parquet,
    read_table,
)
from tidemark.specs import GROUP_SIZE_BYTES, DestSpec
from workload.inputs import CONTRACT, cents, contract, staged, table

CSV_COLUMNS = ["num_contrato", "num_parcela", "vlr_cred_mes", "situacao", "data_base", "dia_base"]


def _catalog_table(spark, database: str, name: str, path: str) -> None:
    home = f"{shared_folder(spark)}/{database}.db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{home}'")
    spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
    spark.sql(f"CREATE TABLE `{database}`.`{name}` USING parquet LOCATION '{path}'")


def _read_table(spark, sf):
    _catalog_table(spark, "db_origem", "contrato", f"{sf}/lineitem.parquet")
    return read_table(
        spark, "db_origem", "contrato", "l_linestatus = '{SITUACAO}'", {"SITUACAO": "F"}
    ).select("l_orderkey", "l_linenumber", "l_extendedprice", "l_linestatus")


def _database_switch(spark, sf):
    _catalog_table(spark, "dblocal", "pedidos", f"{sf}/orders.parquet")
    df = read_table(spark, "db_origem", "pedidos", environment="dev", local="TRUE")
    return df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


def _csv_path(spark, sf):
    def write(path):
        contract(spark, sf).select(*CSV_COLUMNS).write.option("header", "true").csv(path)

    return staged(spark, sf, "contract-csv", write)


def _csv_schema(spark, sf):
    return contract(spark, sf).select(*CSV_COLUMNS).schema


def _read_csv(spark, sf):
    return read_csv(spark, _csv_path(spark, sf), schema=_csv_schema(spark, sf))


def _csv_predicate(spark, sf):
    return read_csv(
        spark,
        _csv_path(spark, sf),
        schema=_csv_schema(spark, sf),
        predicate="dia_base = '{DIA}' AND vlr_cred_mes > {MINIMO}",
        params={"DIA": "05", "MINIMO": "100"},
    )


def _scan_grouping(spark, sf):
    read_grouping(spark, {"group_files": "inPartition", "group_size_bytes": GROUP_SIZE_BYTES})
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(cents("l_extendedprice")).alias("cents"))
    )


def _schema_policy(spark, sf):
    path = f"{sf}/lineitem.parquet"
    catalog_schema = T.StructType.fromDDL(
        "l_orderkey bigint, l_extendedprice double, canal string"
    )
    catalog = read_parquet(spark, path, schema=catalog_schema)
    files = read_parquet(spark, path, merge_schema=True)
    return catalog.select(
        F.lit("catalog").alias("policy"), "l_orderkey", "l_extendedprice", "canal"
    ).unionByName(
        files.select(
            F.lit("files").alias("policy"),
            "l_orderkey",
            "l_extendedprice",
            F.col("l_linestatus").alias("canal"),
        )
    )


def _load_sources(spark, sf):
    frames = load_sources(
        spark,
        [
            SourceSpec("contrato", "parquet", path=f"{sf}/lineitem.parquet"),
            SourceSpec("pedido", "parquet", path=f"{sf}/orders.parquet", predicate="o_orderstatus <> '{FORA}'"),
        ],
        {"FORA": "P"},
    )
    return staged_sql(
        spark,
        frames,
        [
            "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM contrato "
            "JOIN pedido ON l_orderkey = o_orderkey GROUP BY o_orderstatus, o_orderpriority"
        ],
    )


def _view_naming(spark, sf):
    path = f"{sf}/lineitem.parquet"
    frames = load_sources(
        spark,
        [
            SourceSpec("abertos", "parquet", table="contrato", path=path, predicate="l_linestatus = 'O'"),
            SourceSpec("fechados", "parquet", table="contrato", path=path, predicate="l_linestatus = 'F'"),
        ],
    )
    return staged_sql(
        spark,
        frames,
        [
            "SELECT 'abertos' AS view_name, l_returnflag, count(*) AS n FROM abertos GROUP BY l_returnflag "
            "UNION ALL "
            "SELECT 'fechados' AS view_name, l_returnflag, count(*) AS n FROM fechados GROUP BY l_returnflag"
        ],
    )


def _dated_path(spark, sf):
    orders = table(spark, sf, "orders").withColumn("ref", F.date_format("o_orderdate", "yyyyMM"))

    def write(path):
        base, name = path.rsplit("/", 1)
        write_partitions(orders, DestSpec(base, name, partition_keys=["ref"]))

    base = staged(spark, sf, "orders-by-month", write)
    return (
        read_dated(spark, base + "/ref={ANO_MES_DATA_REF}", orders.drop("ref").schema)
        .groupBy("ano_mes_data_ref", "o_orderstatus")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(cents("o_totalprice")).alias("cents"))
    )


def _read_landing(spark, sf):
    schema = table(spark, sf, "orders").schema
    arrived = [f"{sf}/orders.parquet"]
    return read_landing(spark, arrived, schema).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"
    )


def _partition_predicate(spark, sf):
    source = contract(spark, sf)

    def write(path):
        base, name = path.rsplit("/", 1)
        write_partitions(source, DestSpec(base, name, partition_keys=["data_base"]))

    path = staged(spark, sf, "contract-by-month", write)
    return read_parquet(
        spark,
        path,
        schema=source.schema,
        predicate="data_base = '{PARTITION_DATA_BASE}' AND vlr_cred_mes > 100",
        params={"PARTITION_DATA_BASE": "199605"},
    ).select("num_contrato", "num_parcela", "vlr_cred_mes", "data_base")


def _schema_resolution(spark, sf):
    """A catalog table of the first generation; files of the second are wider and have one
    column more, those of the third lack one."""
    database, name = "tidemark_gen", "contratos"
    rows = contract(spark, sf).withColumn("ano", F.substring("data_base", 1, 4))
    first = rows.select(F.col("num_contrato").cast("int"), "num_parcela", F.col("quantidade").cast("float"), "situacao", "ano")
    second = rows.select("num_contrato", "num_parcela", "quantidade", "situacao", "data_base", "ano")
    third = rows.select("num_contrato", F.col("num_parcela").cast("bigint"), "data_base", "ano")

    def write(path):
        for generation, years in ((first, "ano < '1994'"), (second, "ano BETWEEN '1994' AND '1996'"), (third, "ano > '1996'")):
            write_partitions(generation.where(years), DestSpec(path, name, partition_keys=["ano"]))

    path = staged(spark, sf, "generations", write) + f"/{name}"
    home = f"{shared_folder(spark)}/{database}.db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{home}'")
    spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in first.schema)
    spark.sql(f"CREATE TABLE `{database}`.`{name}` ({columns}) USING parquet PARTITIONED BY (ano) LOCATION '{path}'")
    spark.catalog.recoverPartitions(f"`{database}`.`{name}`")
    source = SourceSpec("contratos", database=database, table=name, use_catalog_schema=False, predicate="ano >= '{DESDE}'")
    return load_source(spark, source, {"DESDE": "1993"}).select("num_contrato", "num_parcela", "quantidade", "situacao", "data_base", "ano")


QUERIES = {
    "schema_resolution": _schema_resolution,
    "read_table": _read_table,
    "read_csv": _read_csv,
    "scan_grouping": _scan_grouping,
    "schema_policy": _schema_policy,
    "load_sources": _load_sources,
    "view_naming": _view_naming,
    "database_switch": _database_switch,
    "dated_path": _dated_path,
    "read_landing": _read_landing,
    "partition_predicate": _partition_predicate,
    "csv_predicate": _csv_predicate,
}

_CSV_LIST = ", ".join(CSV_COLUMNS)

ORACLE = {
    "schema_resolution": f"""WITH {CONTRACT}, c AS (SELECT *, substr(data_base, 1, 4) AS ano FROM contrato)
        SELECT num_contrato, num_parcela::BIGINT AS num_parcela, CASE WHEN ano <= '1996' THEN quantidade END AS quantidade,
        CASE WHEN ano <= '1996' THEN situacao END AS situacao, CASE WHEN ano >= '1994' THEN data_base END AS data_base, ano
        FROM c WHERE ano >= '1993'""",
    "read_table": "SELECT l_orderkey, l_linenumber, l_extendedprice, l_linestatus FROM lineitem WHERE l_linestatus = 'F'",
    "read_csv": f"WITH {CONTRACT} SELECT {_CSV_LIST} FROM contrato",
    "scan_grouping": "SELECT l_returnflag, l_linestatus, count(*) AS n, "
    "CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM lineitem GROUP BY ALL",
    "schema_policy": "SELECT 'catalog' AS policy, l_orderkey, l_extendedprice, CAST(NULL AS VARCHAR) AS canal "
    "FROM lineitem UNION ALL SELECT 'files', l_orderkey, l_extendedprice, l_linestatus FROM lineitem",
    "load_sources": "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM lineitem "
    "JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P' GROUP BY ALL",
    "view_naming": "SELECT CASE l_linestatus WHEN 'O' THEN 'abertos' ELSE 'fechados' END AS view_name, "
    "l_returnflag, count(*) AS n FROM lineitem WHERE l_linestatus IN ('O', 'F') GROUP BY ALL",
    "database_switch": "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY ALL",
    "dated_path": "SELECT strftime(o_orderdate, '%Y%m') AS ano_mes_data_ref, o_orderstatus, count(*) AS n, "
    "CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders GROUP BY ALL",
    "read_landing": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
    "partition_predicate": f"WITH {CONTRACT} SELECT num_contrato, num_parcela, vlr_cred_mes, data_base "
    "FROM contrato WHERE data_base = '199605' AND vlr_cred_mes > 100",
    "csv_predicate": f"WITH {CONTRACT} SELECT {_CSV_LIST} FROM contrato WHERE dia_base = '05' AND vlr_cred_mes > 100",
}
