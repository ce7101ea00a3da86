"""Writers: each result is written, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import DestSpec
from tidemark.functions.names import zero_padded
from tidemark.session import shared_folder
from tidemark.sinks import (
    append_manifest,
    check_partition_keys,
    compact_partitions,
    export_csv,
    present_files,
    read_manifest,
    write_catalog_table,
    write_partitions,
    write_result,
)
from tidemark.sinks.partitions import write_files
from workload.inputs import CONTRACT, cents, contract, staged, table

COLUMNS = ["num_contrato", "num_parcela", "vlr_cred_mes", "data_base", "situacao"]


def _slim(spark, sf):
    return contract(spark, sf).select(*COLUMNS)


def _in(path, **settings):
    base, name = path.rsplit("/", 1)
    return DestSpec(base, name, **settings)


def _write_partitions(spark, sf):
    """All years, then the years of situation R again with doubled values: only the
    (year, R) partitions change."""
    df = _slim(spark, sf).withColumn("ano", F.substring("data_base", 1, 4))

    def write(path):
        dest = _in(path, partition_keys=["ano", "situacao"])
        write_partitions(df, dest)
        again = df.where("situacao = 'R'").withColumn("vlr_cred_mes", F.col("vlr_cred_mes") * 2)
        write_partitions(again, dest)
        write_partitions(df.where("situacao = 'none'"), dest)

    return spark.read.schema(df.schema).parquet(staged(spark, sf, "written", write)).select(*COLUMNS)


def _write_manifest(spark, sf):
    """Two writes of the same table, and what their manifest says of each partition now."""
    df = _slim(spark, sf).withColumn("ano", F.substring("data_base", 1, 4))

    def write(path):
        dest = _in(f"{path}/t", partition_keys=["ano", "situacao"])
        append_manifest(spark, write_partitions(df, dest), f"{path}/manifest", "first")
        append_manifest(spark, write_partitions(df.where("situacao = 'R' AND num_parcela < 4"), dest), f"{path}/manifest", "second")

    manifest = read_manifest(spark, staged(spark, sf, "manifest", write) + "/manifest")
    writes = manifest.groupBy("partition").agg(F.countDistinct("write_id").alias("writes"))
    there = present_files(manifest).groupBy("partition").agg(F.sum("rows").alias("rows"), F.max("write_id").alias("last_write"))
    return there.join(writes, "partition").select("partition", "rows", "last_write", "writes")


def _compaction(spark, sf):
    """Forty files in each of some partitions become one each; every row is still there."""
    df = _slim(spark, sf).withColumn("ano", F.substring("data_base", 1, 4))

    def write(path):
        dest = _in(path, partition_keys=["ano", "situacao"])
        scattered = df.repartition(40)
        write_files(scattered.where("ano < '1996'"), dest, dest.partition_keys)
        write_partitions(df.where("ano >= '1996'"), dest)
        compact_partitions(spark, dest, df.schema)

    there = spark.read.schema(df.schema).parquet(staged(spark, sf, "compacted", write))
    return there.groupBy("ano", "situacao").agg(
        F.count(F.lit(1)).alias("n"), F.sum(cents("vlr_cred_mes")).alias("cents"), (F.count_distinct(F.col("_metadata.file_name")) < 20).alias("few_files")
    )


def _export_single(spark, sf):
    """Many tasks write the parts, one file is what is left."""
    df = _slim(spark, sf)
    path = staged(
        spark, sf, "single", lambda p: export_csv(df.repartition(16), _in(p, kind="csv", file_name="contratos.csv", single=True))
    )
    return _csv_back(spark, f"{path}/contratos.csv", df, True)


def _check_partition_keys(spark, sf):
    """Partition values survive as text: leading zeros, nulls, characters that need escaping."""
    df = table(spark, sf, "orders").select(
        "o_orderkey",
        zero_padded(F.col("o_custkey") % 8, 6).alias("versao"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.lit("a:b/"), "o_orderpriority")).alias("origem"),
    )

    def write(path):
        keys = check_partition_keys(df.columns, [" versao ", "", "origem"])
        write_partitions(df, _in(path, partition_keys=keys))

    return spark.read.schema(df.schema).parquet(staged(spark, sf, "keys", write)).select(*df.columns)


def _catalog_recreate(spark, sf):
    """Partitions written by path; the catalog, which forgot the table, gets one of them anew."""
    database, name = "tidemark_back", "contratos"
    df = _slim(spark, sf).drop("data_base")
    home = f"{shared_folder(spark)}/{database}.db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{home}'")
    spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")

    def write(path):
        dest = DestSpec(path, name, database=database, partition_keys=["situacao"])
        write_partitions(df, dest)
        doubled = df.where("situacao = 'R'").withColumn("vlr_cred_mes", F.col("vlr_cred_mes") * 2)
        write_result(doubled, dest)

    path = staged(spark, sf, "catalog-back", write) + f"/{name}"
    if not spark.catalog.tableExists(f"`{database}`.`{name}`"):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        spark.sql(f"CREATE TABLE `{database}`.`{name}` ({columns}) USING parquet PARTITIONED BY (situacao) LOCATION '{path}'")
        spark.catalog.recoverPartitions(f"`{database}`.`{name}`")
    return spark.table(f"`{database}`.`{name}`").select("num_contrato", "num_parcela", "vlr_cred_mes", "situacao")


def _catalog_update(spark, sf):
    """First write creates the table, the second adds a column and replaces its partitions."""
    database, name = "tidemark_sor", "contratos"
    df = _slim(spark, sf).drop("data_base")
    home = f"{shared_folder(spark)}/{database}.db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{home}'")
    spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")

    def write(path):
        dest = DestSpec(path, name, database=database, partition_keys=["situacao"])
        write_catalog_table(df, dest)
        write_catalog_table(df.where("situacao = 'R'").withColumn("canal", F.lit("novo")), dest)
        spark.sql(f"DROP TABLE `{database}`.`{name}`")

    path = staged(spark, sf, "catalog", write) + f"/{name}"
    columns = "num_contrato bigint, num_parcela int, vlr_cred_mes double, canal string, situacao string"
    spark.sql(
        f"CREATE TABLE `{database}`.`{name}` ({columns}) USING parquet PARTITIONED BY (situacao) LOCATION '{path}'"
    )
    spark.sql(f"MSCK REPAIR TABLE `{database}`.`{name}`")
    return spark.table(f"`{database}`.`{name}`").select("num_contrato", "num_parcela", "vlr_cred_mes", "canal", "situacao")


def _file_options(spark, sf):
    df = _slim(spark, sf)

    def write(path):
        dest = _in(path, partition_keys=["situacao"], compression="zstd", max_records_per_file=100000)
        write_partitions(df, dest)

    return spark.read.schema(df.schema).parquet(staged(spark, sf, "options", write)).groupBy("situacao").agg(
        F.count(F.lit(1)).alias("n")
    )


def _csv_back(spark, path, df, header):
    return spark.read.option("header", str(header).lower()).schema(df.schema).csv(path)


def _export_csv(header):
    def query(spark, sf):
        df = _slim(spark, sf)
        path = staged(spark, sf, f"export-{header}", lambda p: export_csv(df, _in(p, kind="csv", header=header)))
        return _csv_back(spark, path, df, header)

    return query


def _write_dispatch(spark, sf):
    """The same rows through both destination kinds."""
    df = _slim(spark, sf).groupBy("data_base", "situacao").agg(F.count(F.lit(1)).alias("n"))

    def write(path):
        write_result(df, DestSpec(path, "parquet", kind=" Catalogo", partition_keys=["situacao"]))
        write_result(df, DestSpec(path, "text", kind="CSV", file_name="resumo.csv", single=True))

    path = staged(spark, sf, "dispatch", write)
    parquet = spark.read.schema(df.schema).parquet(f"{path}/parquet")
    text = _csv_back(spark, f"{path}/text/resumo.csv", df, True)
    return parquet.select(*df.columns, F.lit("catalogo").alias("kind")).unionByName(
        text.withColumn("kind", F.lit("csv"))
    )


QUERIES = {
    "write_partitions": _write_partitions,
    "check_partition_keys": _check_partition_keys,
    "catalog_update": _catalog_update,
    "catalog_recreate": _catalog_recreate,
    "file_options": _file_options,
    "export_csv": _export_csv(True),
    "csv_header": _export_csv(False),
    "compaction": _compaction,
    "export_single": _export_single,
    "write_manifest": _write_manifest,
    "write_dispatch": _write_dispatch,
}

_LIST = ", ".join(COLUMNS)
_SLIM = f"WITH {CONTRACT} SELECT {_LIST} FROM contrato"
ORACLE = {
    "write_partitions": f"WITH {CONTRACT} SELECT num_contrato, num_parcela, "
    "CASE situacao WHEN 'R' THEN vlr_cred_mes * 2 ELSE vlr_cred_mes END AS vlr_cred_mes, data_base, situacao FROM contrato",
    "check_partition_keys": "SELECT o_orderkey, printf('%06d', o_custkey % 8) AS versao, "
    "CASE WHEN o_orderpriority <> '5-LOW' THEN 'a:b/' || o_orderpriority END AS origem FROM orders",
    "catalog_recreate": f"WITH {CONTRACT} SELECT num_contrato, num_parcela, "
    "CASE situacao WHEN 'R' THEN vlr_cred_mes * 2 ELSE vlr_cred_mes END AS vlr_cred_mes, situacao FROM contrato",
    "catalog_update": f"WITH {CONTRACT} SELECT num_contrato, num_parcela, vlr_cred_mes, "
    "CASE situacao WHEN 'R' THEN 'novo' END AS canal, situacao FROM contrato",
    "file_options": f"WITH {CONTRACT} SELECT situacao, count(*) AS n FROM contrato GROUP BY situacao",
    "export_csv": _SLIM,
    "csv_header": _SLIM,
    "export_single": _SLIM,
    "compaction": f"WITH {CONTRACT} SELECT substr(data_base, 1, 4) AS ano, situacao, count(*) AS n, "
    "sum(CAST(round(vlr_cred_mes * 100) AS BIGINT))::BIGINT AS cents, true AS few_files FROM contrato GROUP BY ALL",
    "write_manifest": f"""WITH {CONTRACT}, g AS (SELECT 'ano=' || substr(data_base, 1, 4) || '/situacao=' || situacao AS partition,
        situacao, count(*) AS n, count(*) FILTER (situacao = 'R' AND num_parcela < 4) AS again FROM contrato GROUP BY ALL)
        SELECT partition, CASE WHEN again > 0 THEN again ELSE n END AS rows, CASE WHEN again > 0 THEN 'second' ELSE 'first' END AS last_write,
        CASE WHEN again > 0 THEN 2 ELSE 1 END AS writes FROM g""",
    "write_dispatch": f"WITH {CONTRACT}, g AS (SELECT data_base, situacao, count(*) AS n FROM contrato GROUP BY ALL) "
    "SELECT *, 'catalogo' AS kind FROM g UNION ALL SELECT *, 'csv' FROM g",
}
