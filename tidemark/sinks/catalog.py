"""Output that also creates or extends a catalog table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.sinks.manifest import add_partitions
from tidemark.sinks.partitions import WriteReport, check_partition_keys, write_partitions
from tidemark.sources.tables import qualified, table_location
from tidemark.specs import DestSpec


def _columns(fields: Sequence[T.StructField]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def write_catalog_table(
    df: DataFrame, dest: DestSpec, constant_keys: Sequence[str] = ()
) -> WriteReport:
    """Replace the written partitions and let the catalog know of them.

    A table that is made here takes in what a forgotten or dropped one left under the path;
    later writes add their own partitions and look at no others. New columns are added to
    the table. Refused are a changed type or partitioning, and a table that lies elsewhere:
    its readers would not see what is written. Columns the output no longer has become null.
    """
    spark = df.sparkSession
    keys = check_partition_keys(df.columns, dest.partition_keys)
    name = f"`{dest.database}`.`{dest.table}`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{dest.database}`")
    data = [f for f in df.schema if f.name not in keys]
    known = spark.catalog.tableExists(name)
    if known:
        lies, goes = table_location(spark, name), qualified(spark, dest.path)
        if lies != goes:
            raise ValueError(f"table {name} lies at {lies}, not at {goes}")
        table = spark.table(name)
        types = {f.name: f.dataType for f in table.schema}
        now_keys = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
        changed = [f.name for f in df.schema if f.name in types and types[f.name] != f.dataType]
        if changed or now_keys != keys:
            raise ValueError("table cannot change type or partitioning: " + ", ".join(changed or keys))
        added = [f for f in data if f.name not in types]
        if added:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_columns(added)})")
    else:
        fields = [*data, *[df.schema[k] for k in keys]]
        by = ", ".join(f"`{k}`" for k in keys)
        spark.sql(f"CREATE TABLE {name} ({_columns(fields)}) USING parquet PARTITIONED BY ({by}) LOCATION '{dest.path}'")
    report = write_partitions(df, dest, constant_keys)
    if known:
        add_partitions(spark, name, report.partitions)
    else:
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    return report
