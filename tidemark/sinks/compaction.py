"""Many small files of a partition -> few of the grouping size, its rows unchanged."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sinks.manifest import partition_folder
from tidemark.sinks.partitions import WriteReport, check_partition_keys, write_files
from tidemark.specs import GROUP_SIZE_BYTES, DestSpec

FILE = "_compacted_from"


def _read(spark: SparkSession, dest: DestSpec, schema: T.StructType, partitions: Sequence[Mapping[str, str | None]] | None) -> DataFrame:
    reader = spark.read.schema(schema).option("basePath", dest.path)
    return reader.parquet(*([dest.path] if partitions is None else [f"{dest.path}/{partition_folder(p)}" for p in partitions]))


def compaction_plan(rows: DataFrame, keys: Sequence[str], target: int = GROUP_SIZE_BYTES) -> DataFrame:
    """File by file: the keys, ``path, bytes, rows`` and the ``file_group`` it goes to.

    ``rows`` is a scan of the table. Files of a partition follow one another by name into
    groups of ``target`` bytes, each for one task. Partitions are left out where that would not at least halve
    the number of files. Only footers are read.
    """
    meta = F.col("_metadata")
    files = rows.groupBy(*keys, meta["file_path"].alias("path"), meta["file_size"].alias("bytes")).agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy(*keys).orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    grouped = files.withColumn("file_group", F.floor(F.coalesce(F.sum("bytes").over(before), F.lit(0)) / target))
    whole = Window.partitionBy(*keys)
    counted = grouped.withColumns({"_files": F.count(F.lit(1)).over(whole), "_groups": F.max("file_group").over(whole) + 1})
    return counted.where(F.col("_files") >= 2 * F.col("_groups")).drop("_files", "_groups")


def compact_partitions(
    spark: SparkSession,
    dest: DestSpec,
    schema: T.StructType,
    partitions: Sequence[Mapping[str, str | None]] | None = None,
    target: int = GROUP_SIZE_BYTES,
) -> WriteReport:
    """Rewrites those partitions whose files are too many, all others stay as they are.

    ``partitions``, such as those of a write's report, confines the search to them. Nobody
    else may write these partitions meanwhile. The new files take the place of the old ones
    when the job commits; if it wrote another number of rows than the files held, that is an
    error.
    """
    keys = check_partition_keys(schema.names, dest.partition_keys)
    if partitions is not None and not partitions:
        return WriteReport(dest.path, 0, keys, [], schema)
    plan = compaction_plan(_read(spark, dest, schema, partitions), keys, target).persist()
    try:
        # As many as there are partitions to rewrite; their files stay in the plan.
        chosen = [r.asDict() for r in plan.select(*keys).distinct().collect()]
        if not chosen:
            return WriteReport(dest.path, 0, keys, [], schema)
        place = F.dense_rank().over(Window.orderBy(*keys, "file_group")) - 1  # over files, not rows
        groups = plan.select(F.col("path").alias(FILE), "rows", place.alias("_place")).persist()
        held, tasks = groups.agg(F.sum("rows"), F.max("_place") + 1).first()
        rows = _read(spark, dest, schema, chosen).withColumn(FILE, F.col("_metadata.file_path"))
        dealt = rows.join(groups.select(FILE, "_place"), FILE).repartitionById(tasks, "_place")
        report = write_files(dealt.select(*schema.names), dest, keys)
        groups.unpersist()
    finally:
        plan.unpersist()
    if report.rows != held:
        raise RuntimeError(f"{dest.path}: {report.rows} rows written from files that held {held}")
    return report
