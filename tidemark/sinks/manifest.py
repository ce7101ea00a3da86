"""What a write put where: partitions, files, rows and bytes, as a table.

The partitions come from the write job itself, the files from listing those partitions only,
so the cost follows the write, not the history of the table.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import NULL_PARTITION
from tidemark.sinks.partitions import WriteReport

# Characters that partition paths spell as % and two hex digits.
ESCAPED = re.compile("[\x01-\x1f\x7f\"#%'*/:=?\\\\{\\[\\]^]")

MANIFEST = T.StructType(
    [
        T.StructField("write_id", T.StringType()),
        T.StructField("table_path", T.StringType()),
        T.StructField("partition", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("written_at", T.TimestampType()),
    ]
)


def partition_folder(values: Mapping[str, str | None]) -> str:
    """``k1=v1/k2=v2`` as the writer spells it."""

    def spelled(text: str) -> str:
        return ESCAPED.sub(lambda c: f"%{ord(c[0]):02X}", text)

    return "/".join(f"{spelled(k)}={NULL_PARTITION if v in (None, '') else spelled(v)}" for k, v in values.items())


def written_files(spark: SparkSession, report: WriteReport) -> DataFrame:
    """``partition, file_name, rows, bytes`` of the partitions that this write replaced.

    No column of the data is read: row counts come from the files' footers.
    """
    folders = sorted(partition_folder(p) for p in report.partitions)
    if not folders:
        return spark.createDataFrame([], T.StructType(MANIFEST.fields[2:6]))
    meta = F.col("_metadata")
    spelled = F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))  # file paths come as URLs
    below = F.regexp_extract(spelled, "(?:^|/)((?:[^/=]+=[^/]*/)+)[^/]+$", 1)
    files = spark.read.schema(report.schema).parquet(*[f"{report.path}/{f}" for f in folders])
    listed = files.groupBy(meta["file_path"].alias("path"), meta["file_name"].alias("file_name"), meta["file_size"].alias("bytes"))
    counted = listed.agg(F.count(F.lit(1)).alias("rows"))  # nothing but a count per row: tasks need no sort
    depth = len(report.keys)
    inner = F.array_join(F.slice(F.split(F.rtrim(below, F.lit("/")), "/"), -depth, depth), "/")
    return counted.select(inner.alias("partition"), "file_name", "rows", "bytes")


def append_manifest(spark: SparkSession, report: WriteReport, manifest_path: str, write_id: str) -> None:
    """One row per file of the write. ``write_id`` names the run; a repeated run appends its
    rows again, and the newest ``written_at`` of a partition tells what is there."""
    now = F.lit(datetime.now(timezone.utc)).cast("timestamp")
    rows = written_files(spark, report).withColumns(
        {"write_id": F.lit(write_id), "table_path": F.lit(report.path), "written_at": now}
    )
    rows.select(*MANIFEST.names).coalesce(1).write.mode("append").parquet(manifest_path)


def read_manifest(spark: SparkSession, manifest_path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(manifest_path)


def present_files(manifest: DataFrame) -> DataFrame:
    """The files that are there: of each partition those of its last write."""
    moment = F.struct("written_at", "write_id")
    last = manifest.groupBy("table_path", "partition").agg(F.max(moment).alias("_last"))
    return manifest.join(last, ["table_path", "partition"]).where(moment == F.col("_last")).select(*manifest.columns)


def add_partitions(spark: SparkSession, name: str, partitions: Sequence[Mapping[str, str | None]], batch: int = 500) -> None:
    """Tells the catalog of these partitions, and looks at no others."""

    def literal(value: str | None) -> str:
        return "null" if value in (None, "") else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    specs = ["PARTITION (" + ", ".join(f"`{k}` = {literal(v)}" for k, v in p.items()) + ")" for p in partitions]
    for start in range(0, len(specs), batch):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(specs[start : start + batch]))
