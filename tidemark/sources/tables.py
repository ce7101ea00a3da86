"""Catalog scans and the settings that shape them."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.templates import bind_parameters
from tidemark.sources.schemas import generations_of, read_generations

# Production environment name, local replacement database.
PRODUCTION = "prd"
LOCAL_DATABASE = "dblocal"
# Jobs that sort whole rows: splits of their scans, and the fewest parts of a shuffle.
SORT_SPLIT_BYTES, SORT_PARTITIONS = 1 << 24, 1024


def where_text(df: DataFrame, predicate: str | None, params: Mapping[str, str] | None = None) -> DataFrame:
    """Filter by predicate text whose ``{NAME}`` placeholders are bound as literals.

    The filter sits directly on the scan, so Catalyst turns it into partition filters
    and pushed filters.
    """
    if predicate is None or not predicate.strip():
        return df
    text, args = bind_parameters(predicate, params or {})
    # sql() fills {source} itself, so braces of the predicate have to be doubled for it.
    text = text.replace("{", "{{").replace("}", "}}")
    return df.sparkSession.sql(f"SELECT * FROM {{source}} WHERE {text}", args=args, source=df)


def database_for(database: str, environment: str = PRODUCTION, local: str | bool = False) -> str:
    """Outside production the local flag redirects catalog reads to one database."""
    wants_local = str(local).strip().lower() == "true"
    return LOCAL_DATABASE if wants_local and environment != PRODUCTION else database


def read_grouping(spark: SparkSession, settings: Mapping[str, object]) -> SparkSession:
    """Pack small files into scan tasks of ``group_size_bytes``; both settings required."""
    missing = [k for k in ("group_files", "group_size_bytes") if k not in settings]
    if missing:
        raise ValueError("missing read settings: " + ", ".join(missing))
    size = int(settings["group_size_bytes"])
    if str(settings["group_files"]).lower() == "none":
        # No packing: opening a file costs as much as a full task.
        spark.conf.set("spark.sql.files.openCostInBytes", str(size))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    return spark


@contextmanager
def grouped_reads(spark: SparkSession, settings: Mapping[str, object] | None) -> Iterator[None]:
    """``read_grouping`` for the jobs that run inside; then the session is as it was."""
    names = ("spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes")
    before = {n: spark.conf.get(n) for n in names}
    try:
        if settings is not None:
            read_grouping(spark, settings)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@contextmanager
def bounded_sorts(spark: SparkSession, partitions: int = SORT_PARTITIONS, split_bytes: int = SORT_SPLIT_BYTES) -> Iterator[None]:
    """For jobs inside that sort whole rows, such as duplicate removal: what one task sorts has
    a bound that no table outgrows. Scans are cut into splits of at most ``split_bytes``, and
    shuffles into at least ``partitions``, which AQE merges by size where they are small."""
    initial, split = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.files.maxPartitionBytes"
    before = {initial: spark.conf.get(initial, None), split: spark.conf.get(split)}
    asked = int(before[initial] or spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set(initial, str(max(partitions, asked)))
    in_bytes = re.fullmatch("([0-9]+)b?", before[split])  # a size in other units was set by hand, and stays
    if in_bytes and int(in_bytes[1]) > split_bytes:
        spark.conf.set(split, str(split_bytes))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def read_table(
    spark: SparkSession,
    database: str,
    table: str,
    predicate: str | None = None,
    params: Mapping[str, str] | None = None,
    environment: str = PRODUCTION,
    local: str | bool = False,
    use_catalog_schema: bool = True,
) -> DataFrame:
    """A catalog table; with ``use_catalog_schema`` false, as its files have it: columns that
    only files have are there too, and in the widest type that any file uses."""
    name = f"`{database_for(database, environment, local)}`.`{table}`"
    rows = spark.table(name) if use_catalog_schema else _as_files_have_it(spark, name)
    return where_text(rows, predicate, params)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its store, spelled one way."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString().rstrip("/")


def table_location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'")
    return qualified(spark, rows.first()["data_type"])


def _as_files_have_it(spark: SparkSession, name: str) -> DataFrame:
    home, catalog = table_location(spark, name), spark.table(name).schema
    parts = {c.name for c in spark.catalog.listColumns(name) if c.isPartition}
    keys = [f for f in catalog if f.name in parts]
    if keys:
        folders = [f"{home}/{r[0]}" for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    else:  # without partitions each file may be of another generation
        folders = [unquote(f) for f in spark.table(name).inputFiles()]
    return read_generations(spark, home, generations_of(spark, folders), keys, catalog)
