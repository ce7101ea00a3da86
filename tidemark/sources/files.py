"""Scans of file paths. An explicit schema keeps ids with leading zeros as text."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.tables import where_text

# Fixed value: placeholder of the reference month in a dated path.
MONTH_PLACEHOLDER = "{ANO_MES_DATA_REF}"


def read_parquet(
    spark: SparkSession,
    path: str | Sequence[str],
    schema=None,
    predicate: str | None = None,
    params: Mapping[str, str] | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """Parquet under ``path``; with ``schema`` the given types win over the files'."""
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    if schema is not None:
        reader = reader.schema(schema)
    return where_text(reader.parquet(*paths), predicate, params)


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema=None,
    predicate: str | None = None,
    params: Mapping[str, str] | None = None,
    header: bool = True,
    delimiter: str = ",",
    quote: str = '"',
    escape: str = "\\",
    infer_schema: bool = False,
    encoding: str = "UTF-8",
) -> DataFrame:
    """CSV file or folder. Inference reads the data twice and loses leading zeros, so it
    is used only when asked for and no schema is given."""
    paths = [path] if isinstance(path, str) else list(path)
    reader = (
        spark.read.option("header", str(header).lower())
        .option("sep", delimiter)
        .option("quote", quote)
        .option("escape", escape)
        .option("encoding", encoding)
    )
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", str(infer_schema).lower())
    return where_text(reader.csv(paths), predicate, params)


def read_landing(spark: SparkSession, paths: Sequence[str], schema) -> DataFrame:
    """Parquet at the paths named by arrival events; a wrong path fails before any write."""
    named = sorted(set(paths))
    if not named:
        raise ValueError("no landing path given")
    return spark.read.schema(schema).option("ignoreMissingFiles", "false").parquet(*named)


def read_dated(
    spark: SparkSession,
    template: str,
    schema,
    month: str | None = None,
    file_format: str = "parquet",
    column: str = "ano_mes_data_ref",
    **options: str,
) -> DataFrame:
    """Files whose path carries the month; ``column`` tells the month of each row.

    With ``month`` only that path is listed. Without it all months are read, and a later
    filter on ``column`` still prunes files because it is derived from the file path.
    """
    if MONTH_PLACEHOLDER not in template:
        raise ValueError(f"path must contain {MONTH_PLACEHOLDER}")
    if month is not None and not re.fullmatch(r"[0-9]{6}", month):
        raise ValueError("month must be YYYYMM")
    path = template.replace(MONTH_PLACEHOLDER, month or "[0-9][0-9][0-9][0-9][0-9][0-9]")
    before = template.split(MONTH_PLACEHOLDER)[0].rsplit("/", 1)[-1]
    pattern = "/" + re.escape(before) + "([0-9]{6})"
    return (
        spark.read.format(file_format)
        .options(**options)
        .schema(schema)
        .load(path)
        .withColumn(column, F.regexp_extract(F.col("_metadata.file_path"), pattern, 1))
    )
