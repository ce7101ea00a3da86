"""Partitioned Parquet output that replaces exactly the partitions it contains."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.specs import DestSpec


@dataclass(frozen=True)
class WriteReport:
    """Where a write went, its rows, and the partitions it replaced, as the job saw them."""

    path: str
    rows: int
    keys: Sequence[str] = ()
    partitions: Sequence[Mapping[str, str | None]] = ()
    schema: T.StructType | None = None


def check_partition_keys(columns: Sequence[str], keys: Sequence[str]) -> list[str]:
    """Trimmed, non-blank keys; each must be an output column, spelled the same."""
    wanted = [k.strip() for k in keys if k and k.strip()]
    if not wanted:
        raise ValueError("at least one partition column is required")
    absent = [k for k in wanted if k not in columns]
    if absent:
        raise ValueError("partition columns not in the output: " + ", ".join(absent))
    if set(wanted) == set(columns):
        raise ValueError("at least one column must not be a partition column")
    return wanted


def arranged(df: DataFrame, keys: Sequence[str], constant_keys: Sequence[str] = ()) -> DataFrame:
    """Rows of one partition close together, without putting a large one in one task.

    Stamped keys have one value per run, so shuffling on them alone would be pointless and
    harmful: such output keeps its partitioning. Otherwise Spark rebalances by the data
    keys and splits large partitions / merges small ones by size at run time.
    """
    varying = [k for k in keys if k not in constant_keys]
    return df.hint("rebalance", *varying) if varying else df


def writer(df: DataFrame, dest: DestSpec):
    out = (
        df.write.mode("overwrite")
        .option("compression", dest.compression)
        .option("parquet.block.size", str(dest.block_size_bytes))
    )
    if dest.max_records_per_file:
        out = out.option("maxRecordsPerFile", str(dest.max_records_per_file))
    return out


def write_partitions(
    df: DataFrame, dest: DestSpec, constant_keys: Sequence[str] = ()
) -> WriteReport:
    """One job: partitions in ``df`` are replaced, all others stay, no rows change nothing.

    The new files are staged and put in place when the job commits, so a job may read what
    it replaces, and a failed job leaves the old partitions.
    """
    keys = check_partition_keys(df.columns, dest.partition_keys)
    return write_files(arranged(df, keys, constant_keys), dest, keys)


def write_files(df: DataFrame, dest: DestSpec, keys: Sequence[str]) -> WriteReport:
    """``write_partitions`` for rows that lie in tasks as they should in files."""
    observation = Observation()
    tuple_of_keys = F.struct(*[F.col(f"`{k}`").cast("string").alias(k) for k in keys])
    counted = df.observe(
        observation, F.count(F.lit(1)).alias("rows"), F.collect_set(tuple_of_keys).alias("partitions")
    )
    (
        writer(counted, dest)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(dest.path)
    )
    seen = observation.get
    partitions = [p.asDict() if hasattr(p, "asDict") else dict(zip(keys, p)) for p in seen["partitions"]]
    return WriteReport(dest.path, seen["rows"], keys, partitions, df.schema)
