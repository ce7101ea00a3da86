"""SQL steps and stamped columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.templates import bind_parameters

# Name of step results, column of the surrogate row id.
STEP_PREFIX = "query_temp_"
ROW_ID = "chave_processamento_registro"


def staged_sql(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    steps: Sequence[str],
    params: Mapping[str, str] | None = None,
) -> DataFrame:
    """Run SQL texts in order; step N is visible as ``query_temp_N``, the last is returned.

    Sources and steps are temporary views only while the texts are analysed; a view of
    that name made by somebody else is an error, not replaced. Nothing is executed here:
    Catalyst sees the whole chain as one plan.
    """
    texts = [s.strip().rstrip(";") for s in steps if s.strip().rstrip(";")]
    if not texts:
        raise ValueError("no SQL step to run")
    registered, result = [], None
    try:
        for name, df in frames.items():
            df.createTempView(name)
            registered.append(name)
        for number, text in enumerate(texts, start=1):
            bound, args = bind_parameters(text, params or {}, strict=False)
            result = spark.sql(bound, args=args) if args else spark.sql(bound)
            result.createTempView(f"{STEP_PREFIX}{number}")
            registered.append(f"{STEP_PREFIX}{number}")
    finally:
        for name in registered:
            spark.catalog.dropTempView(name)
    return result


def technical_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Append constant text columns; an existing column of that name is replaced."""
    return df.withColumns({name: F.lit(str(value)) for name, value in columns.items()})


def surrogate_row_id(df: DataFrame, column: str = ROW_ID) -> DataFrame:
    """Unique 64-bit id per row: no shuffle, but neither dense nor stable between runs."""
    return df.withColumn(column, F.monotonically_increasing_id())


def stable_row_id(df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str = ROW_ID) -> DataFrame:
    """Repeatable row number inside ``keys``, by ``order`` (which must be total)."""
    from tidemark.operators.ordered import number_rows

    return number_rows(df, keys, order, column)


def latest_rows(df: DataFrame, keys: Sequence[str], order: Sequence, n: int = 1) -> DataFrame:
    """The first ``n`` rows of each group by ``order``, limited before the shuffle too."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= n).drop("_rank")
