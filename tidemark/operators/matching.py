"""Configuration lookups that must find exactly one row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import enabled

FOUND, NOT_FOUND, AMBIGUOUS = "OK", "NOT_FOUND", "AMBIGUOUS"


def exactly_one_match(
    requests: DataFrame,
    config: DataFrame,
    on: Sequence[str],
    payload: Sequence[str],
    wildcard: str | None = None,
) -> DataFrame:
    """Each request with the one matching configuration row, or why there is none.

    A null ``wildcard`` column in the configuration matches any request. The configuration
    is reduced to one row per key before the join, so requests are never multiplied and
    need no regrouping.
    """
    on = list(on)
    exact_keys = on + ([wildcard] if wildcard else [])
    chosen = F.struct(*[F.col(p) for p in payload])

    def reduced(rows: DataFrame, keys: list[str], tag: str) -> DataFrame:
        return rows.groupBy(*keys).agg(
            F.count(F.lit(1)).alias(f"_n_{tag}"), F.min(chosen).alias(f"_row_{tag}")
        )

    exact = config.where(F.col(wildcard).isNotNull()) if wildcard else config
    out = requests.join(reduced(exact, exact_keys, "exact"), exact_keys, "left")
    total, row = F.coalesce("_n_exact", F.lit(0)), F.col("_row_exact")
    if wildcard:
        out = out.join(reduced(config.where(F.col(wildcard).isNull()), on, "any"), on, "left")
        total = total + F.coalesce("_n_any", F.lit(0))
        row = F.coalesce("_row_exact", "_row_any")
    out = out.withColumns(
        {
            "matches": total.cast("long"),
            "match_status": F.when(total == 0, NOT_FOUND).when(total > 1, AMBIGUOUS).otherwise(FOUND),
        }
    )
    for p in payload:
        out = out.withColumn(p, F.when(F.col("match_status") == FOUND, row[p]))
    return out.select(*requests.columns, "matches", "match_status", *payload)


def register_lookup(events: DataFrame, sor_table_config: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) arrival events; accepted ones carry their internal table.

    An event is accepted when enabled rows map its process, database and table to exactly
    one internal table; else ``reject_reason`` says that none or several do.
    """
    keys = ["process_name", "source_database_name", "source_table_name"]
    target = F.struct("sor_database_name", "sor_table_name")
    mapped = (
        sor_table_config.where(enabled(F.col("enabled")))
        .groupBy(*keys)
        .agg(F.min(target).alias("_to"), (F.min(target) == F.max(target)).alias("_one"))
    )
    judged = events.join(mapped, keys, "left")
    accepted = judged.where("_one").select(*events.columns, "_to.sor_database_name", "_to.sor_table_name")
    reason = F.when(F.col("_one").isNull(), NOT_FOUND).otherwise(AMBIGUOUS).alias("reject_reason")
    return accepted, judged.where(~F.coalesce("_one", F.lit(False))).select(*events.columns, reason)
