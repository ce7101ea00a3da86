"""State of ingestions and processes from append-only status rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import carry_forward

# Allowed state changes; None is "no row yet".
INGESTION_MOVES = (
    (None, "PROCESSING_SOR"),
    ("PROCESSING_SOR", "LOADED_SOR"),
    ("PROCESSING_SOR", "PROCESSING_FAILURE"),
    ("PROCESSING_SOR", "FAILED_SOR"),
)
PROCESS_MOVES = (
    (None, "LOCKING_INPUTS"),
    (None, "RUNNING"),
    (None, "FAILED_INVALID_OVERRIDE"),
    (None, "FAILED_INPUT_MISSING"),
    ("LOCKING_INPUTS", "RUNNING"),
    ("LOCKING_INPUTS", "FAILED_INVALID_OVERRIDE"),
    ("LOCKING_INPUTS", "FAILED_INPUT_MISSING"),
    ("RUNNING", "RULES_PROCESSED"),
    ("RUNNING", "PROCESSING_FAILURE"),
    ("RUNNING", "FAILED_RULES"),
    ("RULES_PROCESSED", "WAITING_SPEC_PUBLICATION"),
    ("RULES_PROCESSED", "PUBLISHING_SPEC"),
    ("RULES_PROCESSED", "PUBLISHED"),
    ("WAITING_SPEC_PUBLICATION", "PUBLISHING_SPEC"),
    ("WAITING_SPEC_PUBLICATION", "PUBLISHED"),
    ("PUBLISHING_SPEC", "PUBLISHED"),
    ("PUBLISHING_SPEC", "FAILED_SPEC"),
)


def latest_status(rows: DataFrame, ids: Sequence[str]) -> DataFrame:
    """State of each id: the status written last."""
    return rows.groupBy(*ids).agg(
        F.max_by("status", F.struct("at", "seq")).alias("status"),
        F.max("at").alias("updated_at"),
        F.count(F.lit(1)).alias("changes"),
    )


def checked_transitions(
    rows: DataFrame, ids: Sequence[str], moves: Iterable[tuple[str | None, str]]
) -> DataFrame:
    """Each status row with the status before it and whether that change is allowed.

    An id with many rows is spread over tasks.
    """
    allowed = [f"{a or ''}>{b}" for a, b in moves]
    step = F.concat_ws(">", F.coalesce("previous_status", F.lit("")), "status")
    line = carry_forward(rows, ids, ["at", "seq"], "status", "previous_status", include_current=False)
    return line.withColumn("allowed", step.isin(*allowed))
