"""The split of documents into those that models may learn from and those held out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FOLDS = 5


def held_out(id_column: Column) -> Column:
    """Whether crc32 of the id as text leaves 0; a null id is held out."""
    return F.coalesce(F.crc32(id_column.cast("string")) % FOLDS == 0, F.lit(True))
