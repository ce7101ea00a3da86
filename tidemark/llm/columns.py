"""Column expressions that several operators share. All of them run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_of(text_col: str) -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(text_col), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else. Pure ASCII texts take the faster function."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))
