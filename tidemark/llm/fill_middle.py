"""Fill-in-middle: texts cut in three, with the middle moved to the end.

Cutting is one full match of ``(unit)*`` by the ``regex`` library, which keeps every
repetition of a captured group: their ends tell how many units there are and where any two
cuts fall. Only those numbers leave the worker; the output is put together by Spark.

The library holds some 140 bytes a unit while it matches, and ends with a memory error at a
few million units. So a text of more than ``STRETCH`` characters is matched in stretches of as
many units, each by the same repeated capture; the ends are the same.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import text_of

PLAIN, PSM, SPM = "plain", "psm", "spm"
MARKS = ("<P>", "<S>", "<M>")
STRETCH = 1_000_000
CUTS = "n long, first long, second long"


class Units:
    """Texts cut into units, matched from left to right and never taken back."""

    def __init__(self, unit: str, stretch: int = STRETCH):
        if regex.compile(f"(?s:{unit})").fullmatch(""):
            raise ValueError("a unit must not match the empty text")
        self.stretch = stretch
        one = unit if unit == "." else f"(?>{unit})"
        self.whole = regex.compile(f"(?s:({one}))*")
        self.part = regex.compile(f"(?s:({one})){{1,{stretch}}}")

    def ends(self, text: str) -> Sequence[int] | None:
        """Where each unit ends; None if units do not cover the text."""
        if len(text) <= self.stretch:
            match = self.whole.fullmatch(text)
            return match and match.ends(1)
        parts, at = [], 0
        while at < len(text):
            match = self.part.match(text, at)
            if match is None:
                return None
            parts.append(np.array(match.ends(1)))
            at = match.end()
        return np.concatenate(parts)

    def cuts(self, text: str, one: int, other: int) -> tuple[int, int, int]:
        """How many units, and the offsets behind ``one % (n + 1)`` and ``other % (n + 1)`` of
        them, the smaller first; -1 units if they do not cover the text."""
        ends = self.ends(text)
        if ends is None:
            return -1, 0, 0
        n = len(ends)
        first, second = sorted((one % (n + 1), other % (n + 1)))
        behind = lambda count: int(ends[count - 1]) if count else 0
        return n, behind(first), behind(second)


def cutter(unit: str, stretch: int = STRETCH):
    """A column function ``(text, one, other)`` -> ``CUTS``."""
    units = Units(unit, stretch)

    def cuts(text: pd.Series, one: pd.Series, other: pd.Series) -> pd.DataFrame:
        found = [units.cuts(*row) for row in zip(text, one.tolist(), other.tolist())]
        return pd.DataFrame(found, columns=["n", "first", "second"])

    return F.pandas_udf(cuts, CUTS)


def draws(seed: int, id_column: Column, count: int) -> list[Column]:
    """Unsigned 32-bit numbers: the first 8-digit groups of the sha256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(count)]


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 1,
    unit: str = ".",
    plain_percent: int = 10,
    spm_percent: int = 20,
    marks: Sequence[str] = MARKS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``id_col, n, form, prefix_chars, middle_chars, output`` of every row, and ``row`` with
    the columns to ``keep``.

    ``form`` is plain (the text as it is) if the text is empty, holds a mark or is drawn to stay
    (``plain_percent``), else prefix, suffix, middle, or (``spm_percent``) suffix, prefix,
    middle, each behind its mark. Draws depend on seed and id only, so rows that repeat an id are
    cut alike; a null text is empty, a null id counts as the empty text. A text that units do
    not cover to its end stays plain, with a null ``n``. Columns that are not named make no
    difference, whatever they are called.
    """
    prefix_mark, suffix_mark, middle_mark = map(F.lit, marks)
    slim = docs.select(
        F.col(id_col).alias("_id"),
        text_of(text_col).alias("_text"),
        *([F.struct(*keep).alias("_row")] if keep else []),
    )
    one, other, stays, order = draws(seed, F.col("_id"), 4)
    drawn = slim.withColumns({"_stays": stays, "_order": order, "_cut": cutter(unit)("_text", one, other)})
    marked = F.lit(False)
    for mark in marks:
        marked = marked | F.contains("_text", F.lit(mark))
    plain = (F.length("_text") == 0) | marked | (F.col("_stays") % 100 >= 100 - plain_percent) | (F.col("_cut.n") < 0)
    formed = drawn.withColumn("_form", F.when(plain, PLAIN).when(F.col("_order") % 100 < spm_percent, SPM).otherwise(PSM))
    first, second = F.col("_cut.first"), F.col("_cut.second")
    prefix = F.substring("_text", F.lit(1), first)
    middle = F.substring("_text", first + 1, second - first)
    suffix = F.substring("_text", second + 1, F.length("_text"))
    psm = F.concat(prefix_mark, prefix, suffix_mark, suffix, middle_mark, middle)
    spm = F.concat(suffix_mark, suffix, prefix_mark, prefix, middle_mark, middle)
    cut = F.col("_form") != PLAIN
    return formed.select(
        F.col("_id").alias(id_col),
        F.when(F.col("_cut.n") >= 0, F.col("_cut.n")).alias("n"),
        F.col("_form").alias("form"),
        F.when(cut, first).alias("prefix_chars"),
        F.when(cut, second - first).alias("middle_chars"),
        F.when(~cut, F.col("_text")).when(F.col("_form") == SPM, spm).otherwise(psm).alias("output"),
        *([F.col("_row").alias("row")] if keep else []),
    )


def restored(output: Column, form: Column, marks: Sequence[str] = MARKS) -> Column:
    """The text that ``output`` was made of. The marks occur once each, as texts that hold one
    stay plain."""
    p, s, m = (rf"\Q{mark}\E" for mark in marks)
    from_psm = F.regexp_replace(output, rf"(?s)\A{p}(.*){s}(.*){m}(.*)\z", "$1$3$2")
    from_spm = F.regexp_replace(output, rf"(?s)\A{s}(.*){p}(.*){m}(.*)\z", "$2$3$1")
    return F.when(form == PSM, from_psm).when(form == SPM, from_spm).otherwise(output)
