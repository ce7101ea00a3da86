"""Exact duplicates by progressive refinement.

Documents are grouped by length, the groups that remain by length and prefix hash, and only
what still has company is hashed in full. Which keys remain is passed from one scan to the
next as a bitmap of fixed size, so no scan shuffles a text: a key that shares its bit with a
remaining one is only hashed for nothing, and the full hash decides alone.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bitmaps import BITMAP_BITS, bitmap_of, with_flag
from tidemark.llm.columns import ascii_lower, text_of
from tidemark.llm.scratch import Scratch

PREFIX_CHARS = 128


def _shared(df: DataFrame, *keys: str) -> DataFrame:
    """The keys that more than one row has."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*keys)


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Mapping[str, Column] | None = None,
    prefix_chars: int = PREFIX_CHARS,
    bitmap_bits: int = BITMAP_BITS,
) -> DataFrame:
    """One row per row of ``docs``: the id, ``keep_id``, ``group_size``, ``kept``.

    Texts are equal when they are identical after lower-casing A-Z; a null text is the empty
    text. Of equal texts the largest id stays. Rows that repeat an id stay or go together,
    and each counts in ``group_size``. A null id loses against any other; a group of null
    ids only stays. Other columns, whatever their names, are ignored; ``carry`` adds columns
    computed from ``docs``. An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    text = text_of(text_col)
    folded = ascii_lower(text)
    carried = {name: column.alias(name) for name, column in (carry or {}).items()}
    # prefix hashes are needed for what shares its length, full hashes for what shares both
    lean = docs.select(F.col(id_col).alias("_id"), text.alias("_text"), F.octet_length(text).alias("_len"), *carried.values())
    prefix = F.xxhash64(ascii_lower(F.substring("_text", 1, prefix_chars)))

    lengths = scratch.store(bitmap_of(_shared(lean.select("_len"), "_len"), bitmap_bits), "lengths")
    by_length = with_flag(lean, lengths, [F.col("_len")], "_same_length", bitmap_bits)
    hashed = by_length.withColumn("_prefix", F.when(F.col("_same_length"), prefix))
    prefixes = hashed.where("_same_length").select("_len", "_prefix")
    both = scratch.store(bitmap_of(_shared(prefixes, "_len", "_prefix"), bitmap_bits), "prefixes")

    flagged = with_flag(hashed, both, [F.col("_len"), F.col("_prefix")], "_same_prefix", bitmap_bits)
    full = F.when(F.col("_same_length") & F.col("_same_prefix"), F.unhex(F.sha2(ascii_lower(F.col("_text")), 256)))
    keyed = scratch.store(flagged.select("_id", full.alias("_full"), *carried), "keyed")

    alone = keyed.where("_full is null").select(
        F.col("_id").alias(id_col), F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), *carried,
    )
    suspects = keyed.where("_full is not null")
    groups = suspects.groupBy("_full").agg(F.max("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = scratch.store(groups, "groups")  # read anew, so that AQE can split a large group in the join
    grouped = suspects.join(groups, "_full").select(
        F.col("_id").alias(id_col), "keep_id", "group_size", F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"), *carried
    )
    return alone.unionByName(grouped)
