"""Key sets as bitmaps of fixed size, so that a scan can be filtered without a shuffle.

A bitmap has ``bits`` bits whatever the number of keys: its broadcast is bounded. A key
that is not in the set may share a bit with one that is, so a set bit means "perhaps".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch

BITMAP_BITS = 1 << 25  # 4 MB as broadcast


def _place(keys: list[Column], bits: int, salt: int = 0) -> Column:
    return F.pmod(F.xxhash64(*keys, *([F.lit(salt)] if salt else [])), F.lit(bits)) + 1


def bitmap_of(keys: DataFrame, bits: int = BITMAP_BITS, salt: int = 0) -> DataFrame:
    """At most ``bits / 32768 + 1`` rows of 4 kB: one bit for each row of ``keys``."""
    place = _place([F.col(c) for c in keys.columns], bits, salt)
    return keys.groupBy(F.bitmap_bucket_number(place).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits")
    )


def with_flag(df: DataFrame, bitmap: DataFrame, keys: list[Column], flag: str, bits: int = BITMAP_BITS, salt: int = 0) -> DataFrame:
    """Adds ``flag``: whether the bit of ``keys`` is set. The broadcast has a fixed bound."""
    place = _place(keys, bits, salt)
    df = df.withColumns({"_at": F.bitmap_bucket_number(place), "_bit": F.bitmap_bit_position(place)})
    joined = df.join(F.broadcast(bitmap), df["_at"] == bitmap["_bucket"], "left")
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(_bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    is_set = F.expr("shiftleft(1, cast(_bit % 8 as int))").bitwiseAND(byte) != 0
    return joined.withColumn(flag, F.coalesce(is_set, F.lit(False))).drop("_at", "_bit", "_bucket", "_bits")


def left_over(df: DataFrame, gone: DataFrame, scratch: Scratch, bits: int = BITMAP_BITS) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose keys, the columns of ``gone``, are not there; nulls are equal.

    They come in two parts. Rows without a bit in the first bitmap are not gone, and go through
    no shuffle. Of those with one, the keys alone are joined; what is left of them, the bits set
    by chance, makes a second bitmap. A row without a bit there is gone. Few have both bits:
    only these, the second part, are joined with all their columns.
    """
    keys = gone.columns
    same = lambda d: [d[c].eqNullSafe(gone[c]) for c in keys]
    found = with_flag(df, scratch.store(bitmap_of(gone, bits), "gone-bits"), [F.col(c) for c in keys], "_gone", bits)
    met = found.where("_gone").select(*keys)
    chance = scratch.store(bitmap_of(met.join(gone, same(met), "left_anti"), bits, 1), "chance-bits")
    doubt = with_flag(found.where("_gone"), chance, [F.col(c) for c in keys], "_chance", bits, 1).where("_chance").select(*df.columns)
    return found.where("not _gone").select(*df.columns), doubt.join(gone, same(doubt), "left_anti")
