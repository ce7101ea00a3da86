"""Mixing sources to target weights by systematic sampling.

Each document of a source expects the same number of copies, its source's target over its
size. Prefix sums of the expected copies, shifted by one random offset per source, cross an
integer boundary at some documents: each boundary emits one copy. Documents are summed in the
order of their sizes, so short and long ones are taken alike and a source's words come near
its target.

All of it is DataFrame functions. Numbers are whole: a copy is ``UNIT`` parts, so that sums
are exact whatever the order of addition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import text_of
from tidemark.llm.scratch import Scratch
from tidemark.operators.ordered import Splits, number_rows

BITS = 26
UNIT = 1 << BITS
WORD = r"[^\x20\x09-\x0D]+"


def water_level(sources: DataFrame, total: float) -> float:
    """What one unit of weight gets when ``total`` is shared by ``weight`` and no source gets
    more than its ``cap``: the excess is shared again by weight until none is above. Each round
    is one aggregate over the sources."""
    level = None
    while True:
        full = F.lit(False) if level is None else F.col("weight") * F.lit(level) > F.col("cap")
        capped, open_weight = sources.agg(
            F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
        ).first()
        if not open_weight:
            return float("inf") if level is not None else 0.0
        higher = (total - capped) / open_weight
        if level is not None and higher <= level:
            return level
        level = higher


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: int, scratch: Scratch, splits: Splits = Splits()) -> DataFrame:
    """``key, source_size, target`` of every source, from ``key, source, size`` rows.

    Sources are ranked by code point, a null one last; the weights repeat over the ranks.
    """
    totals = sizes.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    totals = scratch.store(totals.withColumn("last", F.col("source").isNull()), "totals")
    ranked = number_rows(totals, [], ["last", "source"], "nth", splits=splits)
    cycle = F.array(*[F.lit(w) for w in weights])
    weight = F.element_at(cycle, (F.pmod(F.col("nth") - 1, F.lit(len(weights))) + 1).cast("int"))
    sources = scratch.store(ranked.select("key", "source_size", weight.alias("weight"), (F.col("source_size") * most).alias("cap")), "sources")
    everything = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level = water_level(sources, share * everything)
    by_weight = F.col("weight") * F.lit(level)
    target = F.when((F.lit(level) == float("inf")) | (by_weight > F.col("cap")), F.col("cap").cast("double")).otherwise(by_weight)
    return scratch.store(sources.select("key", "source_size", target.alias("target")), "targets")


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    most: int = 2,
    seed: int = 1,
    keep: Sequence[str] = (),
    splits: Splits = Splits(),
) -> DataFrame:
    """``id_col, source_col, size, source_size, target, copies, taken`` of every row, and
    ``row`` with the columns to ``keep``.

    ``size`` counts words; the mix takes ``share`` of all words, and of no document more than
    ``most`` copies. A source's taken words differ from its target by at most twice the size of its longest
    document. Null texts and texts without words have size 0 and may be copied, which takes no
    words; null ids and sources are values like others; repeated rows are rows of their own.
    Runs agree: the offset depends on seed and source, and rows that are equal in source, size,
    id and text are told apart by nothing that shows. Other columns make no difference.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    text = text_of(text_col)
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        F.coalesce(F.concat(F.lit("+"), F.col(source_col).cast("string")), F.lit("-")).alias("key"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(text).alias("tie"),
        *([F.struct(*keep).alias("row")] if keep else []),
    )
    rows = scratch.store(rows.withColumn("place", F.monotonically_increasing_id()), "rows")
    targets = source_targets(rows.select("key", "source", "size"), weights, share, most, scratch, splits)
    numbered = number_rows(rows, ["key"], ["size", "id", "tie", "place"], "nth", splits=splits)
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key")), 256)
    offset = F.shiftright(F.conv(F.substring(draw, 1, 7), 16, 10).cast("long"), 28 - BITS)
    rate = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * UNIT)).otherwise(0)
    rated = numbered.join(targets.withColumns({"rate": rate, "offset": offset}), "key")
    crossed = lambda nth: F.shiftright(nth * F.col("rate") + F.col("offset"), BITS)
    copies = crossed(F.col("nth")) - crossed(F.col("nth") - 1)
    return rated.select(
        F.col("id").alias(id_col),
        F.col("source").alias(source_col),
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
        *(["row"] if keep else []),
    )


def mixture(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken."""
    mixed = mix_sources(docs, keep=docs.columns, **settings)
    return mixed.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("row.*")
