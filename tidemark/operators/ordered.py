"""Ordered computations inside groups of any size.

A group is cut into splits by bounds on its full ordering key. The bounds are quantiles of a
draw: one row in ``Splits.every``, chosen by a hash of its values, and of the drawn rows of a
group each ``Splits.size``-th. So a group gets one bound per ``every * size`` rows, wherever
its rows lie: all in one hour, or all at one moment and told apart by the next column only.
Rows are dealt once by group and split; prefixes over the split totals give each split its
start. A group without bounds is one split.

Two scans: the draw, which reads the key columns only, and the rows. Sorting inside splits
and the totals of splits read the same shuffle. Everything depends on values only, no job
runs while the plan is built, and nothing is stored. There are at most ``Splits.most`` bounds
over all groups, and a start for each: that is all that is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PLACE, SPLIT = "_place", "_split"


@dataclass(frozen=True)
class Splits:
    """One row in ``every`` is drawn; ``size`` drawn rows lie between two bounds, or more in
    tables so large that there would be over ``most`` bounds."""

    every: int = 1024
    size: int = 1024
    most: int = 1 << 16


def _bounds(rows: DataFrame, keys: Sequence[str], splits: Splits) -> DataFrame:
    """The keys and ``_bounds``: ascending, one per ``every * size`` rows of the group."""
    draw = F.pmod(F.xxhash64(*keys, PLACE), F.lit(splits.every)) == 0
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(PLACE))
    drawn = rows.select(*keys, PLACE).where(draw).withColumn("_nth", nth)
    chosen = drawn.where(F.pmod("_nth", F.lit(splits.size)) == 0)
    # One row per every * size of the table is left here, few enough to be counted in one task.
    stride = F.ceil(F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))) / F.lit(splits.most))
    chosen = chosen.withColumn("_stride", stride).where(F.pmod(F.col("_nth") / F.lit(splits.size), F.col("_stride")) == 0)
    return chosen.groupBy(*keys).agg(F.sort_array(F.collect_list(PLACE)).alias("_bounds"))


def _at_or_below(bounds: Column, place: Column) -> Column:
    """How many of the ascending ``bounds`` are not above ``place``, by halving."""
    start = F.struct(F.lit(0).alias("lo"), F.size(bounds).alias("hi"))
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(bounds) + F.lit(1))).cast("int"))

    def halve(at: Column, _: Column) -> Column:
        middle = F.shiftright(at["lo"] + at["hi"], 1)
        above = F.get(bounds, middle) > place
        return (
            F.when(at["lo"] >= at["hi"], at)
            .when(above, F.struct(at["lo"].alias("lo"), middle.alias("hi")))
            .otherwise(F.struct((middle + 1).alias("lo"), at["hi"].alias("hi")))
        )

    return F.when(bounds.isNull(), 0).otherwise(F.aggregate(rounds, start, halve, lambda at: at["lo"]))


def _keyed(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """With the ordering key as one value, and the keys; a constant where there are none."""
    rows = df.withColumn(PLACE, F.struct(*order))
    return (rows, list(keys)) if keys else (rows.withColumn("_all", F.lit(0)), ["_all"])


def _with_small(rows: DataFrame, small: DataFrame, on: Sequence[str], value: str) -> DataFrame:
    """Left join that takes nulls of the keys as equal. ``small`` is bounded by ``Splits.most``."""
    renamed = small.select(*[F.col(k).alias(f"_on_{k}") for k in on], value)
    condition = F.lit(True)
    for k in on:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_on_{k}"))
    return rows.join(F.broadcast(renamed), condition, "left").drop(*[f"_on_{k}" for k in on])


def _dealt(rows: DataFrame, keys: Sequence[str], splits: Splits, first: Column | None = None) -> DataFrame:
    """Rows of one split in one task. Rows with ``first`` open their group."""
    drawn = rows if first is None else rows.where(~first)
    found = _at_or_below(F.col("_bounds"), F.col(PLACE))
    split = found if first is None else F.when(first, 0).otherwise(found)
    placed = _with_small(rows, _bounds(drawn, keys, splits), keys, "_bounds").withColumn(SPLIT, split)
    return placed.drop("_bounds", PLACE).repartition(*keys, SPLIT)


def _by_split(dealt: DataFrame, keys: Sequence[str], *totals: Column) -> DataFrame:
    """Totals of each split. A digest over all columns makes this read the shuffle that the
    rows themselves are read from, not the input once more."""
    named = {f.name: F.col(f"`{f.name}`") for f in dealt.schema}
    hashed = [F.size(named[f.name]) if isinstance(f.dataType, T.MapType) else named[f.name] for f in dealt.schema]
    whole = F.bit_xor(F.xxhash64(*hashed)).alias("_whole")
    return dealt.groupBy(*keys, SPLIT).agg(whole, *totals).where(F.col("_whole").isNotNull())


def _inside(keys: Sequence[str], *order, upto: int = Window.currentRow):
    return Window.partitionBy(*keys, SPLIT).orderBy(*order).rowsBetween(Window.unboundedPreceding, upto)


def _earlier_splits(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(SPLIT).rowsBetween(Window.unboundedPreceding, -1)


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    weight: Column,
    out: str,
    base: DataFrame | None = None,
    splits: Splits = Splits(),
) -> DataFrame:
    """Sum of the whole numbers ``weight`` of the group up to and with each row, by ``order``.

    ``base`` (the keys plus ``base``, one row per group) tells the number each group
    continues from; a null one counts as 0. ``order`` should be total.
    """
    rows, by = _keyed(df.withColumn("_weight", weight.cast("long")), keys, order)
    first, ahead = None, []
    if base is not None:
        # A group's base is a row before all others, so that it needs no join of its own.
        opening = base.select(*keys, F.coalesce("base", F.lit(0)).cast("long").alias("_weight"), F.lit(True).alias("_opens"))
        rows = rows.withColumn("_opens", F.lit(False)).unionByName(opening, allowMissingColumns=True)
        first, ahead = F.col("_opens"), [F.desc("_opens")]
    dealt = _dealt(rows, by, splits, first)
    sums = _by_split(dealt, by, F.sum("_weight").alias("_sum"))
    starts = sums.withColumn("_start", F.sum("_sum").over(_earlier_splits(by))).where(F.col("_start") != 0)
    numbered = dealt.withColumn("_inside", F.sum("_weight").over(_inside(by, *ahead, *order)))
    if first is not None:
        numbered = numbered.where(~first)
    total = F.col("_inside") + F.coalesce("_start", F.lit(0))
    return _with_small(numbered, starts, [*by, SPLIT], "_start").select(*df.columns, total.cast("long").alias(out))


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    out: str,
    base: DataFrame | None = None,
    splits: Splits = Splits(),
) -> DataFrame:
    """1, 2, 3 ... inside each group by ``order``, or onwards from its ``base``."""
    return running_total(df, keys, order, F.lit(1), out, base, splits)


def carry_forward(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    include_current: bool = True,
    splits: Splits = Splits(),
) -> DataFrame:
    """Last non-null ``value`` of the group up to each row (or strictly before it)."""
    rows, by = _keyed(df, keys, order)
    dealt = _dealt(rows, by, splits)
    last = F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order))).alias("_last")
    before = F.last("_last", ignorenulls=True).over(_earlier_splits(by))
    starts = _by_split(dealt, by, last).withColumn("_before", before).where((F.col(SPLIT) > 0) & F.col("_before").isNotNull())
    inside = F.last(value, ignorenulls=True).over(_inside(by, *order, upto=0 if include_current else -1))
    return _with_small(dealt.withColumn("_inside", inside), starts, [*by, SPLIT], "_before").select(
        *df.columns, F.coalesce("_inside", "_before").alias(out)
    )
