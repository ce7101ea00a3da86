"""Regular expression matches with their places, inside the JVM.

Spark's functions return matched texts without places. The pieces between the matches come
from ``split`` with the same expression, so the places are running sums of lengths, in code
points. Only texts with a match are split. All work is in proportion to the text and its
matches: no array or text grows match by match.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN_TYPE = "array<struct<start:int,rank:int,end:int,kind:string>>"
MATCH_TYPE = "array<struct<start:int,found:array<string>>>"
BLOCK = 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def blocks_of(items: Column) -> Column:
    """The items in stretches of ``BLOCK``."""
    numbers = lambda v: F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int"))
    cut = lambda v: F.transform(numbers(v), lambda b: F.slice(v, b * BLOCK + 1, BLOCK))
    return let(items, lambda v: F.when(F.size(v) > 0, cut(v)).otherwise(F.array()))


def scanned(items: Column, zero: Column, step: Callable[[Column, Column], tuple[Column, Column]], state_type: str, out_type: str) -> Column:
    """For each item what ``step`` gives beside the next state, as an array in their order.

    A fold copies what it has gathered at each item. So a first walk gathers only the states
    in which blocks begin, and each block then gathers its own results: the work is nearly
    in proportion to the items.
    """

    def begins(blocks: Column) -> Column:
        walk = lambda acc, part: F.aggregate(part, acc["state"], lambda s, x: step(s, x)[0].cast(state_type))
        more = lambda acc, part: F.struct(walk(acc, part).alias("state"), F.concat(acc["all"], F.array(acc["state"])).alias("all"))
        start = F.struct(zero.cast(state_type).alias("state"), F.array().cast(f"array<{state_type}>").alias("all"))
        return F.aggregate(blocks, start, more, lambda acc: acc["all"])

    def results(part: Column, begin: Column) -> Column:
        def one(acc: Column, x: Column) -> Column:
            state, out = step(acc["state"], x)
            return F.struct(state.cast(state_type).alias("state"), F.concat(acc["out"], F.array(out.cast(out_type))).alias("out"))

        start = F.struct(begin.alias("state"), F.array().cast(f"array<{out_type}>").alias("out"))
        return F.aggregate(part, start, one, lambda acc: acc["out"])

    return let(blocks_of(items), lambda blocks: F.flatten(F.zip_with(blocks, begins(blocks), results)))


def matches(text: Column, pattern: str, groups: tuple[int, ...] = (0,)) -> Column:
    """Start and texts of these groups, group 0 first, of all leftmost non-overlapping matches."""
    empty = F.array().cast(MATCH_TYPE)

    def placed(found: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), 1, F.size(found))
        more = [F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in groups[1:]]
        names = ["gap", *[f"g{g}" for g in groups]]
        zipped = F.arrays_zip(*[a.alias(n) for a, n in zip([gaps, found, *more], names)])

        def step(at: Column, x: Column) -> tuple[Column, Column]:
            start = at + F.length(x["gap"])
            return start + F.length(x["g0"]), F.struct(start.alias("start"), F.array(*[x[n] for n in names[1:]]).alias("found"))

        items = scanned(zipped, F.lit(0), step, "int", MATCH_TYPE[len("array<") : -1])
        return F.when(F.size(found) > 0, items).otherwise(empty)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def spans(text: Column, pattern: str, kind: str, rank: int, keep: Callable[[Column], Column] | None = None) -> Column:
    """All leftmost non-overlapping matches for which ``keep`` holds, as ``SPAN_TYPE``."""
    return F.transform(kept_matches(text, pattern, keep), lambda m: span_of(m, kind, rank)).cast(SPAN_TYPE)


def kept_matches(text: Column, pattern: str, keep: Callable[[Column], Column] | None = None) -> Column:
    found = matches(text, pattern)
    return found if keep is None else F.filter(found, lambda m: keep(m["found"][0]))


def span_of(match: Column, kind: str, rank: int) -> Column:
    end = match["start"] + F.length(match["found"][0])
    return F.struct(match["start"].alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"))


def in_order(*span_arrays: Column) -> Column:
    """One array, by start and then by rank."""
    return F.sort_array(F.concat(*span_arrays))


def count_of(all_spans: Column, kind: str) -> Column:
    return F.size(F.filter(all_spans, lambda s: s["kind"] == kind)).cast("long")


def rendered(all_spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(all_spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
