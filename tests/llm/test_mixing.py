"""Source mixing: targets, nearness, bounds and odd rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.llm.mixing import mix_sources, mixture
from tidemark.operators.ordered import Splits

SCHEMA = "doc_id long, source string, text string, key int, size string, tie int, nth int, place int, row int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3, 4, 5) for r in rows], SCHEMA)


def shares(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Shared by weight, the excess again by weight until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    cap = {s: most * sizes[s] for s in names}
    full: set = set()
    while True:
        free = share * sum(sizes.values()) - sum(cap[s] for s in full)
        total = sum(weight[s] for s in names if s not in full)
        given = {s: cap[s] if s in full else free * weight[s] / total for s in names}
        above = {s for s in names if given[s] > cap[s]}
        if not above:
            return given
        full |= above


def words(n):
    return "w \t" * n


@pytest.mark.parametrize("splits", [Splits(), Splits(2, 8)])
def test_targets_and_nearness(spark, splits):
    """One source holds a third of the rows; lengths differ a thousandfold."""
    rows = [(i, "big" if i % 3 == 0 else f"s{i % 7}", words(i * 7919 % 60 + (1500 if i % 97 == 0 else 0))) for i in range(1500)]
    rows += [(i, None, words(4)) for i in range(1500, 1530)]
    mixed = mix_sources(table(spark, rows), splits=splits).collect()
    sizes, taken, longest = {}, {}, {}
    for r in mixed:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        longest[r.source] = max(longest.get(r.source, 0), r.size)
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
    expected = shares(sizes)
    for r in mixed:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(expected[r.source], rel=1e-12)
    for s, target in expected.items():
        assert abs(taken[s] - target) <= 2 * longest[s] + 1
    assert len(mixed) == len(rows)
    again = mix_sources(table(spark, rows[::-1]).repartition(5), splits=splits).collect()
    assert sorted(map(str, again)) == sorted(map(str, mixed))
    assert sorted(map(str, mix_sources(table(spark, rows), seed=2).collect())) != sorted(map(str, mixed))


def test_full_sources_are_taken_twice(spark):
    rows = [(i, "a", words(1)) for i in range(10)] + [(100 + i, "b", words(50)) for i in range(40)] + [(200 + i, "c", words(3)) for i in range(3)]
    mixed = mix_sources(table(spark, rows))
    copies = {r.source: r.c for r in mixed.groupBy("source").agg(F.collect_set("copies").alias("c")).collect()}
    assert copies["a"] == [2]
    assert {r.source: r.target for r in mixed.collect()} == pytest.approx(shares({"a": 10, "b": 2000, "c": 9}))


def test_odd_rows(spark):
    """Null ids, texts and sources, texts without words, rows that repeat."""
    rows = [(None, None, None)] * 3 + [(1, "", ""), (1, "", " \n"), (2, "é", words(3)), (2, "é", words(3)), (2, "é", words(9)), (3, "\U0001f600", " ")]
    mixed = mix_sources(table(spark, rows), splits=Splits(1, 1)).collect()
    assert len(mixed) == len(rows)
    assert {(r.source, r.source_size) for r in mixed} == {(None, 0), ("", 0), ("é", 15), ("\U0001f600", 1)}
    assert all(r.copies <= 2 for r in mixed)
    assert mix_sources(table(spark, rows).limit(0)).count() == 0
    assert {r.taken for r in mix_sources(table(spark, rows[:4])).collect()} == {0}


def test_the_mix_itself(spark):
    docs = table(spark, [(i, f"s{i % 2}", words(i % 5 + 1)) for i in range(60)])
    taken = {r.doc_id: r.copies for r in mix_sources(docs).collect()}
    emitted = mixture(docs)
    assert emitted.columns == docs.columns
    counts = {r.doc_id: r["count"] for r in emitted.groupBy("doc_id").count().collect()}
    assert counts == {i: c for i, c in taken.items() if c}


def test_only_built_in_functions(spark):
    docs = table(spark, [(i, f"s{i % 2}", words(i % 5 + 1)) for i in range(60)])
    plan = mix_sources(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
