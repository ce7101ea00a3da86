"""Hard negatives against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import DATA
from tidemark.llm.hard_negatives import Chunk, Settings, mine_hard_negatives

SCHEMA = "vec_id long, label int, embedding array<double>"
SMALL = Settings(chunk_cells=600, batch=3, segments=3, growth=2)


def brute(rows, anchors, positives=5, negatives=10, low=30, high=90):
    """``rows``: id -> (label, list of whole numbers)."""
    out = set()
    for a in anchors:
        label, q = rows[a]
        scored = sorted((-sum(x * y for x, y in zip(q, v)), i, other == label) for i, (other, v) in rows.items() if i != a)
        for minus_p, pid, _ in [s for s in scored if s[2]][:positives]:
            p = -minus_p
            inside = [(i, -s) for s, i, same in scored if not same and low * p <= -100 * s <= high * p]
            out |= {(a, pid, n, i, p, s) for n, (i, s) in enumerate(inside[:negatives], 1)}
    return out


def whole(vector, scale=256):
    return [int(np.floor(scale * x)) for x in vector]


def as_set(df):
    found = [tuple(r) for r in df.collect()]
    assert len(found) == len(set(found))
    return set(found)


@pytest.mark.parametrize("settings", [Settings(), Settings(chunk_cells=5000, batch=2, growth=1)])
def test_whole_table(spark, settings):
    table = spark.read.parquet(f"{DATA}/sf0.01/embeddings.parquet")
    rows = {r.vec_id: (r.label, whole(r.embedding)) for r in table.collect()}
    found = mine_hard_negatives(table, F.col("id") % 100 == 0, settings=settings)
    assert as_set(found) == brute(rows, [i for i in rows if i % 100 == 0])


@pytest.mark.parametrize("seed", range(3))
def test_ties_copies_and_negative_scores(spark, seed):
    rng = np.random.default_rng(seed)
    pool = rng.integers(-3, 4, size=(25, 6))
    rows = {i: (int(rng.integers(0, 3)), [int(c) for c in pool[rng.integers(0, 25)]]) for i in range(400)}
    table = spark.createDataFrame([(i, l, [float(c) for c in v]) for i, (l, v) in rows.items()], SCHEMA)
    found = mine_hard_negatives(table, F.col("id") % 9 == 0, scale=1, settings=SMALL)
    assert as_set(found) == brute(rows, range(0, 400, 9))


def test_scores_beyond_double_precision(spark):
    rng = np.random.default_rng(9)
    rows = {i: (i % 2, [int(c) for c in rng.integers(-(1 << 29), 1 << 29, size=5)]) for i in range(120)}
    table = spark.createDataFrame([(i, l, [float(c) for c in v]) for i, (l, v) in rows.items()], SCHEMA)
    found = mine_hard_negatives(table, F.col("id") % 10 == 0, scale=1, settings=SMALL)
    assert as_set(found) == brute(rows, range(0, 120, 10))


def test_odd_rows(spark):
    good = {i: (i % 2, [1.0 * i, 1.0, -0.5]) for i in range(12)}
    data = [(i, l, v) for i, (l, v) in good.items()] * 2
    data += [(90, None, [1.0] * 3), (91, 1, None), (92, 1, [1.0, None, 0.0]), (93, 1, [1.0, float("nan"), 0.0]), (94, 0, [float("inf"), 0.0, 0.0])]
    data += [(95, 1, [1.0]), (None, 1, [9.0, 9.0, 9.0]), (96, 1, []), (3, 1, [3.0, 1.0, 50.0])]
    table = spark.createDataFrame(data, SCHEMA).withColumns({"id": F.lit("x"), "chunk": F.lit("y"), "vec": F.lit(1), "score": F.lit(0)})
    rows = {i: (l, whole(v)) for i, (l, v) in good.items()}
    found = mine_hard_negatives(table, F.col("id") % 3 == 0, settings=SMALL)
    assert as_set(found) == brute(rows, [0, 3, 6, 9])
    assert mine_hard_negatives(table.limit(0), F.col("id") % 3 == 0).count() == 0
    assert mine_hard_negatives(table.where("vec_id = 0"), F.col("id") % 3 == 0).count() == 0


def test_postings_are_omitted_and_nothing_is_lost():
    """With a high threshold only rows that can reach it are posted; the join stays exact."""
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(500, 32)) * np.linspace(40, 1, 32)).astype(np.int64)
    q = (rng.normal(size=(20, 32)) * np.linspace(40, 1, 32)).astype(np.int64)
    chunk = Chunk(np.arange(500), np.zeros(500, np.int64), x, 8)
    truth = q @ x.T
    for wanted in (np.full(20, 1), truth.max(axis=1), np.full(20, -(10**9)), np.full(20, 10**9)):
        anchor, row, score = chunk.at_least(q, wanted)
        assert set(zip(anchor.tolist(), row.tolist())) == set(zip(*map(np.ndarray.tolist, np.nonzero(truth >= wanted[:, None]))))
        assert (truth[anchor, row] == score).all()
