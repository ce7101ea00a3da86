"""Nearest neighbours against brute force."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from compare import DATA
from tidemark.llm.nn_descent import Settings, nearest_neighbours


def brute(rows, queries, limit):
    rows = {i: np.asarray(v, np.float64) for i, v in rows}
    out = {}
    for q in queries:
        scored = sorted((-float(rows[q] @ v), i) for i, v in rows.items() if i != q)
        out[q] = [(i, -s) for s, i in scored[:limit]]
    return out


def test_recall_at_the_small_scale(spark):
    table = spark.read.parquet(f"{DATA}/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    found = nearest_neighbours(table, F.col("id") % 20 == 0).collect()
    truth = brute(rows, [i for i, _ in rows if i % 20 == 0], 20)
    assert len(found) == 20 * len(truth)
    hits = sum(r.vec_id in {i for i, _ in truth[r.query_id]} for r in found)
    assert hits / len(found) >= 0.9
    vec = dict(rows)
    for r in found:
        assert abs(r.score - float(np.dot(np.float64(vec[r.query_id]), np.float64(vec[r.vec_id])))) < 1e-12


def test_recall_with_many_groups_and_few_neighbours(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(c) for c in rng.normal(size=8)]) for i in range(3000)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    found = nearest_neighbours(table, F.col("id") % 50 == 0, limit=10, settings=Settings(degree=15, group=32, width=40)).collect()
    truth = brute(rows, range(0, 3000, 50), 10)
    assert sum(r.vec_id in {i for i, _ in truth[r.query_id]} for r in found) / (10 * len(truth)) >= 0.9


def test_odd_vectors_copies_and_ties(spark):
    rng = np.random.default_rng(5)
    good = [(i, [float(c) for c in rng.normal(size=4)]) for i in range(60)]
    good += [(100 + i, good[7][1]) for i in range(45)] + [(200, [1e9, 0.0, 0.0, 0.0])]
    nan, inf = float("nan"), float("inf")
    bad = [(300, None), (320, [0.0] * 4), (340, [1.0, None, 1.0, 1.0]), (360, [nan] * 4), (380, [inf, 1.0, 1.0, 1.0]), (400, [1.0]), (420, []), (None, [1.0] * 4)]
    table = spark.createDataFrame([(i, v, "clash", 1) for i, v in good + bad + good[:3]], "vec_id long, embedding array<double>, vec string, node int")
    found = nearest_neighbours(table, F.col("id") % 20 == 0).collect()
    truth = brute(good, [i for i, _ in good if i % 20 == 0], 20)
    by_query = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        by_query.setdefault(r.query_id, []).append(r.vec_id)
    assert by_query.keys() == truth.keys()
    for q, ids in by_query.items():
        assert ids == [i for i, _ in truth[q]], q


def test_few_rows(spark):
    table = spark.createDataFrame([(0, [1.0, 2.0]), (20, [1.0, 2.0]), (3, [2.0, 1.0])], "vec_id long, embedding array<double>")
    found = {(r.query_id, r["rank"], r.vec_id, r.score) for r in nearest_neighbours(table, F.col("id") % 20 == 0).collect()}
    assert found == {(0, 1, 20, 5.0), (0, 2, 3, 4.0), (20, 1, 0, 5.0), (20, 2, 3, 4.0)}
    assert nearest_neighbours(table.where("vec_id = 0"), F.col("id") % 20 == 0).count() == 0
    assert nearest_neighbours(table.where("vec_id < 0"), F.col("id") % 20 == 0).count() == 0
