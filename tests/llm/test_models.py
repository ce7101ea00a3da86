"""Toxicity and language: held-out accuracy, and defined results for odd rows."""

from __future__ import annotations

import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import DATA
from tidemark.llm import toxicity
from tidemark.llm.folds import held_out
from tidemark.llm.language import Centroids, draw_texts, identify_languages, learn_languages
from tidemark.llm.queries import op3_toxicity, op8_language_id
from tidemark.llm.scratch import Scratch
from tidemark.llm.toxicity import Settings, fit_machine, learn_toxicity, sample_of, score_toxicity

SF = f"{DATA}/sf0.01"
ODD = [(1, None), (2, ""), (3, " 12 !?"), (4, "\u0000"), (None, "the of and"), (5, "x" * 200_000), (6, "the of and"), (6, "the of and")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "clash", 0.5) for i, t in ODD], "doc_id long, text string, id string, score double")


def test_fold_is_crc32_of_the_id_as_text(spark):
    rows = spark.range(50).select("id", held_out(F.col("id")).alias("h")).collect()
    assert [r.h for r in rows] == [zlib.crc32(str(r.id).encode()) % 5 == 0 for r in rows]


def test_toxicity_on_held_out_documents(spark):
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    found = op3_toxicity(spark, SF).collect()
    assert len(found) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    judged = [(truth[r.doc_id], r.predicted) for r in found if r.held_out and r.doc_id in truth]
    right = np.mean([a == b for a, b in judged])
    caught = [b for a, b in judged if a]
    assert right > 0.95 and np.mean(caught) > 0.6


def test_pairs_count_where_single_terms_do_not():
    """The label is 1 exactly if both or neither of two terms occur: no additive score can say so."""
    rows = [np.array(x) for x in ([0, 2], [1, 2], [0, 1, 2], [2])] * 60
    labels = np.array([0, 0, 1, 1] * 60)
    machine = fit_machine(labels, rows, np.arange(3), Settings(epochs=800))
    scores = [machine.raw(list(r)) for r in rows[:4]]
    assert scores[0] < 0 and scores[1] < 0 and scores[2] > 0 and scores[3] > 0


def test_fit_is_bounded_beside_its_entries(monkeypatch):
    """A passage that many texts hold gives each of them hundreds of terms."""
    rng = np.random.default_rng(1)
    rows = [np.arange(rng.integers(0, 500), dtype=np.int16) for _ in range(4000)]
    labels = rng.integers(0, 2, len(rows))
    tracemalloc.start()
    machine = fit_machine(labels, rows, np.arange(500), Settings(epochs=2))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80e6, f"{peak / 1e6:.0f} MB for {sum(map(len, rows))} entries"
    monkeypatch.setattr(toxicity, "BLOCK", 700)
    other = fit_machine(labels, rows, np.arange(500), Settings(epochs=2))
    assert other.bias == machine.bias
    assert np.array_equal(other.weights, machine.weights) and np.array_equal(other.vectors, machine.vectors)


def test_toxicity_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(6, 1), (7, None), (None, 1)], "doc_id long, toxic int")
    sample = sample_of(labels, odd, held_out(labels.doc_id).isNotNull(), "doc_id", "toxic", "text", 10)
    assert sample.count() == 2
    machine = learn_toxicity(sample.where("label > 5"))  # nothing to learn from
    found = score_toxicity(odd, machine).collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in found) == sorted((i is None, i) for i, _ in ODD)
    assert all(r.score == 0.5 for r in found)
    assert score_toxicity(odd.where("doc_id > 99"), machine).count() == 0


def test_samples_are_bounded_by_rows(spark):
    """An id that repeats, with one text or with many, does not widen a sample."""
    ids = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, toxic int")
    many = spark.range(5000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    same = spark.range(5000).select(F.lit(8).cast("long").alias("doc_id"), F.lit("the same").alias("text"))
    single = spark.range(30).select(F.col("id").alias("doc_id"), F.concat(F.lit("one "), "id").alias("text"))
    docs = many.unionByName(same).unionByName(single)
    for part, bound in ((docs, 10), (docs, 40), (many, 10), (same, 10)):
        assert sample_of(ids, part, F.lit(True), "doc_id", "toxic", "text", bound).count() == bound
    assert sample_of(ids, single, F.lit(True), "doc_id", "toxic", "text", 40).count() == 30
    rows = docs.select(F.when(F.col("doc_id") % 2 == 0, "aa").otherwise("bb").alias("lang"), F.xxhash64("doc_id", "text").alias("order"), "text")
    drawn = draw_texts(rows, 12, Scratch(spark, "drawn-test")).groupBy("lang").count().collect()
    assert {r.lang: r["count"] for r in drawn} == {"aa": 12, "bb": 12}


def test_language_on_held_out_documents(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    found = op8_language_id(spark, SF).collect()
    assert len(found) == 1000
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in found if r.held_out]) > 0.95
    assert np.mean([r.rejected for r in found]) < 0.05


def test_language_of_odd_rows(spark, odd):
    docs = spark.createDataFrame([(i, t, lang) for i in range(20) for lang, t in (("aa", f"the of and {'th' * i}"), ("bb", f"der die das {'sch' * i}"), (None, "xyz"))], "doc_id long, text string, lang string")
    model = learn_languages(docs)
    assert set(model.languages) == {"aa", "bb"}
    found = {(r.doc_id, r.lang_pred, r.rejected) for r in identify_languages(odd, model).collect()}
    assert {(1, "und", False), (2, "und", False), (3, "und", False), (4, "und", False), (None, "aa", False), (6, "aa", False)} <= found
    far = identify_languages(spark.createDataFrame([(1, "日本語の文章です")], "doc_id long, text string"), model).first()
    assert far.rejected and far.lang_pred in ("aa", "bb")
    nothing = Centroids([], np.empty((0, len(model.idf)), np.float32), np.empty(0), model.idf)
    assert identify_languages(odd, nothing).where("lang_pred != 'und'").count() == 0
    assert learn_languages(docs.where("doc_id > 99")).languages == []
