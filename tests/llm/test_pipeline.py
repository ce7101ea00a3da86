"""The pipeline's stages, each against what its operator or brute force says of its input."""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from compare import DATA
from test_shingle_join import brute
from tidemark.llm.bitmaps import left_over
from tidemark.llm.packing import best_fit_packing
from tidemark.llm.queries import byte_bpe_encoder, toxicity_machine
from tidemark.llm.scratch import Scratch
from tidemark.llm.secrets import RULES
from tidemark.llm.toxicity import score_toxicity

SF = f"{DATA}/sf0.01"


@pytest.fixture(scope="module")
def kept(spark):
    """The rows after each stage, by its name."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    out["documents"] = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, SF).collect()
        out[name] = rows
        docs = spark.createDataFrame(rows, docs.schema) if name != "packing" else None
    return out


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def test_stages_and_columns(kept):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "secret_scan", "packing"]
    for name in ("toxicity", "exact_dedup", "near_dedup", "secret_scan"):
        assert kept[name][0].__fields__ == kept["documents"][0].__fields__


def test_toxic_documents_go_and_no_others(spark, kept):
    docs = spark.createDataFrame(kept["documents"])
    scores = {r.doc_id: r.score for r in score_toxicity(docs, toxicity_machine(spark, SF)).collect()}
    assert kept["toxicity"] == [r for r in kept["documents"] if scores[r.doc_id] < 0.5]


def test_last_of_equal_texts_stays(kept):
    last = {}
    for r in kept["toxicity"]:
        last[low(r.text)] = max(r.doc_id, last.get(low(r.text), -1))
    assert {r.doc_id for r in kept["exact_dedup"]} == set(last.values())


def test_one_of_each_group_of_near_copies_stays(kept):
    component = brute([(r.doc_id, r.text) for r in kept["exact_dedup"]])
    assert {r.doc_id for r in kept["near_dedup"]} == set(component.values())


def test_secrets_are_masked_and_nothing_else(kept):
    before = {r.doc_id: r for r in kept["near_dedup"]}
    changed = 0
    for r in kept["secret_scan"]:
        parts = r.text.split(corpus_pipeline.MASK)
        assert len(parts) > 1 or r == before[r.doc_id]
        assert re.fullmatch(".*?".join(map(re.escape, parts)), before[r.doc_id].text, re.S)
        changed += len(parts) > 1
    assert changed and len(kept["secret_scan"]) == len(before)
    assert not any(re.search(RULES[2].pattern, r.text) for r in kept["secret_scan"])


def test_all_that_is_left_is_packed(spark, kept):
    pieces = defaultdict(list)
    for r in kept["packing"]:
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    plain = defaultdict(list)
    docs = spark.createDataFrame(kept["secret_scan"])
    for r in best_fit_packing(docs, byte_bpe_encoder()).collect():
        plain[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in plain.items()}


def test_written_ids_rebuild_the_masked_texts(kept):
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = defaultdict(list)
    for r in kept["packing"]:
        pieces[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    rebuilt = {k: [i for _, ids in sorted(v) for i in ids] for k, v in pieces.items()}
    assert rebuilt == {r.doc_id: [*reference.encode(r.text or "", add_special_tokens=False).ids, 2] for r in kept["secret_scan"]}


def test_overlapping_spans_make_one_mask(spark):
    docs = spark.createDataFrame([(1, "é token=" + "a1" * 20 + " z"), (2, None), (3, "")], "doc_id long, text string")
    out = {r.doc_id: r.text for r in corpus_pipeline.secret_scan(spark, docs, SF).collect()}
    assert out == {1: "é [secret] z", 2: None, 3: ""}


def test_odd_rows_pass_all_stages(spark):
    rows = [(None, "some text"), (None, None), (1, None), (2, ""), (3, "same"), (3, "same"), (4, "SAME")]
    docs = spark.createDataFrame([(i, t, None, None, None, "clash", 0.1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, secrets string, score double")
    for _, stage in corpus_pipeline.STAGES[1:]:
        before, docs = docs, stage(spark, docs, SF)
        assert docs.count() <= before.count() or "piece" in docs.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in docs.collect()) == [(False, 2), (False, 4), (True, None)]


def test_rows_are_judged_by_their_text_and_not_by_their_id_alone(spark):
    """Repeated and null ids: no unique text is lost, and one of full copies stays."""
    words = [f"w{i}" for i in range(60)]
    near = " ".join(words), " ".join([*words[:-1], "other"])
    rows = [(1, "same text"), (2, "SAME text"), (1, "a unique clean text"), (5, "copy"), (5, "copy"), (5, "Copy"), (None, "n"), (None, "n")]
    rows += [(9, "largest"), (9, "another of nine"), (7, "Largest"), (None, "largest")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = sorted(((r.doc_id or 0), r.text.lower()) for r in corpus_pipeline.exact_dedup(spark, docs, SF).collect())
    assert left == [(0, "n"), (1, "a unique clean text"), (2, "same text"), (5, "copy"), (9, "another of nine"), (9, "largest")]
    docs = spark.createDataFrame([(0, near[0]), (3, near[1]), (3, "quite another text"), (None, near[0] + " x"), (None, "alone")], "doc_id long, text string")
    left = sorted((str(r.doc_id), r.text) for r in corpus_pipeline.near_dedup(spark, docs, SF).collect())
    assert left == [("0", near[0]), ("3", "quite another text"), ("None", "alone")]


@pytest.mark.parametrize("bits", [1 << 15, 1 << 25])
def test_rows_left_over(spark, bits):
    """What is gone goes and nothing else, with bits set by chance, null and repeated keys; the
    joins with all columns get few rows."""
    rows = [(i % 9000 or None, str(i % 7), "t" * 50) for i in range(20000)]
    df = spark.createDataFrame(rows, "k long, s string, text string")
    gone = {r[:2] for i, r in enumerate(rows) if i % 10 == 0}
    scratch = Scratch(spark, "left-over")
    sure, doubtful = left_over(df, scratch.store(spark.createDataFrame(sorted(gone, key=str), "k long, s string"), "gone"), scratch, bits)
    expected = sorted((r for r in rows if r[:2] not in gone), key=str)
    assert sorted(map(tuple, sure.unionByName(doubtful).collect()), key=str) == expected
    assert doubtful.count() < (5000 if bits == 1 << 15 else 100)


def test_texts_of_exact_copies_are_not_shuffled(spark):
    rows = [(i, f"text {i % 900} " + "word " * 30) for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = corpus_pipeline.exact_dedup(spark, docs, SF)
    assert sorted(r.doc_id for r in left.collect()) == list(range(100, 1000))
    plan = left._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" not in plan and plan.count("LeftAnti") == 1
