"""Fill-in-middle against a plain cut of the text."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from compare import DATA
from tidemark.llm.fill_middle import Units, fill_in_middle, restored

ODD = "doc_id long, text string, n int, form int, output string, _text string, row int"


def brute(doc_id, text, seed=1):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def found(df):
    return [(r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in df.collect()]


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    cut = fill_in_middle(docs)
    truth = {r.doc_id: brute(r.doc_id, r.text) for r in docs.collect()}
    assert {r.doc_id: (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in cut.collect()} == truth
    assert {"plain", "spm", "psm"} == {t[1] for t in truth.values()}
    back = cut.withColumn("back", restored(F.col("output"), F.col("form"))).join(docs, "doc_id")
    assert back.where(F.col("back") != F.coalesce("text", F.lit(""))).count() == 0


def test_odd_rows(spark):
    texts = ["", None, "a", "a\nb\r\n c", "\U0001f600é\x00x", "has <S> in it", "<<P", "S><M", "$1\\E" * 9, "x" * 300_000]
    data = [(i, t, 1, 2, "o", "t", 3) for i, t in enumerate(texts * 8)] + [(None, "no id", 0, 0, "", "", 0)] * 2
    docs = spark.createDataFrame(data, ODD)
    cut = fill_in_middle(docs, keep=docs.columns)
    assert sorted(found(cut), key=str) == sorted([brute(r[0], r[1]) for r in data], key=str)
    back = cut.where(restored(F.col("output"), F.col("form")) != F.coalesce("row.text", F.lit("")))
    assert back.count() == 0 and cut.where("row.row IS NULL").count() == 0
    assert fill_in_middle(docs.limit(0)).count() == 0


def test_other_units_and_seeds(spark):
    docs = spark.createDataFrame([(i, "one two  three\nfour" * (i % 4 + 1)) for i in range(60)], "doc_id long, text string")
    words = fill_in_middle(docs, seed=7, unit=r"\s*\S+", plain_percent=0, spm_percent=100, keep=["text"])
    for r in words.collect():
        text, middle_at = r["row"]["text"], r.prefix_chars + r.middle_chars
        assert r.form == "spm" and r.n == len(text.split())
        for at in (r.prefix_chars, middle_at):
            assert at in (0, len(text)) or not text[at - 1].isspace() and text[at].isspace()
    uncovered = fill_in_middle(docs, unit="[a-z]", plain_percent=0).collect()
    assert {(r.n, r.form) for r in uncovered} == {(None, "plain")}
    with pytest.raises(ValueError, match="empty"):
        Units("a*")


@pytest.mark.parametrize("unit", [".", r"\w+|\W", "ab?"])
def test_stretches_give_the_same_ends(unit):
    text = "ab a\nab" * 50 if unit != "ab?" else "aab" * 80
    assert list(Units(unit, 7).ends(text)) == list(Units(unit).ends(text))
    assert Units("[^b]", 7).ends("aaaaaaaaaaaaaaab") is None


def test_more_units_than_the_library_can_hold():
    assert Units(".").cuts("é" * 9_000_000, 4_500_000, 9_000_000) == (9_000_000, 4_500_000, 9_000_000)
