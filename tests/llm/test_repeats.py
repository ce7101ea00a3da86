"""Removal of repeated word sequences against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

from compare import DATA
from tidemark.llm.repeats import kept_digest, remove_repeats


def brute(rows, window):
    texts = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (i, _), words in zip(rows, texts):
        gone = set()
        for s in range(len(words) - window + 1):
            if seen[tuple(words[s : s + window])] > 1:
                gone.update(range(s, s + window))
        kept = " ".join(w for j, w in enumerate(words) if j not in gone)
        out.append((i is None, i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def check(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, uid int, marks string")
    found = kept_digest(remove_repeats(docs, **options)).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found) == brute(rows, options.get("window", 35))


def test_documents_at_the_smallest_scale(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    check(spark, rows)


def test_overlaps_branches_and_repeats(spark):
    rng = random.Random(3)
    parts = [[rng.choice("abcdefgh") + rng.choice("éxyz") for _ in range(rng.randrange(3, 40))] for _ in range(12)]
    rows = [(0, None), (1, ""), (2, " \n "), (3, "a " * 100), (4, "a b " * 60), (5, " x " * 9)]
    for _ in range(60):
        text = [w for _ in range(rng.randrange(1, 6)) for w in rng.choice(parts)]
        if rng.random() < 0.5:
            text[rng.randrange(len(text))] = "Z" + str(rng.randrange(9))
        rows.append((len(rows), rng.choice([" ", "\t", "\n"]).join(text)))
    rows += [rows[20], rows[20], (None, rows[30][1]), (7, rows[9][1])]
    check(spark, rows, window=12, anchor=3)
    check(spark, rows, window=12, anchor=12)
    check(spark, rows)


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
