"""SentencePiece lattice: best paths by brute force, exact round trips."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from compare import DATA
from tidemark.llm import lattice
from tidemark.llm.lattice import MARK, Vocabulary, _words_of, decode, encode_documents, encode_vocabulary, read_vocabulary, segment, segment_words, split_words, word_counts
from tidemark.llm.queries import QUERIES, op5_sentencepiece
from tidemark.llm.scratch import Scratch

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [(1, None), (2, ""), (3, " "), (4, "  a   b \n\t c  "), (5, "日本語 😀 z\x00\x85"), (6, "x" * 3000 + " " * 50 + "é" * 200), (6, "Hello world"), (None, "Hello world")]


@pytest.fixture(scope="module")
def vocabulary():
    return read_vocabulary(MODEL)


def every_path(word, v):
    """(-pieces, score) of the best of all paths, by recursion."""
    best = {len(word): (0, 0.0)}
    for at in reversed(range(len(word))):
        options = []
        for to in range(at + 1, len(word) + 1):
            p = v.pieces.get(word[at:to])
            if p:
                options.append((best[to][0] - 1, best[to][1] + p[1]))
            elif to == at + 1:
                options.append((best[to][0] - len(word[at].encode()), best[to][1]))
        best[at] = max(options)
    return best[0]


def value(ids, v):
    score = {i: s for i, s in v.pieces.values()}
    return -len(ids), sum(score.get(i, 0.0) for i in ids)


def test_words_have_best_paths(spark, vocabulary):
    found = op5_sentencepiece(spark, f"{DATA}/sf0.001").collect()
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").collect()
    assert sum(r.n for r in found) == sum(len([w for w in (" " + d.text).replace("  ", " ").split(" ")]) - 1 for d in docs)
    for r in found:
        ids = [int(i) for i in r.ids.split(" ")]
        best = every_path(r.word, vocabulary)
        assert value(ids, vocabulary) == pytest.approx(best) and r.n_ids == len(ids)
        assert r.decoded == r.word.replace(MARK, " ", 1).replace(MARK, " ").removeprefix(" ")


def test_long_words_take_the_same_path(spark, vocabulary):
    words = spark.createDataFrame([(MARK + w,) for w in ("internationalization", "日本語のéx", "a" * 40)], "word string")
    folded = {r.word: list(r.ids) for r in segment_words(words, vocabulary).collect()}
    worker = {r.word: list(r.ids) for r in segment_words(words, vocabulary, max_chars=0).collect()}
    for w in folded:
        assert value(folded[w], vocabulary) == value(worker[w], vocabulary) == pytest.approx(every_path(w, vocabulary))
    assert len(segment(MARK + "q" * 100_000, vocabulary)) > 1000


def test_ties_are_settled_alike_on_both_paths(spark, vocabulary):
    rng = random.Random(3)
    lines = [MARK + c * 70 for c in "-=*_."] + [MARK + "".join(rng.choices("-=.\n/a日é", k=rng.randint(5, 70))) for _ in range(60)]
    words = spark.createDataFrame([(w,) for w in set(lines)], "word string")
    folded = {r.word: list(r.ids) for r in segment_words(words, vocabulary, max_chars=100).collect()}
    assert folded == {w: segment(w, vocabulary) for w in lines}


def test_round_trip_of_documents(spark, vocabulary):
    whole = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(i, t, "clash", [1]) for i, t in ODD], "doc_id long, text string, word string, ids array<int>")
    for docs in (whole, odd):
        texts = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in docs.collect())
        back = decode(encode_documents(docs, vocabulary), vocabulary).collect()
        assert sorted((r.doc_id is None, r.doc_id or 0, r.decoded) for r in back) == texts
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for r in decode(encode_documents(odd, vocabulary), vocabulary).where("doc_id > 3").collect():
        assert model.decode(list(r.ids)) == r.decoded


def test_the_query_encodes_and_decodes_every_document(spark, vocabulary):
    found = {r.doc_id: r for r in QUERIES["op5_sentencepiece"](spark, f"{DATA}/sf0.001").collect()}
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").select("doc_id", "text").collect()
    ids_of = {r.word: r.ids.split(" ") for r in op5_sentencepiece(spark, f"{DATA}/sf0.001").collect()}
    assert sorted(found) == sorted(d.doc_id for d in docs)
    md5 = lambda text: hashlib.md5(text.encode()).hexdigest()
    for d in docs:
        ids = [i for w in _words_of(d.text or "") for i in ids_of[w]]
        assert tuple(found[d.doc_id])[1:] == (len(ids), md5(" ".join(ids)), md5(d.text or ""))


def test_rare_words_come_back_to_their_places(spark, vocabulary):
    texts = ["b a b  c a", None, "", "zz zz zz", "a" * 200 + " a", "▁x▁ y", " \n é"]
    docs = spark.createDataFrame([(n % 3 or None, t) for n, t in enumerate(texts * 2)], "doc_id long, text string")
    split = {r.text: list(r.words) for r in docs.where("text is not null").select("text", split_words(F.col("text")).alias("words")).collect()}
    assert split == {t: _words_of(t) for t in texts if t is not None}
    whole = sorted((str(n % 3 or None), [i for w in _words_of(t or "") for i in ids_of_word(w, vocabulary, spark)]) for n, t in enumerate(texts * 2))
    for frequent in (0, 2, 1000):
        found = encode_documents(docs, vocabulary, frequent=frequent).collect()
        assert sorted((str(r.doc_id), list(r.ids)) for r in found) == whole


def ids_of_word(word, vocabulary, spark, seen={}):  # noqa: B006
    if word not in seen:
        seen[word] = list(segment_words(spark.createDataFrame([(word,)], "word string"), vocabulary).first().ids)
    return seen[word]


def test_workers_pass_counts_on_before_they_hold_too_many(spark, vocabulary, monkeypatch):
    texts = [f"alpha beta. word{n} word{n},rest" for n in range(2000)] + [None, ""]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    sent, rows = [], docs.select(F.coalesce("text", F.lit("")).alias("text"))

    class Spy:
        def select(self, *_):
            return self

        def mapInArrow(self, run, schema):
            sent.extend(b.num_rows for b in run(iter(rows.toArrow().combine_chunks().to_batches())))
            return rows.mapInArrow(run, schema)

    monkeypatch.setattr(lattice, "COUNTED_WORDS", 200, raising=False)
    for units in (None, vocabulary.units):
        sent.clear()
        found = {r.word: r.n for r in word_counts(Spy(), units=units).collect()}
        cut = re.compile(units).findall if units else lambda w: [w]
        assert found == Counter(u for t in texts for w in _words_of(t or "") for u in cut(w))
        assert len(sent) > 3


def test_settings_of_the_session_come_back(spark, vocabulary):
    seen, before = [], spark.conf.get(lattice.BATCH)
    docs = spark.createDataFrame([(1, "alpha beta")], "doc_id long, text string")
    store = Scratch.store
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(Scratch, "store", lambda self, df, name: seen.append(int(spark.conf.get(lattice.BATCH))) or store(self, df, name))
        encode_documents(docs, vocabulary)
    assert seen == [1000] * 3 and spark.conf.get(lattice.BATCH) == before


def test_empty_table(spark, vocabulary):
    nothing = spark.createDataFrame([], "doc_id long, text string")
    assert encode_documents(nothing, vocabulary).count() == 0
    assert encode_vocabulary(nothing, vocabulary).count() == 0


def test_units_of_a_word_have_its_ids(vocabulary):
    rng = random.Random(5)
    cut = re.compile(vocabulary.units).findall
    words = [MARK * rng.randint(1, 3) + "".join(rng.choices("theinrs.,-=\n'/\x00Жaд日é😀12", k=rng.randint(1, 30))) for _ in range(2000)]
    words += [MARK + "end.\nStart", MARK + 'say("a");\r', MARK * 5, MARK + "─" * 9 + "x"]
    for word in words:
        units = cut(word)
        assert "".join(units) == word and all(cut(u) == [u] for u in units)
        assert [i for u in units for i in segment(u, vocabulary)] == segment(word, vocabulary)
    assert cut(MARK + "end.\nStart") == [MARK + "end", ".", "\n", "Start"]
    inexact = Vocabulary({**vocabulary.pieces, "zzz": (1, 0.1)}, vocabulary.bytes_from)
    assert inexact.units is None  # sums over units could round otherwise


def test_only_packed_rows_and_ids_are_shuffled_at_the_end(spark, vocabulary):
    docs = spark.createDataFrame([(n % 7, f"alpha beta. word{n % 5},\nrest  {'q' * (n % 90)}") for n in range(60)], "doc_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        encoded = encode_documents(docs, vocabulary, frequent=3)
        found = sorted((r.doc_id, list(r.ids)) for r in encoded.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found == sorted((d.doc_id, [i for w in _words_of(d.text) for i in segment(w, vocabulary)]) for d in docs.collect())
    plan = encoded._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning(row") == plan.count("Exchange hashpartitioning") == 2
