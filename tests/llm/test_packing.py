"""Packing: every id once and in order, sequences without gaps, few of them."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from compare import DATA
from tidemark.llm.packing import best_fit, best_fit_packing, local_search, pack
from tidemark.llm.queries import byte_bpe_encoder


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(rows, found, reference, capacity, slack=1.02):
    expected = sorted([*reference.encode(t or "", add_special_tokens=False).ids, 2] for _, t in rows)
    by_seq = defaultdict(list)
    for r in found:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length <= capacity and zlib.crc32(r.ids) == r.ids_crc32
        by_seq[r.sequence_id].append((r.offset, r.length))
    for spans in by_seq.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    docs = defaultdict(list)
    for r in found:
        docs[r.doc_id].append(r)
    rebuilt = []
    for parts in docs.values():
        parts.sort(key=lambda r: (r.piece, r.start))
        if len([p for p in parts if p.piece == 0]) == 1:
            ids, at = [], 0
            for n, p in enumerate(parts):
                assert (p.piece, p.start) == (n, at) and (n == 0 or p.length == capacity)
                ids += np.frombuffer(p.ids, "<u4").tolist()
                at += p.length
            rebuilt.append(ids)
    assert all(ids in expected for ids in rebuilt)
    total = sum(r.length for r in found)
    assert total == sum(map(len, expected))
    assert len(by_seq) <= max(-(-total // capacity) * slack, -(-total // capacity) + 1)


def test_documents_at_the_smallest_scale(spark, reference):
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    check(rows, best_fit_packing(docs, byte_bpe_encoder()).collect(), reference, 1024)
    check(rows, best_fit_packing(docs, byte_bpe_encoder(), block_pieces=30).collect(), reference, 1024, slack=1.1)


def test_odd_texts(spark, reference):
    rows = [(0, None), (1, ""), (2, " "), (3, "a  b   c \n\n d\t e "), (4, "x<|endoftext|>y"), (5, "日本語 العربية 😀 z\x85\x1c"),
            (6, "It's they'll WE'VE 12345 --- ***"), (7, "é" * 5000), (None, "null id"), (8, "same"), (8, "same"), (8, "other")]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, uid int, block string")
    found = best_fit_packing(docs, byte_bpe_encoder(), capacity=16).collect()
    check(rows, found, reference, 16, slack=1.1)
    assert best_fit_packing(docs.where("doc_id > 99"), byte_bpe_encoder()).count() == 0


def test_local_search_empties_bins_that_best_fit_leaves():
    sizes = np.array([6, 6, 5, 5, 4, 4, 3, 3, 2, 2] * 4 + [7, 3, 1, 1, 1, 1, 6])
    bins = [[i] for i in range(len(sizes))]
    squared = lambda bins: sum(sum(int(sizes[i]) for i in b) ** 2 for b in bins)
    after = local_search(bins, sizes.tolist(), 10)
    assert sorted(i for b in after for i in b) == list(range(len(sizes)))
    assert squared(after) > squared(bins) and len(after) == -(-sizes.sum() // 10)


def test_two_for_one_exchange():
    # 6+3 and 5+4+... only fills up by giving 3 for 2+2
    sizes = [6, 3, 2, 2, 4]
    after = local_search([[0, 1], [2, 3, 4]], sizes, 10)
    assert sorted(sum(sizes[i] for i in b) for b in after) == [7, 10]


def test_pack_is_near_the_bound():
    rng = random.Random(2)
    sizes = np.array([rng.randrange(1, 1024) for _ in range(3000)])
    bins = pack(sizes, 1024)
    assert sorted(i for b in bins for i in b) == list(range(3000))
    assert len(bins) <= len(best_fit(sizes, 1024))
    assert all(sizes[b].sum() <= 1024 for b in map(np.array, bins))


def test_full_blocks_are_searched_to_the_end():
    rng = random.Random(5)
    for least, most in ((300, 700), (200, 500)):
        sizes = np.array([rng.randint(least, most) for _ in range(8192)])
        first, bins = best_fit(sizes, 1024), pack(sizes, 1024)
        assert sorted(i for b in bins for i in b) == list(range(8192))
        assert all(sizes[b].sum() <= 1024 for b in bins)
        spread = lambda bins: sum(int(sizes[b].sum()) ** 2 for b in bins)
        assert len(bins) <= len(first) and spread(bins) > spread(first)
        if most == 500:
            assert len(bins) < len(first) - 50  # 60,000 pairs of bins save 18
        under = sorted((b for b in bins if sizes[b].sum() < 1024), key=lambda b: sizes[b].sum())
        one = [sorted({0, *sizes[b].tolist()}) for b in under]
        two = [sorted({int(sizes[i] + sizes[j]) for n, i in enumerate(b) for j in b[:n]}) for b in under]
        room = [1024 - int(sizes[b].sum()) for b in under]
        for x in range(len(under)):
            for y in range(x):  # the emptier bin
                for gives, takes in ((one[x], one[y]), (one[x][1:], two[y]), (two[x], one[y])):
                    assert not any(0 < t - g <= room[x] for g in gives for t in takes)


def test_rounds_go_on_while_they_save_sequences(spark):
    rng = random.Random(7)
    words = [(i, " a" * rng.randint(199, 499)) for i in range(600)]
    docs = spark.createDataFrame(words, "doc_id long, text string").repartition(4)
    found = best_fit_packing(docs, byte_bpe_encoder(), block_pieces=100, keep_ids=False).collect()
    fills = defaultdict(int)
    for r in found:
        fills[r.sequence_id] += r.length
    assert len(found) == 600 and max(fills.values()) <= 1024
    assert len(fills) <= len(best_fit(np.array([r.length for r in found]), 1024))
