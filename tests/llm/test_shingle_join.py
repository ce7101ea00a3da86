"""Signatures and linked classes against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from compare import DATA
from tidemark.llm import shingle_join
from tidemark.llm.partenum import PREFIX_BAND, PartEnum
from tidemark.llm.shingle_join import similar_components
from tidemark.llm.words import mixed


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute(rows):
    """Component by id, from all pairs."""
    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if i == j or (a and b and 100 * len(a & b) >= 80 * len(a | b)):
                lo, hi = sorted((root(i), root(j)))
                parent[hi] = lo
    return {i: root(i) for i in parent}


def check(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n int, id string")
    found = similar_components(docs, **options).collect()
    expected = brute(rows)
    assert sorted((r.doc_id is None, r.doc_id, r.n_shingles) for r in found) == sorted((i is None, i, len(shingle_set(t))) for i, t in rows)
    for r in found:
        assert r.component_id == expected.get(r.doc_id), r


def test_documents_at_the_smallest_scale(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    check(spark, rows)


def test_borders_short_texts_and_repeats(spark):
    rng = random.Random(5)
    word = lambda: rng.choice("abcdefghij") + str(rng.randrange(60))
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "One two"), (4, "one TWO"), (5, "one two three"), (6, "Été"), (7, "été"), (8, "one two")]
    for family in range(14):
        base = [word() for _ in range(rng.choice([4, 5, 6, 9, 12, 30, 80, 200, 700]))]
        for copy in range(7):
            text = list(base)
            for _ in range(rng.randrange(0, max(2, len(text) // 20))):
                text[rng.randrange(len(text))] = word()
            if rng.random() < 0.3:
                text += [word() for _ in range(rng.randrange(len(text) // 5 + 1))]
            rows.append((len(rows), rng.choice(["  ", " ", "\n"]).join(text)))
    rows += [rows[20], rows[30], (20, rows[40][1]), (None, rows[20][1]), (1000, rows[12][1])]
    check(spark, rows)


def test_families_around_a_centre(spark):
    """Copies with few to many edits: near, middle and far ones, chains between them."""
    rng = random.Random(11)
    rows = []
    for family in range(3):
        base = [f"w{rng.randrange(5000)}" for _ in range((60, 160, 300)[family])]
        made = [base]
        for copy in range(70):
            text = list(rng.choice(made[-3:] if copy % 3 else made[:1]))
            for _ in range(rng.randrange(0, max(2, len(base) // 25))):
                text[rng.randrange(len(text))] = f"z{rng.randrange(9000)}"
            made.append(text)
        rows += [(1000 * family + i, " ".join(t)) for i, t in enumerate(made)]
    rng.shuffle(rows)
    check(spark, rows)
    assert 3 < len(set(brute(rows).values())) < 200


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert similar_components(docs).count() == 0


@pytest.mark.parametrize("enum", [PartEnum(), PartEnum(cells=3, slack=1), PartEnum(cells=3, slack=2), PartEnum(percent=60)])
def test_similar_sets_share_a_signature(enum):
    rng = np.random.default_rng(1)
    for trial in range(4000):
        n = int(rng.integers(1, 500 if trial % 3 else 14))
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        drop = int(rng.integers(0, n + 1))
        b = np.concatenate((a[drop:], rng.integers(0, 1 << 63, int(rng.integers(0, n // 3 + 2)), dtype=np.uint64)))
        a, b = np.unique(mixed(a)), np.unique(mixed(b))
        same = len(np.intersect1d(a, b))
        similar = same and 100 * same >= enum.percent * (len(a) + len(b) - same)
        if similar:
            x, y = dict(enum.signatures(a)), dict(enum.signatures(b))
            shared = {band: len(np.intersect1d(x[band], y[band])) for band in x.keys() & y.keys()}
            assured = lambda s, z, band: 1 if band == PREFIX_BAND else enum.assured(len(s), len(z[band]))
            assert any(n >= max(assured(a, x, band), assured(b, y, band)) for band, n in shared.items())


def test_far_copies_in_a_family_do_not_meet(spark, monkeypatch):
    """90 copies below the threshold, all with the common text, and links among a few: the
    pairs that are compared grow with the copies, not with their square."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(90):
        text = list(base)
        for at in rng.sample(range(20), 2) + rng.sample(range(60, 200), 4):
            text[at] = f"z{rng.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    rows += [(100 + i, t + " tail") for i, t in rows[:5]]
    compared = []
    whole = shingle_join._compared
    monkeypatch.setattr(shingle_join, "_compared", lambda pairs, *rest: (compared.append(pairs.count()), whole(pairs, *rest))[1])
    check(spark, rows)
    assert len(set(brute(rows).values())) > 40
    assert sum(compared) < 2 * len(rows)


@pytest.mark.parametrize("pairs", [shingle_join.LOOKED_AT, 0])
def test_leaders_follow_while_they_link(spark, monkeypatch, pairs):
    """Chains of copies in which no leader reaches all; strings as ids."""
    monkeypatch.setattr(shingle_join, "LOOKED_AT", pairs)
    rng = random.Random(8)
    rows, text = [], [f"w{i}" for i in range(120)]
    for i in range(60):
        text = list(text)
        text[rng.randrange(120)] = f"z{i}"
        rows.append((f"d{i:02}", " ".join(text)))
    found = similar_components(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    expected = brute(rows)
    assert {r.doc_id: r.component_id for r in found} == expected


def test_front_places():
    """The first common element of similar sets stands near enough to the front of both."""
    enum = PartEnum()
    for n in range(1, 120):
        for m in range(1, 120):
            least = next(c for c in range(n + m + 1) if 100 * c >= 80 * (n + m - c))  # common elements
            if least <= min(n, m):
                assert n - least + 1 <= enum.front(np.array([n]))[0]
