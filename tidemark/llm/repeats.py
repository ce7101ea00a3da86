"""Removal of word sequences that repeat anywhere, by compaction of a De Bruijn graph.

Edges are token k-mers: the windows of ``window`` consecutive words. Writing every edge out
would cost a row per word. Each window has a minimiser, its ``anchor`` consecutive words of
the smallest hash, and that depends on the window alone. Consecutive windows with one
minimiser are a nonbranching stretch of the text's path; they are compacted to one row, the
hash of the whole stretch. All equal windows have equal minimisers, so:

1. stretches are counted by minimiser; one that occurs once has no repeated window;
2. stretches that occur twice or more are repeated in full, all their windows with them;
3. where a minimiser has different stretches, the path branches: one source coordinate of
   each is gone back to, its single windows are hashed, and those that another stretch
   holds, or that its own stretch repeats, are joined back as repeated.

The windows so found are laid over the texts, and each word that one covers goes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bitmaps import bitmap_of, with_flag
from tidemark.llm.scratch import Scratch
from tidemark.llm.words import BASES, Prefixes, WordHashes, mixed, windows, words_of

STRETCH_TYPE = "uid long, anchor long, h1 long, h2 long, start int, many int"


def stretches(hashes: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Minimiser, two hashes, first window and number of windows of each stretch."""
    n = len(hashes) - window + 1
    if n <= 0:
        empty = np.empty(0, np.uint64)
        return empty, empty, empty, np.empty(0, np.int32), np.empty(0, np.int32)
    marks, span = windows(hashes, anchor), window - anchor + 1
    # leftmost smallest of each ``span`` marks, by doubling
    best, width = np.arange(len(marks)), 1
    while width < span:
        step = min(width, span - width)
        left, right = best[:-step], best[step:]
        best = np.where(marks[right] < marks[left], right, left)
        width += step
    first = np.concatenate(([0], np.flatnonzero(best[1:] != best[:-1]) + 1))
    many = np.diff(np.append(first, n))
    end = first + many + window - 1
    h1, h2 = (Prefixes(hashes, base).stretch(first, end) for base in BASES)
    return marks[best[first]], h1, h2, first.astype(np.int32), many.astype(np.int32)


def _ints(array: np.ndarray) -> pa.Array:
    return pa.array(array.view(np.int64))


def _stretch_rows(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                uids = part.column(0).to_numpy()
                found = [stretches(known.of(words_of(t)), window, anchor) for t in part.column(1).to_pylist()]
                uid = np.repeat(uids, [len(f[0]) for f in found])
                a, h1, h2, start, many = (np.concatenate([f[i] for f in found]) for i in range(5))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uid), _ints(a), _ints(h1), _ints(h2), pa.array(start), pa.array(many)],
                    ["uid", "anchor", "h1", "h2", "start", "many"],
                )

    return docs.mapInArrow(run, STRETCH_TYPE)


def _window_rows(texts: DataFrame, window: int) -> DataFrame:
    """The windows of the stretches listed with each text, each with its own hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part, found = batch.slice(lo, 200), []
                for uid, text, listed in zip(*(c.to_pylist() for c in part.columns)):
                    hashes = known.of(words_of(text))
                    start, many, copies = (np.array([s[k] for s in listed], np.int64) for k in ("start", "many", "copies"))
                    at = np.repeat(start - np.cumsum(many) + many, many) + np.arange(many.sum())
                    h1, h2 = (Prefixes(hashes, base).stretch(at, at + window) for base in BASES)
                    found.append((np.full(len(at), uid, np.int64), at.astype(np.int32), h1, h2, np.repeat(copies, many)))
                uid, at, h1, h2, copies = (np.concatenate([f[i] for f in found]) for i in range(5))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uid), pa.array(at), _ints(h1), _ints(h2), pa.array(copies)], ["uid", "start", "h1", "h2", "copies"]
                )

    return texts.mapInArrow(run, "uid long, start int, h1 long, h2 long, copies long")


def _clean(rows: DataFrame, window: int, id_type: str) -> DataFrame:
    """Lays the windows over each text: the words counted, and those kept joined by a space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, marks = batch.columns
            total, removed, kept = [], [], []
            for i in range(batch.num_rows):
                words = words_of(texts[i].as_py())
                gone = np.zeros(len(words) + 1, np.int32)
                for s in marks[i].as_py() or ():
                    gone[s["start"]] += 1
                    gone[s["start"] + s["many"] + window - 1] -= 1
                covered = np.cumsum(gone[:-1]) > 0
                lost = int(covered.sum())
                if lost:
                    words = [words[j] for j in np.flatnonzero(~covered)]
                total.append(len(covered))
                removed.append(lost)
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                ["id", "n_words", "n_removed", "kept"],
            )

    return rows.mapInArrow(run, f"id {id_type}, n_words long, n_removed long, kept string")


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35, anchor: int = 8
) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_words``, ``n_removed`` and ``kept``, a text.

    Words are runs of anything but ASCII white space. A word goes if a window of ``window``
    consecutive words of its text covers it whose sequence starts in a second place, in any
    row, the same one included. ``kept`` joins the words that stay by one space. A null text
    has no words. Every row is a text of its own, so repeated rows repeat each other; ids may
    be null or repeat, other columns make no difference, an empty table gives none.
    """
    scratch = Scratch(docs.sparkSession, "repeats")
    key = F.xxhash64("id", "text")  # rows that are equal in both share their windows' places
    lean = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("uid", key)
    found = scratch.store(_stretch_rows(lean.select("uid", "text"), window, anchor), "stretches")

    again = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    again = scratch.store(again, "anchors")  # tables on both sides: AQE can split a frequent anchor
    found = scratch.store(found.join(again, "anchor", "left_semi"), "again")
    scratch.drop("stretches")
    place = F.struct("uid", "start", "many")
    distinct = found.groupBy("anchor", "h1", "h2").agg(F.count(F.lit(1)).alias("copies"), F.min(place).alias("place"))
    distinct = scratch.store(distinct, "distinct")

    repeated = distinct.where("copies > 1").select("anchor", "h1", "h2")
    whole = found.join(repeated, ["anchor", "h1", "h2"], "left_semi").select("uid", "start", "many")

    forks = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    open_ones = distinct.join(scratch.store(forks, "forks"), "anchor", "left_semi").select("place.*", "copies")
    by_text = open_ones.groupBy("uid").agg(F.collect_list(F.struct("start", "many", "copies")).alias("listed"))
    by_text = scratch.store(by_text, "to-verify")
    marked = scratch.store(bitmap_of(by_text.select("uid")), "texts-to-verify")
    texts = with_flag(lean, marked, [F.col("uid")], "_open").where("_open").select("uid", "text").dropDuplicates(["uid"])
    single = scratch.store(_window_rows(texts.join(by_text, "uid"), window), "windows")
    twice = single.groupBy("h1", "h2").agg(F.sum("copies").alias("n")).where("n > 1").select("h1", "h2")
    parts = single.where("copies = 1").join(scratch.store(twice, "twice"), ["h1", "h2"], "left_semi")
    parts = parts.select("uid", "start", F.lit(1).alias("many"))

    marks = whole.unionByName(parts).groupBy("uid").agg(F.collect_set(F.struct("start", "many")).alias("marks"))
    marks = scratch.store(marks, "marks")
    touched = with_flag(lean, scratch.store(bitmap_of(marks.select("uid")), "touched"), [F.col("uid")], "_touched")
    laid = touched.where("_touched").join(marks, "uid", "left").select("id", "text", "marks")
    as_it_is = touched.where("not _touched").select("id", "text", F.lit(None).cast(marks.schema["marks"].dataType).alias("marks"))
    kind = lean.schema["id"].dataType.simpleString()
    return _clean(laid, window, kind).unionByName(_clean(as_it_is, window, kind)).withColumnRenamed("id", id_col)


def kept_digest(result: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return result.select(id_col, "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
