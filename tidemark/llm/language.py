"""Language identification by nearest centroid.

A text is the TF-IDF vector of its character bigrams and trigrams, hashed and normalised.
Each language has several centroids, found by clustering a bounded sample of its texts on
the unit sphere. A text gets the language of the centroid with the largest cosine. One that
is farther from it than nearly all sample texts of that language were is marked as rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch

LETTER = re.compile(r"[^\W\d_]")
NOT_LETTERS = re.compile(r"[\W\d_]+")
UNDETERMINED = "und"
SHARES = 64


@dataclass(frozen=True)
class Settings:
    """``per_language`` bounds the texts of a language that are clustered; document
    frequencies come from all texts that may be learned from."""

    buckets: int = 1 << 13
    per_language: int = 1000
    centroids: int = 4
    rounds: int = 12
    quantile: float = 0.995
    margin: float = 1.25


@dataclass(frozen=True)
class Centroids:
    languages: list[str]
    vectors: np.ndarray  # a row for each centroid, of length 1
    reach: np.ndarray  # smallest cosine that is not rejected
    idf: np.ndarray


def gram_counts(text: str | None, buckets: int) -> np.ndarray | None:
    """Counts of hashed bigrams and trigrams of the letters; None if there is no letter."""
    if not text or not LETTER.search(text):
        return None
    letters = f" {NOT_LETTERS.sub(' ', text.lower()).strip()} "
    codes = np.frombuffer(letters.encode("utf-32-le", "surrogatepass"), np.uint32)
    two = codes[:-1] * np.uint32(2654435761) + codes[1:]
    three = (two[:-1] ^ np.uint32(0x5BD1E995)) * np.uint32(2246822519) + codes[2:]
    out = np.zeros(buckets, np.int64)
    shift = np.uint32(32 - int(np.log2(buckets)))
    for grams in (two, three):
        out += np.bincount((grams * np.uint32(2654435769)) >> shift, minlength=buckets)
    return out


def unit_vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * idf
    norm = np.sqrt(v @ v)
    return (v / norm if norm else v).astype(np.float32)


def _document_frequencies(texts: DataFrame, buckets: int) -> tuple[int, np.ndarray]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, seen = 0, np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts = gram_counts(text, buckets)
                if counts is not None:
                    n += 1
                    seen += counts > 0
        held = np.flatnonzero(seen)
        gram = np.append(held, -1)
        yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(np.append(seen[held], n))], ["gram", "n"])

    sums = texts.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()  # at most buckets + 1
    found = {r.gram: r.n for r in sums}
    return found.pop(-1, 0), np.array([found.get(i, 0) for i in range(buckets)])


def _clustered(settings: Settings, idf: np.ndarray):
    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["order", "text"], ignore_index=True)
        counted = [gram_counts(t, settings.buckets) for t in part["text"]]
        x = np.array([unit_vector(c, idf) for c in counted if c is not None], np.float32).reshape(-1, settings.buckets)
        if not len(x):
            return pd.DataFrame({"lang": [], "vector": [], "reach": []})
        centres = [0]  # farthest point first
        while len(centres) < min(settings.centroids, len(x)):
            centres.append(int(np.argmin((x @ x[centres].T).max(axis=1))))
        c = x[centres]
        for _ in range(settings.rounds):
            own = np.argmax(x @ c.T, axis=1)
            sums = np.array([x[own == k].sum(axis=0) if (own == k).any() else c[k] for k in range(len(c))])
            c = sums / np.linalg.norm(sums, axis=1, keepdims=True)
        near = (x @ c.T).max(axis=1)
        reach = 1 - (1 - np.quantile(near, 1 - settings.quantile)) * settings.margin
        return pd.DataFrame({"lang": [key[0]] * len(c), "vector": [r.astype("<f4").tobytes() for r in c], "reach": [float(reach)] * len(c)})

    return run


def draw_texts(rows: DataFrame, per_language: int, scratch: Scratch) -> DataFrame:
    """At most ``per_language`` rows of each language of ``lang, order, text``: the smallest by ``order``.

    Only hashes are shuffled to draw, the smallest of each of 64 shares of a language first,
    so no task meets a whole language. The broadcast holds at most ``per_language`` rows of
    each. Rows with equal hashes are repeats of one row and are drawn as often as they count.
    """
    hashes = rows.select("lang", "order", F.pmod("order", F.lit(SHARES)).alias("share"))
    place = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy("order"))
    few = hashes.withColumn("_n", place("lang", "share")).where(F.col("_n") <= per_language).drop("_n")
    few = few.withColumn("_n", place("lang")).where(F.col("_n") <= per_language)
    drawn = scratch.store(few.groupBy("lang", "order").agg(F.count(F.lit(1)).alias("take")), "drawn")
    found = rows.join(F.broadcast(drawn), ["lang", "order"]).groupBy("lang", "order", "take").agg(F.first("text").alias("text"))
    return found.select("lang", "order", "text", F.explode(F.sequence(F.lit(1), F.col("take")))).drop("col")


def learn_languages(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", order_col: str = "doc_id", settings: Settings = Settings()
) -> Centroids:
    """Centroids from all rows of ``docs`` with a language and a letter in the text."""
    scratch = Scratch(docs.sparkSession, "language")
    rows = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(order_col, text_col).alias("order"))
    n, seen = _document_frequencies(rows.select("text"), settings.buckets)
    idf = (np.log((1 + n) / (1 + seen)) + 1).astype(np.float32)
    sample = draw_texts(rows.where(F.col("text").isNotNull()), settings.per_language, scratch)
    made = sample.select("lang", "text", "order").groupBy("lang").applyInPandas(_clustered(settings, idf), "lang string, vector binary, reach double")
    made = scratch.store(made, "centroids").orderBy("lang", "vector").collect()  # a few per language
    vectors = np.array([np.frombuffer(r.vector, "<f4") for r in made], np.float32).reshape(-1, settings.buckets)
    return Centroids([r.lang for r in made], vectors, np.array([r.reach for r in made]), idf)


def identify_languages(docs: DataFrame, model: Centroids, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``lang_pred``, ``score`` and ``rejected``.

    ``score`` is the cosine with the nearest centroid. A text that is null or has no letter
    is ``und`` with score 0, as is every text if nothing was learned. Ties go to the first
    language by name. Only the text is used, in full.
    """
    buckets = len(model.idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores, rejected = [], [], []
            for text in batch.column(1).to_pylist():
                counts = gram_counts(text, buckets) if len(model.languages) else None
                if counts is None:
                    lang, score, far = UNDETERMINED, 0.0, False
                else:
                    cosines = model.vectors @ unit_vector(counts, model.idf)
                    best = int(np.argmax(cosines))
                    lang, score = model.languages[best], float(np.clip(cosines[best], 0, 1))
                    far = bool(cosines[best] < model.reach[best])
                langs.append(lang)
                scores.append(score)
                rejected.append(far)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                ["id", "lang_pred", "score", "rejected"],
            )

    lean = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = lean.schema["id"].dataType.simpleString()
    return lean.mapInArrow(run, f"id {kind}, lang_pred string, score double, rejected boolean").withColumnRenamed("id", id_col)
