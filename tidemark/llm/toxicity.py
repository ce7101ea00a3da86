"""Toxicity by a factorization machine over hashed terms.

A text is the set of its terms: words and their beginnings, hashed. On a bounded sample of
labelled texts, the terms whose presence depends on the label are selected, and a machine of
second order is fitted to them: a weight for each term and a short vector for each, whose
inner products are the weights of pairs. So an insult and a group mention may together say
more than the sum of the two.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch

WORD = re.compile(r"\w+")
CACHE_WORDS = 400_000
BLOCK = 1 << 16  # entries whose vectors are gathered at once


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the labelled rows that are learned from, ``terms`` the terms kept."""

    sample: int = 20_000
    terms: int = 4096
    buckets: int = 1 << 22
    least_rows: int = 5
    least_chi2: float = 15.0
    factors: int = 8
    epochs: int = 250
    rate: float = 0.05
    decay: float = 2e-4
    seed: int = 17


@dataclass(frozen=True)
class Machine:
    """``terms`` are sorted hashes; row i of ``weights`` and ``vectors`` belongs to term i."""

    bias: float
    terms: np.ndarray
    weights: np.ndarray
    vectors: np.ndarray
    buckets: int

    def raw(self, found: list[int]) -> float:
        if not found:
            return self.bias
        v = self.vectors[found]
        return float(self.bias + self.weights[found].sum() + 0.5 * (v.sum(axis=0) ** 2 - (v**2).sum(axis=0)).sum())


def hashed_terms(word: str, buckets: int) -> set[int]:
    """The word in full, and its first four, five and six letters."""
    forms = [f"w{word}", *(f"p{word[:n]}" for n in (4, 5, 6) if len(word) >= n)]
    return {zlib.crc32(f.encode("utf-8", "surrogatepass")) % buckets for f in forms}


class TermsOfWords(dict):
    """Word -> hashed terms, only those in ``wanted`` if given, by place in it."""

    def __init__(self, buckets: int, wanted: np.ndarray | None = None):
        self.buckets = buckets
        self.places = None if wanted is None else {int(t): i for i, t in enumerate(wanted)}

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= CACHE_WORDS:
            self.clear()
        terms = hashed_terms(word, self.buckets)
        if self.places is not None:
            terms = {self.places[t] for t in terms if t in self.places}
        value = self[word] = tuple(terms)
        return value

    def of(self, text: str | None) -> list[int]:
        out: set[int] = set()
        for word in set(WORD.findall((text or "").lower())):
            terms = self[word]
            if terms:
                out.update(terms)
        return sorted(out)


def _sample_terms(sample: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = TermsOfWords(buckets)
        for batch in batches:
            terms = [known.of(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(terms, pa.list_(pa.int32()))], ["label", "terms"])

    return sample.select("label", "text").mapInArrow(run, "label int, terms array<int>")


def select_terms(rows: DataFrame, settings: Settings) -> np.ndarray:
    """The terms with the largest chi-square against the label, from ``label, terms``."""
    n, pos = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not n or not pos or pos == n:
        return np.empty(0, np.int64)
    counts = rows.select("label", F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("c"), F.sum("label").alias("p"))
    expected = F.col("c") * pos / n
    chi2 = (F.col("p") - expected) ** 2 * n * n / (F.col("c") * pos * (n - pos) / n * n) / (1 - F.col("c") / (n + 1.0))
    best = counts.where(F.col("c") >= settings.least_rows).select("term", chi2.alias("chi2")).where(F.col("chi2") >= settings.least_chi2)
    best = best.orderBy(F.desc("chi2"), "term").limit(settings.terms)
    return np.array(sorted(r.term for r in best.collect()), np.int64)


def _blocks(lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """Runs of whole groups of entries, up to ``BLOCK`` entries where a group has no more.

    Of each: the groups that have entries, where they start in it, and where it starts and ends.
    """
    ends = np.cumsum(lengths)
    first = 0
    while first < len(lengths):
        lo = int(ends[first] - lengths[first])
        last = max(first + 1, int(np.searchsorted(ends, lo + BLOCK, "right")))
        some = first + np.flatnonzero(lengths[first:last])
        if len(some):
            yield some, (ends - lengths)[some] - lo, lo, int(ends[last - 1])
        first = last


def fit_machine(labels: np.ndarray, rows: list[np.ndarray], terms: np.ndarray, settings: Settings) -> Machine:
    """Full-batch Adam on the logistic loss; ``rows`` hold places in ``terms``.

    Sums over rows and over terms are taken by blocks of entries, so that beside the entries
    themselves memory is bounded; each sum is one step's, whatever the blocks.
    """
    rng = np.random.default_rng(settings.seed)
    y = labels.astype(np.float64)
    share = float(np.clip(y.mean() if len(y) else 0.5, 1e-4, 1 - 1e-4))
    m = len(terms)
    params = [np.array([np.log(share / (1 - share))]), np.zeros(m), rng.normal(0, 0.05, (m, settings.factors))]
    flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
    if not len(flat):
        return Machine(float(params[0][0]), terms, params[1], params[2], settings.buckets)
    lengths = np.array([len(r) for r in rows])
    order = np.argsort(flat, kind="stable")
    doc_of = np.repeat(np.arange(len(rows), dtype=np.int32), lengths)[order]  # by term, as ``seen`` and ``counts``
    del order
    seen, counts = np.unique(flat, return_counts=True)

    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)) ** 0.5  # halfway to balanced classes
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    of_rows, of_terms = list(_blocks(lengths)), list(_blocks(counts))
    for epoch in range(1, settings.epochs + 1):
        bias, w, v = params
        sums, linear, squares = np.zeros((len(rows), settings.factors)), np.zeros(len(rows)), np.zeros(len(rows))
        for some, starts, lo, hi in of_rows:
            vf = v[flat[lo:hi]]
            sums[some] = np.add.reduceat(vf, starts, axis=0)
            linear[some] = np.add.reduceat(w[flat[lo:hi]], starts)
            squares[some] = np.add.reduceat((vf**2).sum(axis=1), starts)
        raw = bias + linear + 0.5 * ((sums**2).sum(axis=1) - squares)
        err = weight * (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y) / len(y)
        gw, gv = np.zeros_like(w), np.zeros_like(v)
        for some, starts, lo, hi in of_terms:
            docs = doc_of[lo:hi]
            vf = np.repeat(v[seen[some]], counts[some], axis=0)
            gw[seen[some]] = np.add.reduceat(err[docs], starts)
            gv[seen[some]] = np.add.reduceat(err[docs][:, None] * (sums[docs] - vf), starts, axis=0)
        grads = [np.array([err.sum()]), gw + settings.decay * w / 10, gv + settings.decay * v]
        for p, g, (a, b) in zip(params, grads, moments):
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            p -= settings.rate * (a / (1 - 0.9**epoch)) / (np.sqrt(b / (1 - 0.999**epoch)) + 1e-9)
    return Machine(float(params[0][0]), terms, params[1], params[2], settings.buckets)


def learn_toxicity(labelled: DataFrame, text_col: str = "text", label_col: str = "label", order_col: str = "order", settings: Settings = Settings()) -> Machine:
    """A machine from at most ``settings.sample`` rows of ``labelled``, already bounded to them."""
    scratch = Scratch(labelled.sparkSession, "toxicity")
    rows = labelled.select(F.col(label_col).cast("int").alias("label"), F.col(text_col).alias("text"))
    rows = scratch.store(_sample_terms(rows, settings.buckets), "terms")
    terms = select_terms(rows, settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = []
            for found in batch.column(1):
                found = found.values.to_numpy(zero_copy_only=False)
                at = np.minimum(np.searchsorted(terms, found), max(len(terms) - 1, 0))
                places.append(at[terms[at] == found].astype(narrow) if len(terms) else at[:0].astype(narrow))
            lists = pa.array(places, pa.list_(pa.from_numpy_dtype(narrow)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["label", "places"])

    narrow, kind = (np.int16, "smallint") if len(terms) <= 1 << 15 else (np.int32, "int")
    table = rows.mapInArrow(run, f"label int, places array<{kind}>").toArrow()
    labels, lists = table.column("label").to_numpy(), table.column("places").combine_chunks()
    places = np.split(lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())[:-1]) if len(lists) else []
    return fit_machine(labels, places, terms, settings)


def sample_of(labels: DataFrame, docs: DataFrame, allowed, id_col: str, label_col: str, text_col: str, bound: int) -> DataFrame:
    """``label``, ``text`` of at most ``bound`` rows, taken by hashes.

    First ``bound`` labelled ids are taken, then as many of their rows by the hash of id and
    text, where rows with equal hashes are repeats of one row: an id that repeats,
    with one text or with many, does not widen the sample. Both broadcasts hold at most
    ``bound`` rows of numbers.
    """
    one = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & allowed)
    one = one.groupBy(id_col).agg(F.max(label_col).cast("int").alias("label"))
    chosen = one.orderBy(F.xxhash64(id_col), id_col).limit(bound).withColumnRenamed(id_col, "_labelled")
    lean = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    rows = lean.join(F.broadcast(chosen), F.col("_id") == F.col("_labelled"))
    rows = rows.select("label", "text", F.xxhash64("_id", "text").alias("_order"))
    counted = rows.groupBy("_order").agg(F.count(F.lit(1)).alias("_n")).orderBy("_order").limit(bound)
    upto = F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_order").rowsBetween(Window.unboundedPreceding, -1))
    counted = counted.withColumn("_take", F.least("_n", bound - F.coalesce(upto, F.lit(0)))).where("_take > 0").drop("_n")
    drawn = rows.join(F.broadcast(counted), "_order").groupBy("_order", "_take").agg(F.first("label").alias("label"), F.first("text").alias("text"))
    return drawn.select("label", "text", F.explode(F.sequence(F.lit(1), F.col("_take")))).select("label", "text")


def score_toxicity(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: the id and ``score`` from 0 to 1. With ``keep``, a struct
    ``row`` of these columns instead of the id.

    Only the text is used, in full; a null or empty text, and one without known terms, gets
    the score of a text of which nothing is known. Other columns make no difference.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = TermsOfWords(machine.buckets, machine.terms)
        for batch in batches:
            raw = np.array([machine.raw(known.of(t)) for t in batch.column(1).to_pylist()], np.float64)
            score = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], ["row", "score"])

    lean = docs.select(F.struct(*[F.col(c) for c in keep or [id_col]]).alias("row"), F.col(text_col).alias("text"))
    kind = lean.schema["row"].dataType.simpleString()
    return lean.mapInArrow(run, f"row {kind}, score double").select(*(["row"] if keep else [F.col(f"row.{id_col}")]), "score")
