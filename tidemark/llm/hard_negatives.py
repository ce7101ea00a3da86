"""Hard negatives by threshold joins over inverted indexes, in the manner of L2AP.

Rows are dealt to chunks of bounded size, in the end each meets every anchor once. In a chunk
a threshold join finds what scores at least ``t`` with an anchor: dimensions come in an order
common to all rows, those with the most energy first, and a row is posted only under the
leading dimensions, up to where the norm of its rest times that of any anchor's rest stays
below the thresholds. Partial scores add up over the postings; a row goes when no anchor can
reach its threshold with the norms that remain; survivors are completed with the dimensions
that were not posted. ``t`` starts near the upper end of an anchor's window of scores and is
lowered, for windows not yet filled, to the window's lower end.

Chunks are joined in waves of growing size. The worst row of a window that earlier waves have
filled is its lower end from then on, so all waves together report a few times what is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch

HIT = "anchor_id long, slot int, vec_id long, score long"
EXACT = float(1 << 52)  # whole numbers up to here are exact in double precision
NEVER = 1 << 62


@dataclass(frozen=True)
class Settings:
    """A chunk has about ``chunk_cells`` vector components, a batch ``batch`` anchors; the
    postings of a row come in ``segments`` runs of dimensions; ``lowering`` is how far down a
    window each threshold lies; a wave has ``growth`` times the chunks of all before it."""

    chunk_cells: int = 1 << 20
    batch: int = 256
    segments: int = 8
    lowering: tuple[float, ...] = (0.25, 0.5, 1.0)
    growth: int = 8


def _suffix_norms(x: np.ndarray, edges: list[int]) -> np.ndarray:
    """Norms of each row from every edge on; the last is 0."""
    squares = np.add.reduceat(np.square(x), edges[:-1], axis=1) if x.shape[1] else np.zeros((len(x), 1))
    rest = np.cumsum(squares[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.hstack((rest, np.zeros((len(x), 1)))))


class Chunk:
    """Rows of one chunk: ids, labels and whole-number vectors, and their suffix norms."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, segments: int):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        size = vectors.shape[1]
        self.edges = sorted({size * k // segments for k in range(segments)}) + [size]
        self.floats = vectors.astype(np.float64)
        self.rest = _suffix_norms(self.floats, self.edges)
        self.longest = float(self.rest[:, 0].max(initial=0.0))

    def at_least(self, anchors: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All (anchor, row, score) with a score of at least ``wanted`` of the anchor."""
        q = anchors.astype(np.float64)
        rest = _suffix_norms(q, self.edges)
        slack = 1e-9 * (1.0 + rest[:, :1] * self.longest)  # of sums in double precision
        least = (wanted[:, None] - slack).astype(np.float64)
        with np.errstate(divide="ignore", invalid="ignore"):
            needs = np.where(least > 0, least / rest, -np.inf).min(axis=0)  # by an anchor's rest from each edge
        omitted = self.rest < needs  # from this edge on a row reaches no anchor's threshold
        posted = np.where(omitted.any(axis=1), omitted.argmax(axis=1), len(self.edges) - 1)
        rows = np.argsort(-posted, kind="stable")
        rows = rows[: np.count_nonzero(posted)]
        score = np.zeros((len(q), len(rows)))
        for k, (a, b) in enumerate(zip(self.edges, self.edges[1:])):
            n = np.count_nonzero(posted[rows] > k)  # rows with postings here come first
            if not n:
                break
            score[:, :n] += q[:, a:b] @ self.floats[rows[:n], a:b].T
            bound = np.minimum(posted[rows], k + 1)
            live = (score + rest[:, bound] * self.rest[rows, bound] >= least).any(axis=0)
            if live.mean() < 0.75:
                rows, score = rows[live], score[:, live]
        if not len(rows):
            return np.empty(0, np.int64), rows, np.empty(0, np.int64)
        for k, (a, b) in enumerate(zip(self.edges, self.edges[1:])):  # what was not posted
            late = posted[rows] <= k
            if late.any():
                score[:, late] += q[:, a:b] @ self.floats[rows[late], a:b].T
        if float(rest[:, 0].max()) * self.longest < EXACT:
            anchor, row = np.nonzero(score >= wanted[:, None])
            return anchor, rows[row], np.rint(score[anchor, row]).astype(np.int64)
        anchor, row = np.nonzero(score >= least)
        exact = np.empty(len(anchor), np.int64)
        for lo in range(0, len(anchor), 65536):
            part = slice(lo, lo + 65536)
            exact[part] = np.einsum("ij,ij->i", anchors[anchor[part]], self.vectors[rows[row[part]]])
        good = exact >= wanted[anchor]
        return anchor[good], rows[row[good]], exact[good]

    def fill(self, ids, labels, vectors, upper, lower, same: bool, need: int, lowering) -> list[np.ndarray]:
        """Best ``need`` rows of each window ``lower <= score <= upper`` of each anchor, of its
        label or of others: columns anchor id, slot, row id, score."""
        slots = upper.shape[1]
        reach = np.sqrt(np.square(vectors.astype(np.float64)).sum(axis=1)) * self.longest
        reach = np.minimum(np.ceil(reach * (1 + 1e-9)) + 1, float(NEVER)).astype(np.int64)[:, None]
        top, floor = np.minimum(upper, reach), np.maximum(lower, -reach)
        open_ = floor <= top
        out = []
        for share in lowering:
            down = floor if share == lowering[-1] else top - np.ceil((top.astype(float) - floor) * share).astype(np.int64)
            wanted = np.where(open_, np.maximum(floor, down), NEVER)
            who = np.flatnonzero(open_.any(axis=1))
            if not len(who):
                break
            anchor, row, score = self.at_least(vectors[who], wanted[who].min(axis=1))
            anchor = who[anchor]
            good = (self.labels[row] == labels[anchor]) == same
            good &= self.ids[row] != ids[anchor]
            anchor, row, score = anchor[good], row[good], score[good]
            order = np.lexsort((self.ids[row], -score, anchor))
            anchor, row, score = anchor[order], row[order], score[order]
            for slot in range(slots):
                inside = (score >= wanted[anchor, slot]) & (score <= upper[anchor, slot])
                a, r, s = anchor[inside], row[inside], score[inside]
                nth = np.arange(len(a)) - np.searchsorted(a, a)
                count = np.bincount(a, minlength=len(ids))
                done = open_[:, slot] & ((count >= need) | (share == lowering[-1]))
                kept = (nth < need) & done[a]
                out.append(np.stack((ids[a[kept]], np.full(kept.sum(), slot), self.ids[r[kept]], s[kept])))
                open_[:, slot] &= ~done
        return out


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    flat = batch.column(batch.schema.get_field_index(name)).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1)


def _runs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """Chunk, side and up to ``most`` rows of them, in the order they come."""
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack((_column(batch, "chunk"), _column(batch, "side")))
        edges = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            for lo in range(a, b, most):
                yield int(key[0, a]), int(key[1, a]), batch.slice(lo, min(most, b - lo))


def threshold_join(rows: DataFrame, anchors: DataFrame, same: bool, need: int, settings: Settings) -> DataFrame:
    """``HIT``: of each chunk, the best ``need`` rows of each window of each anchor.

    ``rows``: chunk, id, label, vec. ``anchors``: chunk, id, label, vec and the arrays
    ``upper`` and ``lower``, as long as one another for all anchors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, chunk, at = [], None, None
        for number, side, part in _runs(batches, settings.batch):
            if number != at:
                held, chunk, at = [], None, number
            if side == 0:
                held.append(part)
                continue
            if not held:
                continue
            if chunk is None:
                parts = [[_column(h, n) for h in held] for n in ("id", "label")]
                chunk = Chunk(*map(np.concatenate, parts), np.concatenate([_matrix(h, "vec") for h in held]), settings.segments)
            found = chunk.fill(
                _column(part, "id"), _column(part, "label"), _matrix(part, "vec"), _matrix(part, "upper"), _matrix(part, "lower"),
                same, need, settings.lowering,
            )
            a, slot, r, s = np.concatenate(found, axis=1) if found else np.empty((4, 0), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a), pa.array(slot.astype(np.int32)), pa.array(r), pa.array(s)], ["anchor_id", "slot", "vec_id", "score"]
            )

    none = F.array().cast("array<long>")
    one = rows.select("chunk", F.lit(0).alias("side"), "id", "label", "vec", none.alias("upper"), none.alias("lower"))
    other = anchors.select("chunk", F.lit(1).alias("side"), "id", "label", "vec", "upper", "lower")
    both = one.unionByName(other).repartition("chunk").sortWithinPartitions("chunk", "side")
    return both.mapInArrow(run, HIT)


def _best(hits: DataFrame, need: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= need)


def fill_windows(rows: DataFrame, chunks: int, windows: DataFrame, same: bool, need: int, settings: Settings, scratch: Scratch, label: str) -> DataFrame:
    """``HIT`` and ``rank``: the best ``need`` rows of each window.

    ``windows``: anchor_id, slot, upper, lower, with the slots 0, 1 ... of every anchor.
    """
    anchors = rows.select(F.col("id").alias("anchor_id"), F.col("label"), "vec").join(windows.select("anchor_id").distinct(), "anchor_id")
    anchors = scratch.store(anchors, f"{label}-anchors")
    found, done = None, 0
    while done < chunks:
        upto = min(chunks, max(1, done * (settings.growth + 1)))
        bounds = windows
        if found is not None:
            worst = found.where(F.col("rank") == need).select("anchor_id", "slot", F.col("score").alias("worst"))
            bounds = windows.join(worst, ["anchor_id", "slot"], "left").withColumn("lower", F.greatest("lower", "worst"))
        packed = bounds.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("slot", "upper", "lower"))).alias("w"))
        ends = packed.select("anchor_id", F.col("w.upper").alias("upper"), F.col("w.lower").alias("lower"))
        asked = anchors.join(ends, "anchor_id").withColumnRenamed("anchor_id", "id")
        asked = asked.withColumn("chunk", F.explode(F.sequence(F.lit(done), F.lit(upto - 1))))
        wave = rows.where((F.col("chunk") >= done) & (F.col("chunk") < upto))
        hits = threshold_join(wave, asked, same, need, settings)
        if found is not None:
            hits = hits.unionByName(found.drop("rank"))
        found, done = scratch.store(_best(hits, need), f"{label}-{upto}"), upto
    return found


def usable_rows(vectors: DataFrame, id_col: str, label_col: str, vec_col: str, scale: int) -> DataFrame:
    """``id, label, vec`` with whole-number components, one row per id."""
    vec = F.col(vec_col).cast("array<double>")
    lean = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), vec.alias("vec"))
    finite = F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    lean = lean.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0)).where(finite)
    lean = lean.withColumn("size", F.size("vec"))
    usual = lean.groupBy("size").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "size").limit(1).select("size")
    whole = F.transform("vec", lambda c: F.floor(c * scale)).alias("vec")
    lean = lean.join(usual, "size", "left_semi").select("id", "label", whole)
    return lean.groupBy("id").agg(F.min(F.struct("label", "vec")).alias("row")).select("id", "row.label", "row.vec")


def _by_energy(rows: DataFrame) -> list[int]:
    """Dimensions, those with the largest sum of squares first."""
    parts = rows.select(F.posexplode("vec").alias("dim", "c")).groupBy("dim").agg(F.sum(F.col("c").cast("double") * F.col("c")).alias("e"))
    return [r["dim"] for r in parts.orderBy(F.desc("e"), "dim").collect()]  # as many as a vector has components


def mine_hard_negatives(
    vectors: DataFrame,
    is_anchor,
    id_col: str = "vec_id",
    label_col: str = "label",
    vec_col: str = "embedding",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    settings: Settings = Settings(),
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become ``floor(scale * x)``; a score is the whole-number inner product with the
    anchor, larger first, ties by smaller id. ``is_anchor`` is a condition on the column
    ``id``. An anchor's positives are its first ``positives`` other rows of its label; to each
    belong the first ``negatives`` rows of other labels that score between ``low`` and ``high``
    percent of it, so none where the positive's score is negative.

    Rows with a null id, label or vector, with a component that is null or not finite, or of
    another length than most take no part; of rows with one id the smallest by label and vector
    counts. Scores must fit in 64 bits. Other columns make no difference.
    """
    scratch = Scratch(vectors.sparkSession, "negatives")
    plain = scratch.store(usable_rows(vectors, id_col, label_col, vec_col, scale), "plain")
    count = plain.count()
    order = _by_energy(plain)
    chunks = max(1, -(-count * max(1, len(order)) // settings.chunk_cells))
    vec = F.transform(F.array(*[F.lit(d) for d in order]), lambda d: F.get("vec", d)).alias("vec")
    dealt = plain.select(F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int").alias("chunk"), "id", "label", vec)
    rows = scratch.store(dealt, "rows")
    everything = rows.where(is_anchor).select(
        F.col("id").alias("anchor_id"), F.lit(0).alias("slot"), F.lit(NEVER).alias("upper"), F.lit(-NEVER).alias("lower")
    )
    near = fill_windows(rows, chunks, everything, True, positives, settings, scratch, "positives")
    slot = (F.col("rank") - 1).cast("int").alias("slot")
    near = scratch.store(near.select("anchor_id", slot, F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "near")
    by_positive = near.select("anchor_id", "slot", F.col("positive_score").alias("p"))
    # p = 100 a + b: percentages of whole numbers, rounded down and up, without large products
    a, b = F.expr("(p - pmod(p, 100)) div 100"), F.expr("pmod(p, 100)")
    by_positive = by_positive.withColumns({"a": a, "b": b}).select(
        "anchor_id",
        "slot",
        F.expr(f"a * {high} + b * {high} div 100").alias("upper"),
        F.expr(f"a * {low} + (b * {low} + 99) div 100").alias("lower"),
    )
    # anchors with fewer positives get windows that no score can meet
    anchors = near.select("anchor_id").distinct().select("anchor_id", F.explode(F.sequence(F.lit(0), F.lit(positives - 1))).alias("slot"))
    windows = anchors.join(by_positive, ["anchor_id", "slot"], "left").select(
        "anchor_id", "slot", F.coalesce("upper", F.lit(-NEVER)).alias("upper"), F.coalesce("lower", F.lit(NEVER)).alias("lower")
    )
    windows = scratch.store(windows, "windows")
    far = fill_windows(rows, chunks, windows, False, negatives, settings, scratch, "negatives")
    return near.join(far, ["anchor_id", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
