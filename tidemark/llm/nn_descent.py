"""Approximate nearest neighbours by inner product: NN-descent and greedy graph search.

NN-descent: every node holds its best neighbours so far. In each round the neighbours of a
node, and a sample of the nodes that hold it as neighbour, are brought together by joins and
compared with each other; each takes over what is better than its worst. Pairs that met
before do not meet again. The first neighbours come from small random groups.

Search: a query keeps a list of the best nodes seen, starts from its neighbours in the
graph, and in each round compares itself with the neighbours of those it has not yet opened.

Rows with equal vectors are one node, so that copies do not crowd out all others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch

STATE = "node long, near array<long>, sim array<float>, fresh array<boolean>"
MET = "node long, near array<long>, sim array<float>"


@dataclass(frozen=True)
class Settings:
    """``degree`` neighbours per node and as many sampled reverse ones; ``offers`` is how many
    of a meeting's better candidates a node takes home; ``width`` nodes are kept per query."""

    degree: int = 40
    offers: int = 6
    rounds: int = 7
    settled: float = 0.01
    group: int = 128
    first_groups: int = 2
    width: int = 120
    hops: int = 4


def _short(vectors: np.ndarray) -> np.ndarray:
    """Rows as 16-bit floats relative to their largest component, which follows in 32 bits."""
    scale = np.abs(vectors).max(axis=1, keepdims=True)
    return np.hstack(((vectors / scale).astype("<f2").view(np.uint8), scale.astype("<f4").view(np.uint8)))


def _long(raw: bytes, size: int) -> np.ndarray:
    parts = np.frombuffer(raw, np.uint8).reshape(-1, 2 * size + 4)
    return parts[:, : 2 * size].copy().view("<f2").astype(np.float32) * parts[:, 2 * size :].copy().view("<f4")


def _vectors(column: pa.Array, size: int) -> np.ndarray:
    return _long(b"".join(column.to_pylist()), size)


def _lists(arrays: list[np.ndarray], kind, dtype) -> pa.Array:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays) if arrays else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(dtype), kind))


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Key and rows of each run of equal first values; runs may go over batch borders."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        edges = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        for a, b in zip(edges, edges[1:]):
            if held and held[0].column(0)[0].as_py() != key[a]:
                yield held[0].column(0)[0].as_py(), held
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield held[0].column(0)[0].as_py(), held


def _meetings(met: DataFrame, size: int, offers: int) -> DataFrame:
    """Compares all that meet: ``place, node, fresh, least, vec``, sorted by ``place``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, nears, sims = [], [], []
        for _, parts in _by_key(batches):
            node, at = np.unique(np.concatenate([p.column(1).to_numpy() for p in parts]), return_index=True)
            fresh = np.concatenate([p.column(2).to_numpy(zero_copy_only=False) for p in parts])[at]
            least = np.concatenate([p.column(3).to_numpy() for p in parts])[at]
            x = np.concatenate([_vectors(p.column(4), size) for p in parts])[at]
            g = x @ x.T
            g[~((fresh[:, None] | fresh[None, :]) & (g > least[:, None]))] = -np.inf
            np.fill_diagonal(g, -np.inf)
            take = min(offers, len(node))
            top = np.argpartition(-g, take - 1, axis=1)[:, :take] if take < len(node) else np.argsort(-g, axis=1)
            best = np.take_along_axis(g, top, axis=1)
            good = best > -np.inf
            for i in np.flatnonzero(good.any(axis=1)):
                nodes.append(node[i])
                nears.append(node[top[i][good[i]]])
                sims.append(best[i][good[i]])
            if len(nodes) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), _lists(nears, pa.int64(), np.int64), _lists(sims, pa.float32(), np.float32)], ["node", "near", "sim"])
                nodes, nears, sims = [], [], []
        if nodes:
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), _lists(nears, pa.int64(), np.int64), _lists(sims, pa.float32(), np.float32)], ["node", "near", "sim"])

    return met.mapInArrow(run, MET)


def _best(lists: DataFrame, keep: int, flag_new: bool) -> DataFrame:
    """The ``keep`` best of all lists of a node, each neighbour once.

    A row with ``fresh`` is what the node had; its flags are set to ``not flag_new`` where
    the flag means "has not met yet", and kept otherwise.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols: list[list[np.ndarray]] = [[], [], [], [], []]
        for batch in batches:
            node, near, sim, fresh = batch.columns
            sizes = near.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            had = np.asarray(fresh.is_valid())
            flags = np.ones(sizes.sum(), bool)
            flags[np.repeat(had, sizes)] = False if flag_new else fresh.flatten().to_numpy(zero_copy_only=False)
            for c, v in zip(cols, (np.repeat(node.to_numpy(), sizes), near.flatten().to_numpy(), sim.flatten().to_numpy(), flags, np.repeat(~had, sizes))):
                c.append(v)
        if not cols[0]:
            return
        node, near, sim, fresh, new = map(np.concatenate, cols)
        order = np.lexsort((new, near, node))  # what the node had comes before what it is offered
        node, near, sim, fresh = node[order], near[order], sim[order], fresh[order]
        once = np.concatenate(([True], (node[1:] != node[:-1]) | (near[1:] != near[:-1]))) if len(node) else np.empty(0, bool)
        node, near, sim, fresh = node[once], near[once], sim[once], fresh[once]
        order = np.lexsort((near, -sim, node))
        node, near, sim, fresh = node[order], near[order], sim[order], fresh[order]
        kept = np.arange(len(node)) - np.searchsorted(node, node) < keep
        node, near, sim, fresh = node[kept], near[kept], sim[kept], fresh[kept]
        names, first = np.unique(node, return_index=True)
        for lo in range(0, len(names), 5000):
            a, b = first[lo], first[lo + 5000] if lo + 5000 < len(names) else len(node)
            offsets = pa.array(np.append(first[lo : lo + 5000], b).astype(np.int32) - np.int32(a))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (near[a:b], sim[a:b].astype(np.float32), fresh[a:b])]
            yield pa.RecordBatch.from_arrays([pa.array(names[lo : lo + 5000]), *lists], ["node", "near", "sim", "fresh"])

    return lists.select("node", "near", "sim", "fresh").repartition("node").mapInArrow(run, STATE)


def _offered(met: DataFrame) -> DataFrame:
    return met.withColumn("fresh", F.lit(None).cast("array<boolean>"))


def usable_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id``, ``vec`` of the vectors that take part: of the most frequent length, finite, not zero."""
    vec = F.col(vec_col).cast("array<double>")
    lean = vectors.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), vec.alias("vec"))
    finite = F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    lean = lean.where(F.col("vec").isNotNull() & (F.size("vec") > 0)).where(finite & F.exists("vec", lambda c: c != 0))
    lean = lean.withColumn("size", F.size("vec"))
    usual = lean.groupBy("size").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "size").limit(1).select("size")
    return lean.join(usual, "size", "left_semi").select("id", "vec").distinct()


def neighbour_graph(nodes: DataFrame, count: int, size: int, settings: Settings, scratch: Scratch) -> DataFrame:
    """``STATE`` of every node, from ``node, vec`` with ``vec`` in the short form."""
    groups = -(-count // settings.group)
    place = F.explode(F.array(*[F.pmod(F.xxhash64("node", F.lit(s)), F.lit(groups)) * settings.first_groups + s for s in range(settings.first_groups)]))
    met = nodes.select(place.alias("place"), "node", F.lit(True).alias("fresh"), F.lit(float("-inf")).cast("float").alias("least"), "vec")
    met = met.repartition("place").sortWithinPartitions("place")
    state = scratch.store(_best(_offered(_meetings(met, size, settings.degree)), settings.degree, True), "graph-0")
    last = F.element_at("sim", -1)
    for r in range(1, settings.rounds + 1):
        own = nodes.join(state, "node", "left")
        least = F.when(F.size("near") >= settings.degree, last).otherwise(float("-inf")).cast("float")
        loaded = scratch.store(own.select(F.col("node").alias("member"), least.alias("least"), "vec"), f"loaded-{r}")
        ahead = state.select(F.col("node").alias("place"), F.explode(F.arrays_zip("near", "fresh")).alias("e"))
        ahead = ahead.select("place", F.col("e.near").alias("member"), F.col("e.fresh").alias("fresh"))
        back = ahead.select(F.col("member").alias("place"), F.col("place").alias("member"), "fresh")
        draw = Window.partitionBy("place").orderBy(F.xxhash64("place", "member", F.lit(r)))
        back = back.withColumn("_n", F.row_number().over(draw)).where(F.col("_n") <= settings.degree).drop("_n")
        met = ahead.unionByName(back).join(loaded, "member").select("place", F.col("member").alias("node"), "fresh", "least", "vec")
        met = _meetings(met.repartition("place").sortWithinPartitions("place"), size, settings.offers)
        state = scratch.store(_best(_offered(met).unionByName(state), settings.degree, True), f"graph-{r}")
        scratch.drop(f"loaded-{r}", f"graph-{r - 1}")
        news = state.select(F.avg(F.aggregate("fresh", F.lit(0.0), lambda a, f: a + f.cast("double")) / F.size("fresh"))).first()[0]
        if (news or 0) < settings.settled:
            break
    return state


def _opened(asked: DataFrame, size: int) -> DataFrame:
    """Compares queries with the neighbours of the nodes they open: ``node, vec, least, near, vecs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, least = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            queries = _vectors(batch.column(1), size)
            nears, sims = [], []
            for i, (near, vecs) in enumerate(zip(batch.column(3), batch.column(4))):
                near = near.values.to_numpy()
                sim = _long(vecs.as_py(), size) @ queries[i]
                good = (sim > least[i]) & (near != node[i])
                nears.append(near[good])
                sims.append(sim[good])
            yield pa.RecordBatch.from_arrays([pa.array(node), _lists(nears, pa.int64(), np.int64), _lists(sims, pa.float32(), np.float32)], ["node", "near", "sim"])

    return asked.mapInArrow(run, MET)


def graph_search(queries: DataFrame, nodes: DataFrame, state: DataFrame, size: int, settings: Settings, scratch: Scratch) -> DataFrame:
    """``STATE`` of each query node: the best nodes found; ``fresh`` ones were not opened."""
    held = state.select("node", F.posexplode("near").alias("at", "member")).join(nodes.withColumnRenamed("node", "member"), "member")
    held = held.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("at", "member", "vec"))).alias("h"))  # at most ``degree``
    joined = F.aggregate("h", F.lit(b""), lambda a, x: F.concat(a, x["vec"]))
    book = scratch.store(held.select(F.col("node").alias("open"), F.col("h.member").alias("members"), joined.alias("vecs")), "book")
    found = state.join(queries, "node", "left_semi").withColumn("fresh", F.transform("near", lambda _: F.lit(True)))
    found = scratch.store(found, "found-0")
    for h in range(1, settings.hops + 1):
        least = F.when(F.size("near") >= settings.width, F.element_at("sim", -1)).otherwise(float("-inf")).cast("float").alias("least")
        to_open = found.select("node", least, F.explode(F.filter("near", lambda n, i: F.get("fresh", i))).alias("open"))
        asked = to_open.join(nodes, "node").select("node", "vec", "least", "open").join(book, "open").select("node", "vec", "least", "members", "vecs")
        had = found.withColumn("fresh", F.transform("near", lambda _: F.lit(False)))
        found = scratch.store(_best(_offered(_opened(asked, size)).unionByName(had), settings.width, False), f"found-{h}")
        if found.where(F.exists("fresh", lambda f: f)).limit(1).count() == 0:
            break
    return found


def nearest_neighbours(
    vectors: DataFrame,
    is_query,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    limit: int = 20,
    settings: Settings = Settings(),
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``limit`` nearest found of each query row.

    ``is_query`` is a condition on the column ``id``. Candidates are all rows but the
    query's own; nearness is the inner product in double precision of the vectors as given,
    ties go to the smaller id. Vectors that are null, zero, of another length than most, or
    that hold a null or a component that is not finite, and rows without an id take no part;
    a repeated row counts once. Other columns make no difference.
    """
    scratch = Scratch(vectors.sparkSession, "neighbours")
    rows = scratch.store(usable_vectors(vectors, id_col, vec_col), "rows")
    order = Window.partitionBy("vec").orderBy("id")
    numbered = rows.withColumn("copy", F.row_number().over(order)).where(F.col("copy") <= limit + 1)
    copies = scratch.store(numbered.withColumn("node", F.first("id").over(order)), "copies")  # the first few ids of each vector
    size, count = copies.agg(F.coalesce(F.max(F.size("vec")), F.lit(1)), F.count_if(F.col("copy") == 1)).first()

    def shrunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _short(batch.column(1).flatten().to_numpy().reshape(-1, size))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in x], pa.binary())], ["node", "vec"])

    nodes = scratch.store(copies.where("copy = 1").select("node", "vec").mapInArrow(shrunk, "node long, vec binary"), "nodes")
    asked = rows.where(is_query).select("id", "vec")
    vec_nodes = copies.where("copy = 1").select("node", "vec")
    asked = scratch.store(asked.join(vec_nodes, "vec").select(F.col("id").alias("query_id"), "node", "vec"), "asked")

    if count > 1:
        state = neighbour_graph(nodes, count, size, settings, scratch)
        found = graph_search(asked.select("node").distinct(), nodes, state, size, settings, scratch)
        best = found.select("node", F.explode(F.slice("near", 1, 3 * limit)).alias("other"))
        best = best.unionByName(asked.select("node", F.col("node").alias("other")).distinct())
    else:
        best = asked.select("node", F.col("node").alias("other")).distinct()
    members = copies.select(F.col("node").alias("other"), F.col("id").alias("vec_id"), F.col("vec").alias("v"))
    pairs = asked.join(best, "node").join(members, "other").where("vec_id != query_id")
    score = F.aggregate(F.zip_with("vec", "v", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    pairs = pairs.select("query_id", "vec_id", score.alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= limit).select("query_id", "rank", "vec_id", "score")
