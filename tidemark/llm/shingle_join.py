"""Similarity join of documents on word shingles, and the classes it links.

Each shingle hash of a document is a signature: PartEnum's finest cut, in which a partner's
extra elements spoil none. Of two similar sets each has few elements that the other lacks;
so, with the signatures of every set ordered from the rarest to the most widely shared, the
first that they have in common stands near the front of both. How near depends on the two
sizes, and only documents that meet so near the front are compared: those that merely have a
passage in common do not meet, however many they are. Documents with equal sets are one node
throughout.

Signatures are counted in groups of the hash domain, as arrays: a task sends one array for
each group, and what several sets share goes back, with its count, to where it came from.
The places of a set's signatures are found there, and only the front ones become rows.

In a bucket, the nodes of one signature, every node is first compared with one leader, at
first the member that shares the most. What this links needs no further comparison among
itself. Where much is left, other leaders follow while they link anything; then all pairs
from different components of a bucket are compared. Similarities are exact, from the whole
sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bitmaps import bitmap_of, with_flag
from tidemark.llm.components import components
from tidemark.llm.partenum import PartEnum
from tidemark.llm.scratch import Scratch
from tidemark.llm.words import BASES, WordHashes, mixed, windows, words_of

GROUP_BITS = 9  # at least 512 groups of signatures
GROUP_ELEMENTS = 1 << 18  # about as many elements in each
SENT_ELEMENTS = 1 << 20  # a task sends so many at a time
SENT_ROWS = 1 << 16  # of as many rows at the most: their numbers have 16 bits
ROUNDS = 6  # of leaders
LOOKED_AT = 100  # so many pairs for each member of open buckets need no further leader


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of ``size`` consecutive words; of all words if there are fewer."""
    if 0 < len(hashes) < size:
        return windows(hashes, len(hashes)) + np.uint64(len(hashes))
    return np.unique(windows(hashes, size))


def _shapes(docs: DataFrame, size: int) -> DataFrame:
    """Per row of ``id, text``: the set's size and two digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                n, f1, f2 = [], [], []
                for text in part.column(1).to_pylist():
                    found = shingles(known.of(words_of(text, fold=True)), size)
                    n.append(len(found))
                    f1.append(found.sum(dtype=np.uint64))
                    f2.append(mixed(found ^ np.uint64(BASES[1])).sum(dtype=np.uint64))
                digests = [pa.array(np.array(f, np.uint64).view(np.int64)) for f in (f1, f2)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), *digests], ["id", "n", "f1", "f2"])

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, n long, f1 long, f2 long")


def _cut(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary values: the stretches of ``values`` that end at ``ends``."""
    offsets = np.concatenate(([0], ends)).astype(np.int64) * values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _joined(column: pa.ChunkedArray, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """What binary values hold, one after the other, and how much of it is in each."""
    raw = [v or b"" for v in column.to_pylist()]
    return np.frombuffer(b"".join(raw), dtype), np.array([len(v) for v in raw], np.int64) // np.dtype(dtype).itemsize


def _dealt(docs: DataFrame, size: int, bits: int) -> DataFrame:
    """The signatures of rows of ``uid, id, text``, dealt to ``2**bits`` groups of the domain.

    A task sends many rows at a time, known by the ``uid`` of the first: for each group which
    rows, as numbers among these, have which signature there, cut to 32 bits. With the first
    group go their ids, sizes and numbers of signatures. A shorter signature can only be
    shared more widely: sets that have an element in common share it.
    """

    def sent(base: int, ids: list, sets: list[np.ndarray], id_type: pa.DataType) -> pa.RecordBatch:
        sizes = np.array([len(s) for s in sets], np.int64)
        row = np.repeat(np.arange(len(sets), dtype=np.uint16), sizes)
        value = np.concatenate(sets) >> np.uint64(32 - bits)
        first = np.concatenate(([True], (value[1:] != value[:-1]) | (row[1:] != row[:-1])))
        value, row = value[first], row[first]
        group = (value >> np.uint64(32)).astype(np.uint16 if bits <= 16 else np.uint32)
        order = np.argsort(group, kind="stable")
        group, low, row = group[order], value[order].astype("<u4"), row[order].astype("<u2")
        ends = np.append(np.flatnonzero(group[1:] != group[:-1]) + 1, len(group))
        rest = [None] * (len(ends) - 1)
        emitted = np.bincount(row, minlength=len(sets)).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(group[ends - 1].astype(np.int32)), pa.array(np.full(len(ends), base, np.int64)), _cut(row, ends), _cut(low, ends),
             pa.array([ids, *rest], pa.list_(id_type)), pa.array([sizes, *rest], pa.list_(pa.int64())), pa.array([emitted, *rest], pa.list_(pa.int64()))],
            ["grp", "base", "row", "low", "ids", "sizes", "emitted"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, base, ids, sets, held = WordHashes(), None, [], [], 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                for uid, key, text in zip(*(c.to_pylist() for c in batch.slice(lo, 1000).columns)):
                    found = shingles(known.of(words_of(text, fold=True)), size)
                    if not len(found):
                        continue
                    if held and (held + len(found) > SENT_ELEMENTS or len(sets) == SENT_ROWS):
                        yield sent(base, ids, sets, batch.schema.field(1).type)
                        ids, sets, held = [], [], 0
                    base = base if sets else uid
                    ids.append(key)
                    sets.append(found)
                    held += len(found)
        if sets:
            yield sent(base, ids, sets, batch.schema.field(1).type)

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"grp int, base long, row binary, low binary, ids array<{kind}>, sizes array<long>, emitted array<long>")


def _counted(dealt: DataFrame) -> DataFrame:
    """``dealt`` without the signatures that one row alone has; the others with how many have them."""

    def run(part: pa.Table) -> pa.Table:
        (low, sizes), (row, _) = _joined(part["low"], "<u4"), _joined(part["row"], "<u2")
        batch = np.repeat(np.arange(len(sizes)), sizes)
        order = np.argsort(low, kind="stable")
        low, row, batch = low[order], row[order], batch[order]
        starts = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1])))
        n = np.diff(np.append(starts, len(low)))
        n = np.repeat(n, n)
        shared = np.flatnonzero(n > 1)
        shared = shared[np.argsort(batch[shared], kind="stable")]
        ends = np.cumsum(np.bincount(batch[shared], minlength=len(sizes)))
        columns = {"row": _cut(row[shared], ends), "low": _cut(low[shared], ends), "n": _cut(n[shared].astype("<u4"), ends)}
        return pa.table({**{c: part[c] for c in ("grp", "base", "ids", "sizes", "emitted")}, **columns}).select(["grp", "base", "row", "low", "n", "ids", "sizes", "emitted"])

    kind = dealt.schema["ids"].dataType.simpleString()
    return dealt.groupBy("grp").applyInArrow(run, f"grp int, base long, row binary, low binary, n binary, ids {kind}, sizes array<long>, emitted array<long>")


def _placed(counted: DataFrame, enum: PartEnum) -> DataFrame:
    """``sig, id, n, place`` of the signatures that stand near enough to the front of their set."""

    def run(part: pa.Table) -> pa.Table:
        (low, sizes), (row, _), (n, _) = (_joined(part[c], t) for c, t in (("low", "<u4"), ("row", "<u2"), ("n", "<u4")))
        sig = np.repeat(part["grp"].to_numpy().astype(np.int64) << 32, sizes) + low
        at = next(i for i, found in enumerate(part["sizes"].is_valid().to_pylist()) if found)
        ids = part["ids"][at].values
        size, emitted = (part[c][at].values.to_numpy() for c in ("sizes", "emitted"))
        order = np.lexsort((sig, n, row))
        sig, row = sig[order], row[order]
        shared = np.bincount(row, minlength=len(size))  # what a row shares with none comes first
        place = np.arange(len(row)) - (np.cumsum(shared) - shared)[row] + (emitted - shared)[row] + 1
        near = place <= enum.front(size)[row]
        row = row[near]
        return pa.table({"sig": sig[near], "id": ids.take(pa.array(row)), "n": size[row], "place": place[near]})

    kind = counted.schema["ids"].dataType.elementType.simpleString()
    return counted.groupBy("base").applyInArrow(run, f"sig long, id {kind}, n long, place long")


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """Per row of ``id, text``: the size and the whole set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                sets = [shingles(known.of(words_of(t, fold=True)), size) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["id", "n", "whole"],
                )

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, n long, whole binary")


def _compared(pairs: DataFrame, sets_a: DataFrame, sets_b: DataFrame, differing) -> DataFrame:
    """The pairs ``a, b`` whose sets differ in at most ``differing(size, size)`` elements."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y, n, m = batch.columns
            keep = []
            for u, v, p, q in zip(x.to_pylist(), y.to_pylist(), n.to_pylist(), m.to_pylist()):
                u, v = np.frombuffer(u, "<u8"), np.frombuffer(v, "<u8")
                both = np.sort(np.concatenate((u, v)), kind="stable")  # two sorted runs: a merge
                keep.append(len(u) + len(v) - 2 * int((both[1:] == both[:-1]).sum()) <= differing(p, q))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], ["a", "b"])

    kind = pairs.schema["a"].dataType.simpleString()
    left = sets_a.select(F.col("id").alias("a"), F.col("whole").alias("x"), "n")
    right = sets_b.select(F.col("id").alias("b"), F.col("whole").alias("y"), F.col("n").alias("m"))
    loaded = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y", "n", "m")
    return loaded.mapInArrow(run, f"a {kind}, b {kind}").distinct()


def similar_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    enum: PartEnum = PartEnum(),
) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_shingles`` and ``component_id``.

    Words are runs of anything but ASCII white space, with A-Z lower-cased; a text with
    fewer than ``size`` words has all of them as its one shingle, one without words has an
    empty set and no links, as has a null text. ``component_id`` is the smallest id that
    links reach, itself included. Rows that repeat an id are one document for links. A row
    with a null id has no links and a null component. Other columns make no difference, and
    an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "shingle-join")
    lean = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = scratch.store(_shapes(lean, size), "rows")

    # equal sets are one node, named by its smallest id
    full = rows.where("n > 0 and id is not null")
    key = ["n", "f1", "f2"]
    nodes = scratch.store(full.groupBy(*key).agg(F.min("id").alias("node")), "nodes")
    of_row = scratch.store(full.select("id", *key).join(nodes, key).select("id", "node").distinct(), "node-of-row")
    first = of_row.groupBy("id").agg(F.min("node").alias("first"), F.max("node").alias("last"))
    first = scratch.store(first, "first-node")
    tied = of_row.join(first.where("first != last"), "id").where("node != first").select(F.col("node").alias("a"), F.col("first").alias("b"))

    links = scratch.store(tied.unionByName(_links(lean, nodes, size, enum, scratch)), "links")
    labels = components(links, scratch).withColumnRenamed("node", "first")
    labelled = scratch.store(first.join(labels, "first", "left").select("id", F.coalesce("label", "first").alias("component_id")), "labelled")
    return rows.select("id", "n").join(labelled, "id", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")
    )


def _links(lean: DataFrame, nodes: DataFrame, size: int, enum: PartEnum, scratch: Scratch) -> DataFrame:
    """Enough of the similar pairs ``a, b`` of nodes that their components are those of all."""
    # A copy whose bit is set by chance is one more node; its equal signatures link it again.
    named = scratch.store(bitmap_of(nodes.select("node")), "named")
    texts = with_flag(lean.where("id is not null"), named, [F.col("id")], "_node").where("_node").select("id", "text")
    elements = nodes.agg(F.sum("n")).first()[0] or 0
    bits = max(GROUP_BITS, (elements // GROUP_ELEMENTS).bit_length())
    dealt = _dealt(texts.select(F.monotonically_increasing_id().alias("uid"), "id", "text"), size, bits)
    placed = scratch.store(_placed(_counted(dealt), enum), "placed")
    shared = placed.groupBy("sig").agg(F.count(F.lit(1)).alias("bucket")).where("bucket > 1")
    members = scratch.store(placed.join(shared, "sig"), "members")

    needed = scratch.store(bitmap_of(members.select("id").distinct()), "needed")
    sets = scratch.store(_sets(with_flag(texts, needed, [F.col("id")], "_needed").where("_needed").select("id", "text"), size), "sets")
    fame = scratch.store(members.groupBy("id").agg(F.sum("bucket").alias("fame")), "fame")
    # both sides of the joins with members grow with the input: one plan for every size
    members = members.join(fame.hint("merge"), "id").select("sig", "id", "n", "place", "fame", F.col("id").alias("comp"))
    members = scratch.store(members, "ranked")

    links = None
    for r in range(ROUNDS):
        order = F.struct(F.col("fame") if r == 0 else F.xxhash64("id", F.lit(r)), "id", "n", "place", "comp")
        leader = members.groupBy("sig").agg(F.max(order).alias("l")).select("sig", *[F.col(f"l.{c}").alias(f"b_{c}") for c in ("id", "n", "place", "comp")])
        leader = scratch.store(leader, f"leaders-{r}")  # tables on both sides: AQE can split a large bucket
        new = _verified(_met(members, leader, F.col("comp") != F.col("b_comp"), enum), sets, enum, scratch, f"led-{r}")
        if r and new.isEmpty():
            break
        links = scratch.store(links.unionByName(new), f"links-{r}") if r else new
        comp = components(links, scratch, f"comp-{r}").select(F.col("node").alias("id"), F.col("label").alias("_label"))
        members = members.join(comp.hint("merge"), "id", "left").select("sig", "id", "n", "place", "fame", F.coalesce("_label", "comp").alias("comp"))
        members = scratch.store(members, f"by-component-{r}")
        sides = members.groupBy("sig", "comp").agg(F.count(F.lit(1)).alias("side"))
        heads = sides.groupBy("sig").agg(F.max(F.struct("side", "comp")).alias("h"), F.sum("side").alias("bucket"))
        heads = heads.select("sig", F.col("h.comp").alias("head"), (F.col("bucket") - F.col("h.side")).alias("others"), "bucket").where("others > 0")
        heads = scratch.store(heads, f"heads-{r}")
        members = scratch.store(members.join(heads, "sig").drop("others", "bucket"), f"open-{r}")
        left = heads.agg(F.sum("bucket"), F.sum(F.col("others").cast("double") * F.col("bucket"))).first()
        members, minor = members.drop("head"), members
        if not left[0] or left[1] <= LOOKED_AT * left[0]:
            break
    # of two members of a bucket that are to meet, one is not in its largest component
    minor = scratch.store(minor.where("comp != head"), "minor")
    side = members.select("sig", *[F.col(c).alias(f"b_{c}") for c in ("id", "n", "place", "comp")])
    differ = (F.col("comp") != F.col("b_comp")) & ((F.col("b_comp") == F.col("head")) | (F.col("comp") < F.col("b_comp")))
    return links.unionByName(_verified(_met(minor, side, differ, enum), sets, enum, scratch, "rest"))


def _met(members: DataFrame, others: DataFrame, differ: Column, enum: PartEnum) -> DataFrame:
    """Members of buckets and others there, where two similar sets could meet for the first time."""
    common = enum.common(F.col("n"), F.col("b_n"))
    near = (F.col("place") + common <= F.col("n") + 1) & (F.col("b_place") + common <= F.col("b_n") + 1)
    return members.join(others, "sig").where(differ & near)


def _verified(met: DataFrame, sets: DataFrame, enum: PartEnum, scratch: Scratch, name: str) -> DataFrame:
    """The similar ones of the pairs ``id, b_id`` that meet in buckets."""
    pairs = scratch.store(met.select(F.col("id").alias("a"), F.col("b_id").alias("b")).distinct(), f"pairs-{name}")
    percent = enum.percent
    kept = []
    for end in ("a", "b"):  # only sets that are compared are moved
        bits = scratch.store(bitmap_of(pairs.select(end).distinct()), f"{end}-{name}")
        kept.append(with_flag(sets, bits, [F.col("id")], "_needed").where("_needed").drop("_needed"))
    allowed = lambda n, m: (n + m) * (100 - percent) // (100 + percent)
    return scratch.store(_compared(pairs, *kept, allowed), f"found-{name}")
