"""Packing of token sequences: best fit within blocks, then swap-based local search.

Pieces shorter than a sequence are dealt to blocks of bounded size. In a block, best-fit
decreasing gives the first bins; then underfull bins give pieces to fuller ones by moves,
one-for-one and two-for-one exchanges. Each exchange increases the sum of squared fills, so
free space gathers in few bins until they are empty; it goes on until none helps. The pieces
of bins that are still underfull go on to the next round, where they meet those of other
blocks, as long as that saves a sequence.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Callable, Iterator
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch

BLOCK_PIECES = 8192


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Largest first, each into the fullest bin that has room; the bins as lists of indexes."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has room r
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        by_room[room - size].append(b)
        rooms |= 1 << (room - size)
    return bins


class _Bins:
    """Underfull bins with an index: for every size, the emptiest bin that can give it.

    A bin gives one piece or two. Entries of a bin that has changed since are dropped when
    they come up.
    """

    def __init__(self, bins: list[list[int]], sizes: list[int], capacity: int):
        self.capacity = capacity
        self.held: list[dict[int, list[int]]] = []
        for b in bins:
            held: dict[int, list[int]] = {}
            for i in b:
                held.setdefault(sizes[i], []).append(i)
            self.held.append(held)
        self.fills = [sum(sizes[i] for i in b) for b in bins]
        self.version = [0] * len(bins)
        self.by_size: tuple[list, list] = tuple([[] for _ in range(capacity + 1)] for _ in range(2))
        self.given = [0, 0]  # bit s: some bin may give one piece (two pieces) of size s
        for b in range(len(bins)):
            self._enter(b)

    def pairs(self, b: int) -> set[int]:
        held = self.held[b]
        found = {s + t for s in held for t in held if s < t}
        return found | {2 * s for s, pieces in held.items() if len(pieces) > 1}

    def _enter(self, b: int) -> None:
        fill = self.fills[b]
        if not 0 < fill < self.capacity:
            return
        for kind, values in enumerate((self.held[b], self.pairs(b))):
            for s in values:
                heappush(self.by_size[kind][s], (fill, b, self.version[b]))
                self.given[kind] |= 1 << s

    def _donor(self, kind: int, size: int, x: int) -> int | None:
        """The emptiest bin but ``x`` that gives ``size`` and is not fuller than ``x``."""
        heap, own, found = self.by_size[kind][size], None, None
        while heap:
            fill, b, version = heap[0]
            if version != self.version[b]:
                heappop(heap)
            elif b == x:
                own = heappop(heap)
            else:
                found = b if fill <= self.fills[x] else None
                break
        if own:
            heappush(heap, own)
        if not heap:
            self.given[kind] &= ~(1 << size)
        return found

    def fill_up(self, x: int) -> bool:
        """The exchange that fills ``x`` the most, if one helps."""
        held, room = self.held[x], self.capacity - self.fills[x]
        best = None
        for kind, gives in ((0, {0, *held}), (1, held), (0, self.pairs(x))):
            for give in gives:
                least = best[0] if best else 0
                wanted = (self.given[kind] >> (give + least + 1)) & ((1 << (room - least)) - 1)
                while wanted:
                    top = wanted.bit_length() - 1
                    size = give + least + 1 + top
                    y = self._donor(kind, size, x)
                    if y is not None:
                        best = (size - give, y, kind, size, give)
                        break
                    wanted ^= 1 << top
                if best and best[0] == room:
                    break
            if best and best[0] == room:
                break
        if not best:
            return False
        gain, y, kind, size, give = best
        out = () if not give else (give,) if give in held else self._parts(x, give)
        into = self._parts(y, size) if kind else (size,)
        self._move(x, y, out)
        self._move(y, x, into)
        self.fills[x] += gain
        self.fills[y] -= gain
        for b in (x, y):
            self.version[b] += 1
            self._enter(b)
        return True

    def _parts(self, b: int, total: int) -> tuple[int, int]:
        held = self.held[b]
        return next((s, total - s) for s in held if total - s in held and (2 * s != total or len(held[s]) > 1))

    def _move(self, a: int, b: int, sizes: tuple) -> None:
        for s in sizes:
            self.held[b].setdefault(s, []).append(self.held[a][s].pop())
            if not self.held[a][s]:
                del self.held[a][s]


def local_search(bins: list[list[int]], sizes: list[int], capacity: int) -> list[list[int]]:
    """Exchanges pieces between underfull bins until none helps."""
    fill = lambda b: sum(sizes[i] for i in b)
    full = [b for b in bins if fill(b) == capacity]
    work = _Bins([b for b in bins if 0 < fill(b) < capacity], sizes, capacity)
    moved = True
    while moved:
        moved = False
        for x in sorted(range(len(work.fills)), key=lambda b: -work.fills[b]):
            while 0 < work.fills[x] < capacity and work.fill_up(x):
                moved = True
    return full + [[i for pieces in held.values() for i in pieces] for held in work.held if held]


def pack(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    return local_search(best_fit(sizes, capacity), sizes.tolist(), capacity)


def pieces_of(docs: DataFrame, encoder: Callable[[], Callable], end_id: int, capacity: int) -> DataFrame:
    """Per piece: ``id, piece, start, length, ids_crc32, ids`` in the order of the tokens.

    Only the first piece may be shorter than ``capacity``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                row, piece, start, length, crc, data = [], [], [], [], [], []
                for r, text in enumerate(part.column(1).to_pylist()):
                    ids = encode(text or "")
                    ids.append(end_id)
                    cut = len(ids) % capacity or capacity
                    edges = [0, *range(cut, len(ids) + 1, capacity)]
                    raw = memoryview(np.frombuffer(ids, np.uint32).astype("<u4").tobytes())
                    for p, (a, b) in enumerate(zip(edges, edges[1:])):
                        row.append(r)
                        piece.append(p)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(raw[4 * a : 4 * b]))
                        data.append(bytes(raw[4 * a : 4 * b]))
                columns = [
                    part.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(data, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "piece", "start", "length", "ids_crc32", "ids"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long, ids binary")


def _packed(items: DataFrame, capacity: int, blocks: int, round_no: int) -> DataFrame:
    """``uid, length, block, bin, offset, fill`` after packing each block on its own."""

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("uid", ignore_index=True)
        bins = pack(part["length"].to_numpy(), capacity)
        order = np.array([i for b in bins for i in b])
        number = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
        out = part.iloc[order].assign(bin=number)
        out["offset"] = out.groupby("bin")["length"].cumsum() - out["length"]
        out["fill"] = out.groupby("bin")["length"].transform("sum")
        return out[["uid", "length", "block", "bin", "offset", "fill"]]

    block = F.pmod(F.xxhash64("uid", F.lit(round_no)), F.lit(blocks)).alias("block")
    dealt = items.select("uid", "length", block)
    return dealt.groupBy("block").applyInPandas(run, "uid long, length long, block long, bin long, offset long, fill long")


def _numbered(packed: DataFrame, round_no: int) -> DataFrame:
    """With ``sequence_id``: the round, the block and the bin; a block has far fewer than 2**24 pieces."""
    number = F.lit(round_no << 48) + F.shiftleft("block", 24) + F.col("bin")
    return packed.select("uid", number.alias("sequence_id"), "offset")


def best_fit_packing(
    docs: DataFrame,
    encoder: Callable[[], Callable],
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 2,
    capacity: int = 1024,
    block_pieces: int = BLOCK_PIECES,
    keep_ids: bool = True,
) -> DataFrame:
    """One row per piece: the id, ``piece``, ``start``, ``length``, ``ids_crc32``,
    ``sequence_id``, ``offset`` and, with ``keep_ids``, ``ids`` (little-endian 32 bits).

    ``encoder`` makes a function from a text to an array of ids, once in each worker. Every
    row of ``docs`` is a document of its own, null ids and repeated rows too; a null text is
    the empty text, and an empty text is one piece with ``end_id`` only. Sequences hold at
    most ``capacity`` ids without gaps. An empty table gives no pieces.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    pieces = pieces_of(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), encoder, end_id, capacity)
    if not keep_ids:
        pieces = pieces.drop("ids")
    pieces = scratch.store(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces")

    items = pieces.where(F.col("length") < capacity).select("uid", "length")
    waiting, settled, before = items.count(), None, None
    for r in itertools.count():
        blocks = -(-waiting // block_pieces) or 1
        packed = scratch.store(_packed(items, capacity, blocks, r), f"round-{r}")
        starts, under = F.col("offset") == 0, F.col("fill") < capacity
        made, left, waiting = packed.select(F.count_if(starts), F.count_if(starts & under), F.count_if(under)).first()
        saves = before is None or made < before[0]
        if not saves:  # the bins of the round before are as few
            done, last = before[1], True
        else:
            last = blocks == 1 or left == 0
            done = packed if last else packed.where(~under)
            before = left, _numbered(packed.where(under), r)
            done = _numbered(done, r)
        settled = done if settled is None else settled.unionByName(done)
        if last:
            break
        items = packed.where(under).select("uid", "length")
    # a full piece is a sequence by itself; the others number theirs from 0
    alone = pieces.where(F.col("length") == capacity).withColumns({"sequence_id": -1 - F.col("uid"), "offset": F.lit(0).cast("long")})
    # Places are as many as pieces, so they are never broadcast: one plan for every size.
    shared = pieces.where(F.col("length") < capacity).join(settled.hint("merge"), "uid")
    columns = ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if keep_ids else [])]
    return alone.select(columns).unionByName(shared.select(columns)).withColumnRenamed("id", id_col)
