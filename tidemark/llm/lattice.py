"""SentencePiece encoding and decoding on a relational lattice.

A text, with spaces as U+2581 and one in front, falls into words: runs of that mark with the
characters up to the next. No piece of the vocabulary goes over such a border, so each
distinct word is segmented once. Documents are encoded by units: a word is cut further where
no piece has the two characters side by side. Its substrings up to the longest piece are exploded and
equi-joined to the piece table; what matches are the edges of the word's lattice. The edges
are grouped by word, and a higher-order fold over the end positions keeps the best path to
each: the fewest pieces, then the largest sum of piece scores. A character without a piece
is an edge of its UTF-8 bytes.

The piece table has a fixed size, that of the vocabulary, and is broadcast. Words are dealt
by their hash before they are exploded, so edges are grouped where they arise.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch

MARK = "▁"
WORDS = f"{MARK}*[^{MARK}]+|{MARK}+"
FREQUENT_WORDS = 1 << 18  # of these the ids go to all workers
COUNTED_WORDS = 1 << 17  # distinct words that a worker holds before it passes their counts on
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000  # texts that a task and its worker hold at once, each several times over
TASK_WORDS = 20_000  # so that the edges of a task are grouped in memory
FOLD_CHARS = 64  # longer words are segmented by the same rule in a Python worker


@dataclass(frozen=True)
class Vocabulary:
    """``pieces`` maps a piece to id and score; ``bytes_from`` is the id of the byte 0x00."""

    pieces: dict[str, tuple[int, float]]
    bytes_from: int

    @property
    def longest(self) -> int:
        return max(map(len, self.pieces))

    @property
    def units(self) -> str | None:
        """A pattern that cuts a word into units; no piece goes over a border of two.

        Characters that follow one another in a piece are of one class, and a unit is a run
        of one class with the marks in front. Counts of pieces add up over units, sums of
        scores only if they are exact, so there are none unless the scores are whole numbers.
        """
        if not all(float(score).is_integer() for _, score in self.pieces.values()):
            return None
        above: dict[str, str] = {}

        def root(char: str) -> str:
            while above.setdefault(char, char) != char:
                char = above[char]
            return char

        for piece in self.pieces:
            rest = piece.lstrip(MARK)
            if MARK in rest:
                return None
            for a, b in zip(rest, rest[1:]):
                above[root(a)] = root(b)
        classes: dict[str, list[str]] = {}
        for char in sorted(above):
            classes.setdefault(root(char), []).append(re.escape(char))
        runs = "".join(f"[{''.join(c)}]+|" for c in sorted(classes.values(), key=len, reverse=True))
        return f"{MARK}*(?:{runs}[^{MARK}])|{MARK}+"


def read_vocabulary(model_file: str) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    ids = range(model.get_piece_size())
    plain = {model.id_to_piece(i): (i, model.get_score(i)) for i in ids if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))}
    return Vocabulary(plain, model.piece_to_id("<0x00>"))


def marked(text: Column) -> Column:
    """The text with the mark for spaces; the empty text has none in front."""
    return F.when(text == "", text).otherwise(F.concat(F.lit(MARK), F.replace(text, F.lit(" "), F.lit(MARK))))


def split_words(text: Column) -> Column:
    return F.regexp_extract_all(marked(text), F.lit(WORDS), F.lit(0))


def _bytes_of(char: Column, bytes_from: int) -> Column:
    digits = F.hex(F.encode(char, "UTF-8"))
    at = F.sequence(F.lit(1), F.length(digits) - 1, F.lit(2))
    return F.transform(at, lambda i: F.conv(F.substring(digits, i, F.lit(2)), 16, 10).cast("int") + bytes_from)


def _best_path(word: Column, edges: Column, length: Column, bytes_from: int) -> Column:
    """The ids on the best path; ``edges`` have ``upto, since, id, score``, without an id for bytes."""
    kind = "array<struct<cost:int,score:double,ids:array<int>>>"
    start = F.array(F.struct(F.lit(0).alias("cost"), F.lit(0.0).alias("score"), F.array().cast("array<int>").alias("ids"))).cast(kind)

    def step(best: Column, upto: Column) -> Column:
        def path(e: Column) -> Column:
            b = F.get(best, e["since"])
            ids = F.when(e["id"].isNotNull(), F.array(e["id"])).otherwise(_bytes_of(F.substring(word, e["since"] + 1, F.lit(1)), bytes_from))
            return F.struct((b["cost"] - F.size(ids)).alias("cost"), (b["score"] + e["score"]).alias("score"), F.concat(b["ids"], ids).alias("ids"))

        here = F.transform(F.filter(edges, lambda e: e["upto"] == upto), path)
        return F.array_append(best, F.array_max(here)).cast(kind)

    return F.get(F.aggregate(F.sequence(F.lit(1), length), start, step), length)["ids"]


# A path is its last id: the path before, how many ids, the id, and a path further back, so
# that where two paths part is found in few steps.
def _longer(path: tuple, ids: tuple) -> tuple:
    for i in ids:
        jump = path[3]
        path = (path, path[1] + 1, i, jump[3] if path[1] - jump[1] == jump[1] - jump[3][1] else path)
    return path


def _greater(a: tuple, b: tuple) -> bool:
    """Whether the ids of ``a`` are greater than those of ``b``, another path of as many ids."""
    while a[0] is not b[0]:
        at = 0 if a[3] is b[3] else 3
        a, b = a[at], b[at]
    return a[2] > b[2]


def segment(word: str, vocabulary: Vocabulary) -> list[int]:
    """The same path for one word; the ids settle ties as the fold's comparison does."""
    none: list = [None, 0, -1, None]
    none[3] = none
    best = [(0, 0.0, none)]
    window = vocabulary.longest
    for upto in range(1, len(word) + 1):
        top = None
        for since in range(max(0, upto - window), upto):
            found = vocabulary.pieces.get(word[since:upto])
            if not found and upto - since > 1:
                continue
            cost, score, path = best[since]
            ids = (found[0],) if found else tuple(vocabulary.bytes_from + b for b in word[since].encode())
            value = cost - len(ids), score + (found[1] if found else 0.0)
            if top is None or value > top[0] or (value == top[0] and _greater(_longer(path, ids), _longer(*top[1:]))):
                top = value, path, ids
        best.append((*top[0], _longer(*top[1:])))
        if upto > window:
            best[upto - window - 1] = None  # out of reach
    out, path = [], best[-1][2]
    while path is not none:
        out.append(path[2])
        path = path[0]
    return out[::-1]


def segment_words(words: DataFrame, vocabulary: Vocabulary, max_chars: int = FOLD_CHARS) -> DataFrame:
    """``word, ids`` of the distinct, non-empty ``word`` s."""
    spark = words.sparkSession
    table = spark.createDataFrame([(p, i, s) for p, (i, s) in vocabulary.pieces.items()], "piece string, id int, score double")
    tasks = -(-words.count() // TASK_WORDS) or 1
    short = words.where(F.length("word") <= max_chars).repartition(tasks, "word").withColumn("length", F.length("word"))
    spots = short.select("word", "length", F.explode(F.sequence(F.lit(0), F.col("length") - 1)).alias("since"))
    widest = F.least(F.lit(vocabulary.longest), F.col("length") - F.col("since"))
    spots = spots.select("word", "length", "since", F.explode(F.sequence(F.lit(1), widest)).alias("chars"))
    spots = spots.withColumn("part", F.substring("word", F.col("since") + 1, F.col("chars")))
    joined = spots.join(F.broadcast(table), spots["part"] == table["piece"], "left").where(F.col("id").isNotNull() | (F.col("chars") == 1))
    edge = F.struct((F.col("since") + F.col("chars")).alias("upto"), "since", "id", F.coalesce("score", F.lit(0.0)).alias("score"))
    lattice = joined.groupBy("word", "length").agg(F.collect_list(edge).alias("edges"))  # bounded by the word's length
    folded = lattice.select("word", _best_path(F.col("word"), F.col("edges"), F.col("length"), vocabulary.bytes_from).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [segment(w, vocabulary) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], ["word", "ids"])

    longer = words.where(F.length("word") > max_chars).select("word").mapInArrow(run, "word string, ids array<int>")
    return folded.unionByName(longer)


def _stored(scratch: Scratch, df: DataFrame, name: str) -> DataFrame:
    """``store``, with at most ``BATCH_ROWS`` rows at once in the Python workers."""
    conf = scratch.spark.conf
    before = conf.get(BATCH)
    conf.set(BATCH, str(min(int(before), BATCH_ROWS) if int(before) > 0 else BATCH_ROWS))
    try:
        return scratch.store(df, name)
    finally:
        conf.set(BATCH, before)


def word_counts(docs: DataFrame, text_col: str = "text", units: str | None = None) -> DataFrame:
    """``word, n`` over all texts, or of the words' ``units``, added up in the workers before the
    shuffle; a worker passes its counts on whenever it holds ``COUNTED_WORDS`` words."""
    cut = _cutter(units)

    def counted(words: Counter) -> pa.RecordBatch:
        counts = Counter() if units else words
        for word, n in words.items() if units else ():
            for unit in cut(word):
                counts[unit] += n
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Counter()
        for part in _slices(batches):
            for text in part.column(0).to_pylist():
                words.update(_words_of(text))
            if len(words) >= COUNTED_WORDS:
                yield counted(words)
                words = Counter()
        yield counted(words)

    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def encode_vocabulary(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text") -> DataFrame:
    """``word, n, ids`` of every distinct word of all texts. Null and empty texts have none."""
    scratch = Scratch(docs.sparkSession, "lattice")
    counts = _stored(scratch, word_counts(docs, text_col), "counts")
    ids = _stored(scratch, segment_words(counts.select("word"), vocabulary), "ids")
    return counts.join(ids, "word")


def _words_of(text: str) -> list[str]:
    """What ``split_words`` gives."""
    if not text:
        return []
    if MARK in text or "  " in text or text[0] == " " or text[-1] == " ":
        return re.findall(WORDS, MARK + text.replace(" ", MARK))
    return (MARK + text.replace(" ", " " + MARK)).split(" ")


def _cutter(units: str | None) -> Callable[[str], list[str]]:
    return re.compile(units).findall if units else lambda word: [word]


def _frequent(counts: DataFrame, ids: DataFrame, most: int) -> dict[str, list[int]]:
    """The ids of the most frequent words, ``most`` of them at the most."""
    level = F.floor(F.log2("n") * 16)
    chosen, least = 0, None
    for row in sorted(counts.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"]):
        chosen += row["count"]
        if chosen > most:
            break
        least = row["level"]
    if least is None:
        return {}
    return {r.word: list(r.ids) for r in counts.where(level >= least).join(ids, "word").select("word", "ids").collect()}


def encode_documents(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT_WORDS) -> DataFrame:
    """One row per row of ``docs``: the id and ``ids``.

    A null text is the empty text, which has no ids. Rows may repeat ids or have none; other
    columns make no difference. The ids of the ``frequent`` most frequent units go to all
    workers, which leave a hole for each other unit. Those are joined, once per row, to their
    ids and stored, so that no shuffle of words is left on disk when the packed rows are
    shuffled and the holes filled. Rows are matched by a 64-bit hash of id and text; equal
    rows have equal ids, and a collision is an error.
    """
    scratch = Scratch(docs.sparkSession, "encode")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    units = vocabulary.units
    cut = _cutter(units)
    counts = _stored(scratch, word_counts(rows, units=units), "counts")
    last_id = max(vocabulary.bytes_from + 255, *(i for i, _ in vocabulary.pieces.values()))
    small = "smallint" if last_id < 1 << 15 else "int"
    known = _stored(scratch, segment_words(counts.select("word"), vocabulary).select("word", F.col("ids").cast(f"array<{small}>").alias("ids")), "words")
    wide = "<u2" if last_id < 0xFFFF else "<u4"
    hole = np.iinfo(wide).max
    common = {w: np.array(ids, wide).tobytes() for w, ids in _frequent(counts, known, frequent).items()}
    gap = np.array([hole], wide).tobytes()
    scratch.drop("counts")
    kind = rows.schema["id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            packed = []
            for text in part.column(1).to_pylist():
                words = _words_of(text)
                out = [*map(common.get, words)]
                others, holes = {}, []
                for i in [i for i, ids in enumerate(out) if ids is None]:
                    inner = []
                    for unit in cut(words[i]):
                        ids = common.get(unit)
                        if ids is None:
                            ids = gap
                            holes.append(others.setdefault(unit, len(others)))
                        inner.append(ids)
                    out[i] = b"".join(inner)
                packed.append(_packed(holes, b"".join(out)))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(packed, pa.binary())], ["row", "id", "packed"])

    def rare_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            row, places, words = [], [], []
            for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                others = dict.fromkeys(u for w in _words_of(text) if w not in common for u in cut(w) if u not in common)
                row += [key] * len(others)
                places += range(len(others))
                words += others
            yield pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), pa.array(places, pa.int32()), pa.array(words, pa.string())], ["row", "place", "word"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            entries = part.column(2).flatten()  # the places and ids of all the slice's rows
            place = entries.field("place").to_numpy()
            length = entries.field("ids").value_lengths().to_numpy()
            values = entries.field("ids").flatten().to_numpy()
            first = np.cumsum(length) - length
            found, at = [], 0
            for packed, n in zip(part.column(1).to_pylist(), part.column(2).value_lengths().fill_null(0).to_pylist()):
                holes, frame = _unpacked(packed)
                ids = np.frombuffer(frame, wide).astype(np.int32)
                if n != (holes.max() + 1 if len(holes) else 0) or not np.array_equal(np.sort(place[at : at + n]), np.arange(n)):
                    raise ValueError("two different rows have the same hash of id and text, or a word has no ids")
                if n:
                    entry = (np.argsort(place[at : at + n]) + at)[holes]
                    ids = _filled(ids, np.flatnonzero(ids == hole), values, first[entry], length[entry])
                found.append(ids)
                at += n
            ends = np.cumsum([0, *map(len, found)])
            joined = np.concatenate(found) if found else np.array([], np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(joined, pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column(0), lists], ["id", "ids"])

    keyed = rows.select(F.xxhash64("id", "text").alias("row"), "text", "id")
    rare = keyed.select("row", "text").mapInArrow(rare_units, "row long, place int, word string")
    filling = _stored(scratch, rare.join(known, "word").select("row", "place", "ids"), "filling")
    scratch.drop("words")
    packed = keyed.mapInArrow(pack, f"row long, id {kind}, packed binary")
    parts = filling.groupBy("row").agg(F.collect_set(F.struct("place", "ids")).alias("parts"))
    whole = packed.join(parts, "row", "left").select("id", "packed", "parts")
    return whole.mapInArrow(fill, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def _packed(holes: list[int], frame: bytes) -> bytes:
    """The rare unit of each hole of a row, and the row's ids."""
    return zlib.compress(struct.pack("<I", len(holes)) + np.array(holes, "<u4").tobytes() + frame, 1)


def _unpacked(packed: bytes) -> tuple[np.ndarray, bytes]:
    raw = zlib.decompress(packed)
    end = 4 + 4 * struct.unpack_from("<I", raw)[0]
    return np.frombuffer(raw[4:end], "<u4"), raw[end:]


def _filled(ids: np.ndarray, at: np.ndarray, values: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """``ids`` with ``length`` of the ``values`` from ``first`` on in place of each one ``at``."""
    sizes = np.ones(len(ids), np.int64)
    sizes[at] = length
    out = np.repeat(ids, sizes)
    step = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    out[np.repeat((np.cumsum(sizes) - sizes)[at], length) + step] = values[np.repeat(first, length) + step]
    return out


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids") -> DataFrame:
    """Adds ``decoded``: the text of the ids, without the mark in front; exact for any text
    that does not hold the mark itself."""
    raw_of = {i: p.encode() for p, (i, _) in vocabulary.pieces.items()} | {vocabulary.bytes_from + b: bytes([b]) for b in range(256)}
    raws = [raw_of.get(i) for i in range(max(raw_of) + 1)]
    fields = [*encoded.schema.fieldNames(), "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array(raws, pa.large_binary())
        for batch in _slices(batches):
            ids = batch.column(batch.schema.get_field_index(ids_col))
            found = table.take(ids.flatten())
            if found.null_count:
                raise ValueError("an id is not in the vocabulary")
            ends = np.concatenate([[0], np.cumsum(pc.binary_length(found).to_numpy())])
            raw = found.buffers()[2].to_pybytes() if len(found) else b""
            upto = np.cumsum([0, *ids.value_lengths().fill_null(0).to_pylist()])
            texts = []
            for lo, hi in zip(ends[upto[:-1]].tolist(), ends[upto[1:]].tolist()):
                text = raw[lo:hi].decode("utf-8", "replace").replace(MARK, " ")
                texts.append(text[1:] if text.startswith(" ") else text)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], fields)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(run, f"{schema}, decoded string")
