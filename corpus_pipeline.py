"""From raw documents to packed training sequences.

Each stage takes what its predecessor kept, written as Parquet and read again; its decisions
take effect. All stages but the last keep the columns of ``documents`` as they are; the last
returns the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bitmaps import bitmap_of, left_over, with_flag
from tidemark.llm.columns import ascii_lower, text_of
from tidemark.llm.exact_dedup import exact_duplicates
from tidemark.llm.packing import best_fit_packing
from tidemark.llm.queries import byte_bpe_encoder, toxicity_machine
from tidemark.llm.scratch import Scratch
from tidemark.llm.secrets import find_secrets
from tidemark.llm.shingle_join import similar_components
from tidemark.llm.spans import blocks_of, let, scanned
from tidemark.llm.toxicity import score_toxicity
from tidemark.operators.dedup import first_per_key

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
MASK = "[secret]"


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine takes for toxic go. It learns as in op3."""
    scored = score_toxicity(docs, toxicity_machine(spark, sf_dir), keep=docs.columns)
    return scored.where("score < 0.5").select("row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays, one with the largest doc_id; a null id loses.

    A row is known by its id and its text, so rows that repeat an id with other texts are
    judged on their own, and of rows that repeat both one stays.
    """
    scratch = Scratch(spark, "exact")
    key = F.sha2(ascii_lower(text_of("text")), 256)
    found = scratch.store(exact_duplicates(docs, carry={"_key": key}).where("group_size > 1"), "found")
    gone = scratch.store(found.where("not kept").select("doc_id", "_key").distinct(), "gone")
    many = found.where("kept").groupBy("doc_id", "_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    many = scratch.store(bitmap_of(many.select("doc_id", "_key")), "many")
    sure, doubtful = left_over(docs.withColumn("_key", key), gone, scratch)
    sure = with_flag(sure, many, [F.col("doc_id"), F.col("_key")], "_many")
    # rows that share their bit by chance are the only ones of their key, and stay as they are
    repeated = sure.where("_many").drop("_many").unionByName(doubtful)
    alone = sure.where("not _many").drop("_many", "_key")
    return alone.unionByName(first_per_key(repeated, ["doc_id", "_key"]).drop("_key"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one with the smallest doc_id stays.

    Rows that share their id with others, or have none, are documents of their own, and
    give way to those whose id is theirs alone.
    """
    scratch = Scratch(spark, "near")
    shared = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 and doc_id is not null").select("doc_id")
    flagged = with_flag(docs, scratch.store(bitmap_of(shared), "shared"), [F.col("doc_id")], "_shared")
    # 62 bits of a hash of id and text, above all ids in use
    other = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2)
    own = flagged.withColumn("_own", F.when(F.col("_shared") | F.col("doc_id").isNull(), other).otherwise(F.col("doc_id"))).drop("_shared")
    linked = similar_components(own.select(F.col("_own").alias("doc_id"), "text"))
    gone = scratch.store(linked.where("component_id < doc_id").select(F.col("doc_id").alias("_own")).distinct(), "gone")
    sure, doubtful = left_over(own, gone, scratch)
    return sure.unionByName(doubtful).drop("_own")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked. Where spans of several kinds overlap, their union is one mask.

    ``n_chars`` stays what the source said of the original.
    """
    found = find_secrets(docs, carry=docs.columns)
    return found.select(*[_masked(F.col("row.text")).alias(c) if c == "text" else F.col(f"row.{c}") for c in docs.columns])


def _masked(whole: Column) -> Column:
    """The text with a mask in place of each stretch that spans cover.

    Pieces between masks are cut from what a block of them spans, so the work is in
    proportion to the text, however many masks it gets.
    """
    text = F.coalesce(whole, F.lit(""))
    piece = lambda at, s: (F.greatest(at, s["end"]), F.struct(at.alias("from"), s["start"].alias("to")))
    between = F.filter(scanned(F.col("secrets"), F.lit(0), piece, "int", "struct<from:int,to:int>"), lambda p: p["from"] <= p["to"])
    last = F.struct(F.array_max(F.transform("secrets", lambda s: s["end"])).alias("from"), F.length(text).alias("to"))

    def cut(block: Column) -> Column:
        low, high = block[0]["from"], F.element_at(block, -1)["to"]
        part = F.substring(text, low + 1, high - low)
        return let(part, lambda t: F.transform(block, lambda p: F.substring(t, p["from"] - low + 1, p["to"] - p["from"])))

    pieces = F.flatten(F.transform(blocks_of(F.concat(between, F.array(last))), cut))
    return F.when(F.size("secrets") == 0, whole).otherwise(F.array_join(pieces, MASK))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids and their places."""
    return best_fit_packing(docs, byte_bpe_encoder())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES:
        docs = scratch.store(stage(spark, docs, sf_dir), name)
    return docs


# The learned scores, the link classes and the packing are beyond SQL.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
