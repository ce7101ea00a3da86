"""The operators as queries over the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.columns import ascii_lower, text_of
from tidemark.llm.exact_dedup import exact_duplicates
from tidemark.llm.fill_middle import fill_in_middle, restored
from tidemark.llm.folds import held_out
from tidemark.llm.hard_negatives import mine_hard_negatives
from tidemark.llm.language import identify_languages, learn_languages
from tidemark.llm.lattice import decode, encode_documents, encode_vocabulary, read_vocabulary
from tidemark.llm.mixing import BITS, UNIT, mix_sources
from tidemark.llm.nn_descent import nearest_neighbours
from tidemark.llm.packing import best_fit_packing
from tidemark.llm.pii import find_personal_data, personal_report
from tidemark.llm.repeats import kept_digest, remove_repeats
from tidemark.llm.secrets import BASE_RULES, RULES, find_secrets, secret_report
from tidemark.llm.shingle_join import similar_components
from tidemark.llm.span_sql import report
from tidemark.llm.tokens import byte_bpe
from tidemark.llm.toxicity import Machine, Settings, learn_toxicity, sample_of, score_toxicity


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(find_secrets(_documents(spark, sf_dir)))


def _secret_condition(rule) -> str:
    if not rule.least:
        return "true"
    pattern = rule.pattern.replace("'", "''")
    return f"length(regexp_extract(m, '{pattern}', {rule.group})) >= {rule.least}"


OP1_SQL = report([(r.kind, r.pattern, _secret_condition(r)) for r in RULES], len(BASE_RULES))


def byte_bpe_encoder():
    """The encoder of the public 50k vocabulary; the files are named, never copied."""
    files = [public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken")]
    return functools.partial(byte_bpe, *files, public_tokenizers.PATTERN)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = best_fit_packing(_documents(spark, sf_dir), byte_bpe_encoder(), keep_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def toxicity_machine(spark: SparkSession, sf_dir: str, settings: Settings = Settings()) -> Machine:
    """Learned from the labelled documents that are not held out, up to ``settings.sample``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    sample = sample_of(labels, _documents(spark, sf_dir), ~held_out(F.col("doc_id")), "doc_id", "toxic", "text", settings.sample)
    return learn_toxicity(sample, settings=settings)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_toxicity(_documents(spark, sf_dir), toxicity_machine(spark, sf_dir))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_report(find_personal_data(_documents(spark, sf_dir)))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct word of all documents: how often it occurs, its ids, and those decoded."""
    vocabulary = read_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    encoded = encode_vocabulary(_documents(spark, sf_dir), vocabulary)
    return decode(encoded, vocabulary).select("word", "n", F.size("ids").alias("n_ids"), F.array_join("ids", " ").alias("ids"), "decoded")


def op5_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded: how many ids, and digests of the ids and the decoded text."""
    vocabulary = read_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    whole = decode(encode_documents(_documents(spark, sf_dir), vocabulary), vocabulary)
    digests = F.md5(F.array_join("ids", " ")).alias("ids_md5"), F.md5("decoded").alias("decoded_md5")
    return whole.select("doc_id", F.size("ids").alias("n_ids"), *digests)


def op6_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(_documents(spark, sf_dir))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 20 == 0)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = learn_languages(docs.where(~held_out(F.col("doc_id"))))
    found = identify_languages(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept_digest(remove_repeats(_documents(spark, sf_dir)))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    digest = F.sha2(ascii_lower(text_of("text")), 256)
    return exact_duplicates(docs, carry={"text_sha256": digest}).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


OP10_SQL = """
WITH folded AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM folded WINDOW g AS (PARTITION BY text_sha256)
"""

def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_in_middle(_documents(spark, sf_dir))
    back = restored(F.col("output"), F.col("form"))
    digests = F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256")
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


OP11_SQL = """
WITH drawn AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id) AS h FROM documents),
numbers AS (
  SELECT doc_id, t, length(t) AS n,
         ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM drawn
),
cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers
),
parts AS (SELECT *, substring(t, 1, a) AS p, substring(t, a + 1, b - a) AS m, substring(t, b + 1, n) AS s FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


OP12_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, length(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents
),
ranked AS (
  SELECT source, sum(size)::BIGINT AS source_size, (2 * sum(size))::BIGINT AS cap,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sized GROUP BY source
),
levels AS (  -- the level if all sources with a smaller cap for their weight are full
  SELECT *, (1.5::DOUBLE * (SELECT sum(size) FROM sized)::DOUBLE
             - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
            / (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level,
         row_number() OVER o AS nth
  FROM ranked WINDOW o AS (ORDER BY cap / weight, source)
),
chosen AS (SELECT level FROM levels WHERE level * weight <= cap ORDER BY nth LIMIT 1),
targets AS (
  SELECT source, source_size, CASE WHEN weight * c.level > cap THEN cap::DOUBLE ELSE weight * c.level END AS target,
         ('0x' || sha256('1:' || coalesce('+' || source, '-'))[1:7])::BIGINT >> {28 - BITS} AS shift
  FROM ranked, chosen c
),
numbered AS (
  SELECT d.*, source_size, target, shift,
         CASE WHEN source_size > 0 THEN floor(target / source_size * {UNIT})::BIGINT ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id) AS nth
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, ((nth * rate + shift) // {UNIT} - ((nth - 1) * rate + shift) // {UNIT}) * size AS taken
FROM numbered
"""


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(vectors.withColumn("label", shifted), F.col("id") % 100 == 0)


OP13_SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND NOT list_contains([isfinite(x) FOR x IN embedding], false)
        AND len([x FOR x IN embedding IF x IS NULL]) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
),
ranked AS (
  SELECT anchor_id, positive_id, positive_score, other_id AS negative_id, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS rank
  FROM positives JOIN scored USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""

QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_toxicity": op3_toxicity,
    "op4_personal_data": op4_personal_data,
    "op5_sentencepiece": op5_documents,  # the words alone are ``op5_sentencepiece``
    "op6_shingle_join": op6_shingle_join,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_language_id": op8_language_id,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_source_mix": op12_source_mix,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE = {
    "op1_secret_scan": OP1_SQL,
    "op10_exact_dedup": OP10_SQL,
    "op11_fill_in_middle": OP11_SQL,
    "op12_source_mix": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
