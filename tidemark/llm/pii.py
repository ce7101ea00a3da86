"""Personal data: fixed expressions, and identifiers found through learned contexts.

The matches of the fixed expressions are seeds. What stands to the left of a seed, a word
and the separator after it, is a lexical pattern. Patterns and the identifier-like tokens
that follow them form a graph, and confidence goes round it: a pattern is as good as the
instances it introduces, an instance as good as the patterns that introduce it. Instances
that no expression matched are reported once a pattern of high confidence introduces them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import ascii_lower, text_of
from tidemark.llm.scratch import Scratch
from tidemark.llm.spans import count_of, in_order, kept_matches, matches, rendered, scanned, span_of

# The expressions of the contract, without backtracking where that changes no
# match, so that neither a long run of letters nor one of digits takes quadratic time or
# deep recursion.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")

# A word, and ahead of it what separates it from the next token and that token, if it holds a
# digit or @. The token is not consumed, so it can be the next one's context.
CONTEXT = r"(?<!\S)(\S++)(?=(\s++)([^\s0-9@]*+[0-9@]\S*+))"
EDGE_TYPE = "struct<pattern:string,instance:string,kind:string,start:int,end:int>"
SEEN_TYPE = "array<struct<start:int,rank:int,end:int,kind:string,word:string,text:string>>"


@dataclass(frozen=True)
class Bootstrap:
    """``rounds`` of scoring; a pattern counts with ``least_seeds`` distinct seed instances,
    is smoothed by ``doubt`` unseen instances and discovers from ``confidence`` on.
    ``least_chars`` is the least length of a discovered instance."""

    rounds: int = 3
    least_seeds: int = 4
    doubt: float = 0.5
    confidence: float = 0.8
    least_chars: int = 6


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _valid_ip(match: Column) -> Column:
    """Each part, without leading zeros, is at most 255."""
    part = lambda p: F.lpad(F.regexp_replace(p, "^0+", ""), F.greatest(F.length(F.regexp_replace(p, "^0+", "")), F.lit(3)), F.lit("0")) <= "255"
    short = lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3
    return F.forall(F.split(match, r"\."), lambda p: short(p) & part(p))


def _luhn(digits: Column) -> Column:
    """Every second digit from the right counts twice, less 9 if above 9."""
    numbers = F.transform(F.split(F.reverse(digits), ""), lambda c: c.try_cast("int"))
    doubled = F.transform(numbers, lambda d, i: F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def _valid_card(match: Column) -> Column:
    digits = _digits(match)
    return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)


def _valid_phone(match: Column) -> Column:
    return F.length(_digits(match)).between(10, 15)


def _base(text: Column) -> Column:
    """The base matches with their texts, by start and kind."""
    rules = ((EMAIL, None), (IP, _valid_ip), (CARD, _valid_card), (PHONE, _valid_phone))

    def of_kind(rank: int) -> Column:
        found = kept_matches(text, *rules[rank])
        return F.transform(found, lambda m: _seen(span_of(m, KINDS[rank], rank), F.lit(None), m["found"][0])).cast(SEEN_TYPE)

    return in_order(*[of_kind(rank) for rank in range(len(KINDS))])


def _seen(span: Column, word: Column, text: Column) -> Column:
    return F.struct(*[span[c].alias(c) for c in ("start", "rank", "end", "kind")], word.alias("word"), text.alias("text"))


def _tokens(text: Column) -> Column:
    """Every token with a digit or @ that has a word before it, without marks around it."""

    def token(m: Column) -> Column:
        word, gap, whole = m["found"][0], m["found"][1], m["found"][2]
        lead = F.regexp_extract(whole, r"^[(\[<\"']*", 0)
        bare = F.regexp_replace(F.substring(whole, F.length(lead) + 1, F.length(whole)), r"[)\]>\"'.,;:!?]+$", "")
        start = m["start"] + F.length(word) + F.length(gap) + F.length(lead)
        span = F.struct(start.alias("start"), F.lit(len(KINDS)).alias("rank"), (start + F.length(bare)).alias("end"), F.lit(None).alias("kind"))
        return _seen(span, ascii_lower(word), bare)

    return F.transform(matches(text, CONTEXT, (0, 2, 3)), token).cast(SEEN_TYPE)


def _edges(base: Column, tokens: Column, least_chars: int) -> Column:
    """Context and instance of every token; a seed, a base match that starts there, is taken in full.

    Base matches and tokens are walked together by start, base matches first: the state is
    the first match at the last start and how far any match has reached.
    """

    def step(state: Column, x: Column) -> tuple[Column, Column]:
        fresh = x["word"].isNull() & ~state["seed"]["start"].eqNullSafe(x["start"])
        after = F.struct(
            F.when(fresh, x).otherwise(state["seed"]).alias("seed"),
            F.when(x["word"].isNull(), F.greatest(state["reach"], x["end"])).otherwise(state["reach"]).alias("reach"),
        )
        seed = state["seed"]
        is_seed = seed["start"].eqNullSafe(x["start"])
        edge = F.struct(
            x["word"].alias("pattern"),
            F.when(is_seed, seed["text"]).otherwise(x["text"]).alias("instance"),
            F.when(is_seed, seed["kind"]).when(state["reach"] > x["start"], F.lit("inside")).alias("kind"),
            x["start"].alias("start"),
            F.when(is_seed, seed["end"]).otherwise(x["end"]).alias("end"),
        )
        return after, edge

    item = SEEN_TYPE[len("array<") : -1]
    state_type = f"struct<seed:{item},reach:int>"
    zero = F.struct(F.lit(None).cast(item).alias("seed"), F.lit(0).alias("reach"))
    walked = scanned(in_order(base, tokens), zero, step, state_type, EDGE_TYPE)
    usable = lambda e: e["pattern"].isNotNull() & ~F.coalesce(e["kind"] == "inside", F.lit(False)) & (F.length(e["instance"]) >= least_chars)
    return F.filter(walked, usable)


KEY = ["_key", "_key2"]


def _digests(text: Column) -> list[Column]:
    """128 bits by which a text finds its own spans again."""
    return [F.xxhash64(text).alias(KEY[0]), F.xxhash64(F.lit(1), text).alias(KEY[1])]


def score_graph(edges: DataFrame, settings: Bootstrap, scratch: Scratch) -> DataFrame:
    """``pattern``, ``kind``, ``score`` after the rounds, from ``pattern, instance, kind``.

    ``kind`` is null for instances that are no seeds. Each round is two aggregations over
    the distinct edges; the scores are written between rounds.
    """
    distinct = scratch.store(edges.groupBy("pattern", "instance").agg(F.max("kind").alias("seed_kind")), "graph")
    seeded = distinct.where("seed_kind is not null").groupBy("pattern", "seed_kind").agg(F.count(F.lit(1)).alias("n_seeds"))
    totals = distinct.groupBy("pattern").agg(F.count(F.lit(1)).alias("n_instances"))
    known = scratch.store(
        seeded.where(F.col("n_seeds") >= settings.least_seeds).join(totals, "pattern").withColumnRenamed("seed_kind", "kind"), "patterns"
    )
    live = distinct.join(known.select("pattern", "kind", "n_instances"), "pattern").select(
        "pattern", "kind", "n_instances", "instance", (F.col("seed_kind") == F.col("kind")).alias("same"), F.col("seed_kind").isNotNull().alias("seed")
    )
    live = scratch.store(live, "live")
    belief = F.when(F.col("seed"), F.col("same").cast("double"))
    scores = live.groupBy("pattern", "kind", "n_instances").agg(F.sum(F.coalesce(belief, F.lit(0.0))).alias("mass"))
    score = F.col("mass") / (F.col("n_instances") + settings.doubt)
    scores = scratch.store(scores.select("pattern", "kind", score.alias("score")), "round-0")
    for r in range(1, settings.rounds + 1):
        doubts = live.where("not seed").join(scores, ["pattern", "kind"]).groupBy("instance", "kind").agg(
            (1 - F.exp(F.sum(F.log1p(-F.least(F.col("score"), F.lit(0.999)))))).alias("belief")
        )
        beliefs = live.join(doubts, ["instance", "kind"], "left")
        mass = F.sum(F.coalesce(belief, F.col("belief"), F.lit(0.0))).alias("mass")
        scores = beliefs.groupBy("pattern", "kind", "n_instances").agg(mass).select("pattern", "kind", score.alias("score"))
        scores = scratch.store(scores, f"round-{r}")
    return scores


def find_personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Bootstrap = Bootstrap()
) -> DataFrame:
    """One row per row of ``docs``: the id and ``personal``, all spans by start and kind.

    A span has ``start``, ``end`` (code points, end exclusive), ``rank`` and ``kind``; what
    the contexts discover has the kind ``context_<kind of its seeds>``. A null text is the
    empty text. Equal texts get equal spans; null or repeated ids and other columns make no
    difference, and an empty table gives none.
    """
    scratch = Scratch(docs.sparkSession, "personal")
    lean = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    whole = lean.select("_id", *_digests(F.col("_text")), _base(F.col("_text")).alias("_whole"), _tokens(F.col("_text")).alias("_tokens"))
    base = F.transform("_whole", lambda m: F.struct(*[m[c].alias(c) for c in ("start", "rank", "end", "kind")]))
    seen = whole.select("_id", *KEY, base.alias("_base"), _edges(F.col("_whole"), F.col("_tokens"), settings.least_chars).alias("_edges"))
    seen = scratch.store(seen, "seen")

    edges = seen.select(*KEY, F.explode("_edges").alias("e")).select(*KEY, "e.*")
    best = score_graph(edges.select("pattern", "instance", "kind"), settings, scratch)
    best = best.where(F.col("score") >= settings.confidence).groupBy("pattern").agg(F.max(F.struct("score", "kind"))["kind"].alias("found_kind"))
    found = edges.where("kind is null").join(best, "pattern").groupBy(*KEY, "start").agg(F.max("end").alias("end"), F.max("found_kind").alias("kind"))
    span = F.struct("start", F.lit(len(KINDS)).alias("rank"), "end", F.concat(F.lit("context_"), "kind").alias("kind"))
    found = found.groupBy(*KEY).agg(F.collect_set(span).alias("_found"))  # bounded by one text's tokens
    found = scratch.store(found, "found")  # read anew, so that AQE can split the rows of a frequent text in the join
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    return seen.select("_id", *KEY, "_base").join(found, KEY, "left").select(
        F.col("_id").alias(id_col), in_order("_base", F.coalesce("_found", none)).alias("personal")
    )


def personal_report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The counts and digests of ``find_personal_data``."""
    base = F.filter("personal", lambda s: s["rank"] < len(KINDS))
    return found.select(
        id_col,
        *[count_of(F.col("personal"), kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(rendered(base), 256).alias("base_sha256"),
        rendered(F.col("personal")).alias("spans"),
    )
