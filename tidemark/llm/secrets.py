"""Secret scan with a trigram index.

Each rule's expression yields a Boolean trigram query: sets of trigrams of which one set
must occur in full in any text that matches. The trigrams that the queries name are indexed
as postings; intersecting and uniting the postings gives the candidates, and only those are
searched with the rule. A rule without a mandatory trigram is run over every text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bitmaps import BITMAP_BITS, bitmap_of, with_flag
from tidemark.llm.columns import text_of
from tidemark.llm.scratch import Scratch
from tidemark.llm.spans import count_of, in_order, rendered, spans

MAX_STRINGS = 64  # alternatives of a literal part that are followed; beyond, the part counts as unknown
MAX_SETS = 64


@dataclass(frozen=True)
class Rule:
    """``least`` is the least length of group ``group``; shorter matches are dropped, not retried."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0

    @property
    def query(self) -> frozenset[frozenset[str]]:
        return trigram_query(self.pattern)


# The expressions of the scan's contract.
ASSIGN_KEYS = "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
BASE_RULES = (
    Rule("assign", ASSIGN_KEYS + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=1, least=6),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]{24,}"),
)
# What the method adds: public formats of well-known tokens.
EXTRA_RULES = (
    Rule("private_key", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH )?PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{24,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE_RULES + EXTRA_RULES

ANY = frozenset({frozenset()})


def _simplest(sets) -> frozenset[frozenset[str]]:
    return frozenset(s for s in sets if not any(other < s for other in sets))


def _both(a, b):
    if len(a) * len(b) > MAX_SETS:  # one of the two conditions alone is still necessary
        return min(a, b, key=len) if ANY not in (a, b) else (b if a == ANY else a)
    return _simplest({x | y for x, y in product(a, b)})


def _of_strings(strings) -> frozenset[frozenset[str]]:
    return _simplest({frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings})


def trigram_query(pattern: str) -> frozenset[frozenset[str]]:
    """Trigram sets of which one occurs in the lower-cased form of any text that matches.

    ``ANY``, the single empty set, when no trigram is mandatory.
    """

    def strings_of(node) -> set[str] | None:
        """All texts the node can match, if they are few."""
        op, value = str(node[0]), node[1]
        if op == "LITERAL":
            return {chr(value).lower()}
        if op == "IN" and str(value[0][0]) != "NEGATE":
            chars = {chr(v).lower() for o, v in value if str(o) == "LITERAL"}
            plain = all(str(o) == "LITERAL" for o, _ in value)
            return chars if plain and len(chars) <= 8 else None
        if op == "SUBPATTERN":
            return of_sequence(value[-1])
        if op == "BRANCH":
            options = [of_sequence(x) for x in value[1]]
            return None if None in options else set().union(*options)
        if op in ("MAX_REPEAT", "POSSESSIVE_REPEAT") and value[1] == 1:
            inner = of_sequence(value[2])
            return None if inner is None else inner | ({""} if value[0] == 0 else set())
        return None

    def of_sequence(nodes) -> set[str] | None:
        out = {""}
        for node in nodes:
            more = strings_of(node)
            if more is None or len(out) * len(more) > MAX_STRINGS:
                return None
            out = {a + b for a, b in product(out, more)}
        return out

    def query_of(nodes):
        needed, strings = ANY, {""}
        for node in nodes:
            more = strings_of(node)
            if more is not None and len(strings) * len(more) <= MAX_STRINGS:
                strings = {a + b for a, b in product(strings, more)}
                continue
            needed, strings = _both(needed, _of_strings(strings)), {""}
            op, value = str(node[0]), node[1]
            if more is not None:
                strings = more
            elif op == "SUBPATTERN":
                needed = _both(needed, query_of(value[-1]))
            elif op == "BRANCH":
                needed = _both(needed, _simplest(set().union(*(query_of(x) for x in value[1]))))
            elif op == "MAX_REPEAT" and value[0] > 0:
                needed = _both(needed, query_of(value[2]))
        return _both(needed, _of_strings(strings))

    return query_of(re._parser.parse(pattern))


def _holds(query, present: Column) -> Column:
    every = [reduce(Column.__and__, [F.array_contains(present, t) for t in sorted(s)]) for s in sorted(query, key=sorted)]
    return reduce(Column.__or__, every)


def postings(docs: DataFrame, trigrams: list[str], key: Column, text: Column) -> DataFrame:
    """``trigram``, ``key``: the inverted index over the lower-cased texts, for these trigrams."""
    held = F.array_compact(F.array(*[F.when(F.contains(F.col("_low"), F.lit(t)), F.lit(t)) for t in trigrams]))
    lean = docs.select(key.alias("key"), F.lower(text).alias("_low"))
    return lean.select("key", F.explode(held).alias("trigram"))


def candidates(index: DataFrame, rules) -> DataFrame:
    """The keys that satisfy the trigram query of at least one rule."""
    present = index.groupBy("key").agg(F.collect_set("trigram").alias("_held"))  # bounded by the rules' trigrams
    return present.where(reduce(Column.__or__, [_holds(r.query, F.col("_held")) for r in rules])).select("key")


def _matches(text: Column, rule: Rule, rank: int) -> Column:
    if not rule.least:
        return spans(text, rule.pattern, rule.kind, rank)
    return spans(text, rule.pattern, rule.kind, rank, lambda m: F.length(F.regexp_extract(m, rule.pattern, rule.group)) >= rule.least)


def find_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: tuple[Rule, ...] = RULES,
    bitmap_bits: int = BITMAP_BITS,
    carry: list[str] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: the id and ``secrets``, all spans by start and rule order.
    With ``carry``, a struct ``row`` of these columns of ``docs`` instead of the id.

    A span has ``start``, ``end`` (code points, end exclusive), ``rank`` and ``kind``. A null
    text is the empty text and has none. Rows that repeat an id, null ids and other columns
    make no difference: each row is judged by its own text. An empty table gives none.
    """
    scratch = Scratch(docs.sparkSession, "secrets")
    text = text_of(text_col)
    indexed = [r for r in rules if r.query != ANY]
    row = F.struct(*[F.col(c) for c in carry]).alias("row") if carry else F.col(id_col)
    named = "row" if carry else id_col
    lean = docs.select(F.struct(row.alias(named)).alias("_row"), text.alias("_text"))
    ranks = {r.kind: i for i, r in enumerate(rules)}
    everywhere = [_matches(F.col("_text"), r, ranks[r.kind]) for r in rules if r.query == ANY]
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    if not indexed:
        return lean.select("_row.*", in_order(none, *everywhere).alias("secrets"))
    trigrams = sorted({t for r in indexed for s in r.query for t in s})
    key = F.xxhash64("_text")  # equal texts have equal candidates
    index = scratch.store(postings(lean, trigrams, key, F.col("_text")), "postings")
    chosen = scratch.store(bitmap_of(candidates(index, indexed), bitmap_bits), "candidates")
    flagged = with_flag(lean.withColumn("_key", key), chosen, [F.col("_key")], "_candidate", bitmap_bits)
    verified = F.when(F.col("_candidate"), F.concat(none, *[_matches(F.col("_text"), r, ranks[r.kind]) for r in indexed])).otherwise(none)
    return flagged.select("_row.*", in_order(none, verified, *everywhere).alias("secrets"))


def secret_report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The counts and digests of ``find_secrets``."""
    base = F.filter("secrets", lambda s: s["rank"] < len(BASE_RULES))
    return found.select(
        id_col,
        *[count_of(F.col("secrets"), r.kind).alias(f"n_{r.kind}") for r in BASE_RULES],
        F.sha2(rendered(base), 256).alias("base_sha256"),
        rendered(F.col("secrets")).alias("spans"),
    )
