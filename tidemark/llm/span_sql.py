"""SQL for the span operators: matches with places from matched texts and what lies between."""

from __future__ import annotations


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def spans_cte(rules: list[tuple[str, str, str]]) -> str:
    """``spans(rid, kind, rank, b, e)`` from ``d(rid, text)``; a rule is (kind, pattern, condition on ``m``)."""
    parts = [
        f"SELECT rid, '{kind}' AS kind, {rank} AS rank, m, b, b + length(m) AS e FROM ("
        f"SELECT rid, f[i] AS m, CAST(list_sum(list_transform(g[1:i], lambda x: length(x)))"
        f" + coalesce(list_sum(list_transform(f[1:i-1], lambda x: length(x))), 0) AS BIGINT) AS b"
        f" FROM (SELECT rid, f, g, unnest(range(1, len(f) + 1)) AS i FROM ("
        f"SELECT rid, regexp_extract_all(text, {_quoted(pattern)}) AS f, string_split_regex(text, {_quoted(pattern)}) AS g"
        f" FROM d))) WHERE {condition}"
        for rank, (kind, pattern, condition) in enumerate(rules)
    ]
    return "spans AS (" + "\nUNION ALL ".join(parts) + ")"


def report(rules: list[tuple[str, str, str]], n_base: int) -> str:
    """The report of all documents: counts by base kind, digest of base spans, all spans."""
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{kind}') AS n_{kind}" for kind, _, _ in rules[:n_base])
    zeros = ", ".join(f"coalesce(n_{kind}, 0) AS n_{kind}" for kind, _, _ in rules[:n_base])
    one = "kind || ':' || b || ':' || e"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
{spans_cte(rules)},
told AS (
  SELECT rid, {counts},
         string_agg({one}, ',' ORDER BY b, rank) FILTER (WHERE rank < {n_base}) AS base,
         string_agg({one}, ',' ORDER BY b, rank) AS spans
  FROM spans GROUP BY rid
)
SELECT doc_id, {zeros}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN told USING (rid)
"""
