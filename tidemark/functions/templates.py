"""``{NAME}`` placeholders, on the driver as bound parameters and on columns."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

NAME = r"\{([A-Za-z0-9_]+)\}"


# Comments are matched first, so that a quote inside one does not start a literal.
COMMENT_OR_LITERAL = (
    r"--[^\n]*|/\*.*?\*/|(?P<quote>['\"])(?P<body>(?:\\.|(?P=quote){2}|(?!(?P=quote))[^\\])*)(?P=quote)"
)

# Stand for doubled braces, which mean the brace itself, while placeholders are bound.
_OPEN, _CLOSE = "\ue000", "\ue001"


def bind_parameters(
    text: str, context: Mapping[str, str], strict: bool = True
) -> tuple[str, dict[str, str]]:
    """SQL text -> text with parameter markers, and the values to bind.

    ``col = '{NAME}'`` becomes ``col = :NAME``. A placeholder inside a longer literal
    becomes a concatenation, so a quote in a value can never end the literal. With
    ``strict`` an unknown name is an error and ``{{`` is a plain brace; otherwise only
    known names are touched, so braces of other kinds stay as written.
    """
    if strict:
        text = text.replace("{{", _OPEN).replace("}}", _CLOSE)
        unknown = sorted({n for n in re.findall(NAME, text) if n not in context})
        if unknown:
            raise ValueError("unknown placeholder: " + ", ".join(unknown))
    used = sorted({n for n in re.findall(NAME, text) if n in context})
    if used:
        known = r"\{(" + "|".join(used) + r")\}"

        def literal(match: re.Match) -> str:
            quote = match.group("quote")
            pieces = re.split(known, match.group("body")) if quote else [""]
            if len(pieces) == 1:
                return match.group(0)
            parts = [f":{p}" if i % 2 else quote + p + quote for i, p in enumerate(pieces) if i % 2 or p]
            return parts[0] if len(parts) == 1 else "concat(" + ", ".join(parts) + ")"

        text = re.sub(COMMENT_OR_LITERAL, literal, text, flags=re.DOTALL)
        text = re.sub(known, r":\1", text)
    return text.replace(_OPEN, "{").replace(_CLOSE, "}"), {n: str(context[n]) for n in used}


def fill_name(text: str | None, context: Mapping[str, str]) -> str | None:
    """A path, database or table name with its placeholders filled; unknown ones are an error."""
    if text is None:
        return None
    unknown = sorted({n for n in re.findall(NAME, text) if n not in context})
    if unknown:
        raise ValueError("unknown placeholder: " + ", ".join(unknown))
    return re.sub(NAME, lambda m: str(context[m.group(1)]), text)


def uses_placeholder(text: str | None, name: str) -> bool:
    return bool(text) and name in re.findall(NAME, text)


def placeholder_names(template: Column) -> Column:
    return F.regexp_extract_all(template, F.lit(NAME), F.lit(1))


def fill_template(template: Column, context: Column) -> Column:
    """Template column filled from a map column, each placeholder exactly once.

    Unknown names stay as they are and are reported by ``unresolved_names``.
    """
    literals = F.split(template, NAME, -1)
    filled = F.zip_with(
        literals,
        placeholder_names(template),
        lambda text, name: F.concat(
            text,
            F.when(name.isNull(), F.lit("")).otherwise(
                F.coalesce(F.try_element_at(context, name), F.concat(F.lit("{"), name, F.lit("}")))
            ),
        ),
    )
    return F.array_join(filled, "")


def unresolved_names(template: Column, context: Column) -> Column:
    """Placeholders of the template that the context does not know."""
    return F.filter(
        F.array_distinct(placeholder_names(template)),
        lambda name: ~F.map_contains_key(context, name),
    )
