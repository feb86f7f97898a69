"""String expressions: complexity notation, query blocks of model replies, templates."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's ``str.strip`` and ``\s`` take it; Java's ``\s`` needs (?U) and lacks four control characters.
WS = r"[\s\x1c-\x1f]"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?U)^{WS}+|{WS}+\z", "")


def is_blank(c: Column) -> Column:
    return c.rlike(rf"(?U)^{WS}*\z")


# The notation that answers are compared in. Patterns and replacements, applied in this order.
NOTATION = (
    (r"θ\(([^)]+)\)", "O($1)"),
    (r"ω\(([^)]+)\)", "O($1)"),
    (r"o\(([^)]+)\)", "O($1)"),
)
SPACING = (
    (rf"(?U){WS}*\*{WS}*", "*"),
    (rf"(?U){WS}*\+{WS}*", "+"),
    (rf"(?U){WS}*\^{WS}*", "^"),
    (rf"(?U)log{WS}*\({WS}*n{WS}*\)", "log n"),
    (r"(?U)logn\b", "log n"),
    (rf"(?U)n{WS}*\*{WS}*log{WS}+n", "n log n"),
    ("²", "^2"),
    ("³", "^3"),
    (r"\*\*", "^"),
)


#: A missing last parenthesis: of what begins like the notation; in the end, of all else, once it is wrapped.
_UNCLOSED = ((r"(?s)^(o\(.*)(?<!\))\z", "$1)"),)
_WRAP = ((r"(?d)^([^o].*)", "O($1)"), (r"(?s)^(?!o\()(.*)(?<!\))\z", "$1)"))


def normalize_complexity(c: Column) -> Column:
    """Big-O notation in one form; both sides of a comparison take it, so its oddities (a second ``O(``) cancel out. Null gives ''.

    A chain of replacements in which no step names its input twice, so the generated code stays small.
    """
    x = F.lower(strip(F.coalesce(c, F.lit(""))))
    for pattern, new in (*NOTATION, *_UNCLOSED, *SPACING, *_WRAP):
        x = F.regexp_replace(x, pattern, new)
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit("")).otherwise(x)


def compare_complexity(a: Column, b: Column) -> Column:
    there = (F.coalesce(a, F.lit("")) != "") & (F.coalesce(b, F.lit("")) != "")
    return there & (normalize_complexity(a) == normalize_complexity(b))


def has_notation(c: Column) -> Column:
    return F.coalesce(c.rlike(r"[OoΘθϑϴΩωΩ]\([^)]+\)"), F.lit(False))


_STARTS = re.compile(r"[OΘΩ]\(", re.IGNORECASE)


def first_balanced(text: str | None) -> str | None:
    """The first ``X(...)`` whose parenthesis is closed; one pass, each closing one ends the latest open one."""
    if not text:
        return None
    letters = {m.start() + 1 for m in _STARTS.finditer(text)}
    if not letters:
        return None
    open_, best = [], None
    for m in re.finditer(r"[()]", text):
        if m[0] == "(":
            open_.append(m.start())
        elif open_:
            at = open_.pop()
            if at in letters and (best is None or at < best[0]):
                best = (at, m.end())
            if best and not any(x in letters and x < best[0] for x in open_):
                break
    return text[best[0] - 1 : best[1]] if best else None


def extract_complexity(text: Column) -> Column:
    """``first_balanced`` as a column."""

    @F.pandas_udf("string")
    def run(t: pd.Series) -> pd.Series:
        return pd.Series([first_balanced(x) for x in t], dtype=object)

    return run(text)


# The form in which models are asked for their queries.
_OUTER = r"(?s)===QUERIES_START===(.*?)===QUERIES_END==="
_BLOCK = r"(?s)===QUERY_START===(.*?)===QUERY_END==="
_FIELDS = {
    "query_id": r"QUERY_ID:\s*(\d+)",
    "complexity_type": r"COMPLEXITY_TYPE:\s*([A-Z]+)",
    "query": r"(?s)QUERY:\s*(.*?)\s*GROUND_TRUTH:",
    "ground_truth": r"GROUND_TRUTH:\s*([^\n]+)",
}


def parse_queries(reply: Column) -> Column:
    """array<struct<query_id, complexity_type, ground_truth, query>> of a model's reply; blocks without one of the last three are left out."""
    section = F.regexp_extract(F.coalesce(reply, F.lit("")), _OUTER, 1)

    def fields(b: Column) -> Column:
        got = {k: strip(F.regexp_extract(b, p, 1)) for k, p in _FIELDS.items()}
        number = F.when(got["query_id"] == "", "unknown").otherwise(got["query_id"])
        return F.struct(number.alias("query_id"), got["complexity_type"].alias("complexity_type"), got["ground_truth"].alias("ground_truth"), got["query"].alias("query"))

    blocks = F.transform(F.regexp_extract_all(section, F.lit(_BLOCK), F.lit(1)), fields)
    return F.filter(blocks, lambda x: (x["query"] != "") & (x["complexity_type"] != "") & (x["ground_truth"] != ""))


def first_filled(*columns: Column) -> Column:
    """The first column that is neither null nor empty; '' if none is."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def render(template: str, **fields: Column) -> Column:
    """``template.format(**fields)`` as a concat: the template is cut at plan time, so braces inside values are never read."""
    from string import Formatter

    parts: list[Column] = []
    for text, name, spec, conversion in Formatter().parse(template):
        if text:
            parts.append(F.lit(text))
        if name is not None:
            if spec or conversion or name not in fields:
                raise KeyError(f"template field {name!r}")
            parts.append(F.coalesce(fields[name].cast("string"), F.lit("None")))
    return F.concat(*parts) if parts else F.lit("")
