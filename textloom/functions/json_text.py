"""JSON in free text, read as strictly as Python's parser does; Spark's own readers take trailing text and reject duplicate keys."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_FENCE = "```"
_NESTED = re.compile(r"\{(?:[^{}]|\{(?:[^{}]|\{[^{}]*\})*\})*\}")


def _balanced(text: str) -> str | None:
    """From the first brace to the one that closes it, quotes not being looked at."""
    begin, depth = text.find("{"), 0
    if begin < 0:
        return None
    for m in re.compile(r"[{}]").finditer(text, begin):
        depth += 1 if m[0] == "{" else -1
        if depth == 0:
            return text[begin : m.end()]
    return None


def find_json(text: str | None):
    """The JSON value of a reply: that of its first fenced block, else of its first balanced braces, else of any braces up to
    three deep. A block or balanced braces that don't parse end the search."""
    if not isinstance(text, str):
        return None
    for mark in (_FENCE + "json", _FENCE):
        if mark in text:
            body, closed, _ = text.partition(mark)[2].partition(_FENCE)
            if closed:
                return _parsed(body)
            break
    if (part := _balanced(text)) is not None:
        return _parsed(part)
    return next((v for v in map(_parsed, _NESTED.findall(text)) if v is not None), None)


def _parsed(text: str):
    try:
        return json.loads(text.strip())
    except (ValueError, RecursionError):
        return None


def json_text(text: str | None) -> str | None:
    """``find_json`` as JSON text; null where it finds nothing."""
    found = find_json(text)
    return None if found is None else json.dumps(found, ensure_ascii=False)


def extract_json(text: Column) -> Column:
    """``json_text`` of a column."""

    @F.pandas_udf("string")
    def run(t: pd.Series) -> pd.Series:
        return pd.Series([json_text(x) for x in t], dtype=object)

    return run(text)


#: A record as read: ``error`` if it is no JSON, the kind of the whole, and kind and text of each field, of the fields of ``reward`` too.
FACTS = "error string, kind string, fields map<string, struct<kind:string, text:string>>, reward map<string, struct<kind:string, text:string>>"


def _facts(line: str | None) -> tuple:
    try:
        value = json.loads((line or "").strip())
    except (ValueError, RecursionError) as e:
        return str(e), None, {}, {}
    if not isinstance(value, dict):
        return None, type(value).__name__, {}, {}
    inside = value.get("reward")
    cells = lambda d: {k: (type(v).__name__, v if isinstance(v, str) else None) for k, v in d.items()}
    return None, "dict", cells(value), cells(inside) if isinstance(inside, dict) else {}


def record_facts(line: Column) -> Column:
    """struct of ``FACTS``."""

    @F.pandas_udf(FACTS)
    def run(t: pd.Series) -> pd.DataFrame:
        cells = lambda d: {k: {"kind": a, "text": b} for k, (a, b) in d.items()}
        return pd.DataFrame([(e, k, cells(f), cells(r)) for e, k, f, r in map(_facts, t)], columns=["error", "kind", "fields", "reward"])

    return run(line)
