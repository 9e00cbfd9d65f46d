"""JSON that a model wrote: cut out of what surrounds it, and mended if it was cut short."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .text import fence_stripped, from_brace

#: Characters that may be dropped from the end of a truncated text, and what may close it, in the order of trying.
REACH, CLOSERS = 500, ("}", "]", "]}")


_TOKEN = re.compile(r"""[ \t\n\r]+|"(?:[^"\\\x00-\x1f]|\\["\\/bfnrt]|\\u[0-9A-Fa-f]{4})*"|-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false|null|NaN|-?Infinity|[][{},:]""")
_NUMBER = re.compile(r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?")
#: What is open where a closer completes a text.
_CLOSES = {"{": "}", "[": "]", "{[": "]}"}


def cut_points(body: str, first: int) -> list[tuple[int, str]]:
    """(length, closer) of the prefixes of at least `first` characters that a closer completes, by length. One pass: a pushdown scan keeps the open brackets and what may come next, and stops at the
    first error, since no longer prefix is the beginning of JSON."""
    open_, found = "", []
    #: what may come: a value; a value or ] ; a key or } ; a key; a colon; a comma or the closing bracket; nothing
    state, at = "value", 0
    while at < len(body):
        token = _TOKEN.match(body, at)
        if not token:
            break
        text, end = token[0], token.end()
        sign = text[0]
        if sign in " \t\n\r":
            # between tokens: as complete as before it
            if state in ("after", "first", "first key") and open_ in _CLOSES:
                found += [(n, _CLOSES[open_]) for n in range(max(at + 1, first), end + 1)]
            at = end
            continue
        if sign in "[{":
            if state not in ("value", "first"):
                break
            open_ += sign
            state = "first" if sign == "[" else "first key"
        elif sign in "]}":
            if state not in (("first", "after") if sign == "]" else ("first key", "after")) or open_[-1:] != ("[" if sign == "]" else "{"):
                break
            open_ = open_[:-1]
            state = "after"
        elif sign == ",":
            if state != "after" or not open_:
                break
            state = "value" if open_[-1] == "[" else "key"
        elif sign == ":":
            if state != "colon":
                break
            state = "value"
        elif sign == '"' and state in ("key", "first key"):
            state = "colon"
        elif state in ("value", "first"):
            state = "after"
            if (sign in "-0123456789") and open_ in _CLOSES:  # a number may be complete before its end
                found += [(at + k, _CLOSES[open_]) for k in range(1, len(text)) if at + k >= first and _NUMBER.fullmatch(text, 0, k)]
        else:
            break
        at = end
        if state in ("after", "first", "first key") and open_ in _CLOSES and at >= first:
            found.append((at, _CLOSES[open_]))
    return found


def mended(text: str | None) -> str | None:
    """The text as compact JSON; if it does not parse, the longest of its prefixes (fewer than REACH characters shorter) that one of CLOSERS completes; null if none."""
    if text is None:
        return None
    body = text.strip()
    if not body:
        return None
    whole = _compact(body)
    if whole is not None:
        return whole
    points = cut_points(body, len(body) - min(len(body), REACH) + 1)
    return next((done for n, closer in reversed(points) if (done := _compact(body[:n] + closer)) is not None), None)


def _compact(text: str) -> str | None:
    try:
        return json.dumps(json.loads(text), ensure_ascii=False, separators=(",", ":"))
    except (ValueError, RecursionError):
        return None


@F.pandas_udf(StringType())
def mended_json(texts: pd.Series) -> pd.Series:
    """Mending has no built-in form; Arrow batches carry the texts."""
    return texts.map(mended)


EXTRACTION = "struct<entities:array<struct<name:string,type:string>>,relations:array<struct<source:string,target:string,relation:string,evidence:string,name:string>>>"


def extraction(answer: Column) -> Column:
    """(entities, relations) of a model's answer; both empty unless the JSON has both keys."""
    body = mended_json(from_brace(fence_stripped(answer)))
    both = F.array_contains(F.json_object_keys(body), "entities") & F.array_contains(F.json_object_keys(body), "relations")
    empty = F.from_json(F.lit('{"entities":[],"relations":[]}'), EXTRACTION)
    return F.when(both, F.from_json(body, EXTRACTION)).otherwise(empty)
