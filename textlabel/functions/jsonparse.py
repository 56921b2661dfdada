"""Answer-to-JSON expressions (JSN1-JSN4).

Native paths: brace extraction (both cutting rules), the strict grammar of flat objects and typed key lookup on a VARIANT.
Spark's readers accept trailing text after the first object, and NaN / duplicate keys differ from Python's ``json``. So
``flat_json`` decides every answer that is a flat object or cannot be one by expressions; only what is left (nested values, escapes,
NaN, very long numbers, repeated keys) needs ``strict_json``, an Arrow-batched pandas UDF.
"""

from __future__ import annotations

import json
import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .text import strip


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extract_braces(c) -> Column:
    """JSN1: from the first '{' to the last '}' (greedy, across lines); none -> null."""
    got = F.regexp_extract(_col(c), r"(?s)\{.*\}", 0)
    return F.when(got != "", got)


def extract_braces_split(c) -> Column:
    """JSN2: text after the first '{', cut at its last '}' if any, then re-wrapped in braces.

    An unclosed object is therefore 'repaired'; text with no '{' gives null (a miss).
    """
    c = _col(c)
    rest = F.regexp_extract(c, r"(?s)\{(.*)", 1)
    body = F.when(F.instr(rest, "}") > 0, F.regexp_extract(rest, r"(?s)^(.*)\}", 1)).otherwise(rest)
    return F.when(F.instr(c, "{") > 0, F.concat(F.lit("{"), body, F.lit("}")))


def _canonical(s: str | None):
    if s is None:
        return None
    try:
        obj = json.loads(s)
        return json.dumps(_finite(obj)) if isinstance(obj, dict) else None
    except (ValueError, RecursionError):
        return None


def _finite(value):
    """NaN and Infinity, at any depth, as null: Python's ``json`` reads them, Spark's parser does not, and like null they
    never equal 0 or 1."""
    if isinstance(value, float):
        return value if math.isfinite(value) else None
    if isinstance(value, dict):
        return {k: _finite(v) for k, v in value.items()}
    return [_finite(v) for v in value] if isinstance(value, list) else value


@F.pandas_udf(StringType())
def strict_json(s: pd.Series) -> pd.Series:
    """Python-strict JSON check: canonical JSON of a valid object, else null."""
    return s.map(_canonical)


_WS = r"[ \t\n\r]*+"
_PLAIN_STRING = r'"[^"\\\x00-\x1f]*+"'
_NUMBER = r"-?+(?:0|[1-9]\d{0,14}+)(?:\.\d{1,15}+)?+(?:[eE][+-]?+\d{1,2}+)?+"
_PAIR = f"{_PLAIN_STRING}{_WS}:{_WS}(?:{_PLAIN_STRING}|{_NUMBER}|true|false|null){_WS}"
#: a flat object without escapes, with numbers that a double holds; possessive, so that it takes one pass and no stack
FLAT = rf"\A\{{{_WS}(?:{_PAIR}(?:,{_WS}{_PAIR})*+)?+\}}{_WS}\z"
#: what Python may read and FLAT does not: escapes, nesting, NaN and infinities, long numbers
BEYOND = r"(?s)[\\\[]|.\{|NaN|Infinity|\d{16}|[eE][+-]?\d{3}"
#: strings aside, a flat object that closes before the text ends: no JSON, whatever follows
TRAILED = r"(?s)\A\{[^{}\[\]]*+\}.*[^ \t\n\r]"


def flat_json(c) -> tuple[Column, Column]:
    """(canonical JSON or null, whether only Python's grammar can tell) of an extracted object."""
    c = _col(c)
    flat = c.rlike(FLAT)
    keys = F.regexp_extract_all(c, F.lit(rf'"([^"]*+)"{_WS}:'), 1)
    again = F.size(F.array_distinct(keys)) < F.size(keys)
    bare = F.regexp_replace(c, r'"[^"]*+"', '""')
    trailed = ~c.contains("\\") & bare.rlike(TRAILED)
    rest = F.coalesce(F.when(flat, again).otherwise(c.rlike(BEYOND) & ~trailed), F.lit(False))
    return F.when(flat, F.when(F.size(keys) == 0, "{}").otherwise(c)), rest


def cut_answer(raw, cut: str = "greedy") -> Column:
    """JSN3 front half: strip, cut out the object."""
    trimmed = strip(_col(raw))
    return extract_braces(trimmed) if cut == "greedy" else extract_braces_split(trimmed)


def parse_ok(canonical) -> Column:
    """A miss is a failed parse or an empty object."""
    c = _col(canonical)
    return F.coalesce(c.isNotNull() & (c != "{}"), F.lit(False))


def typed_key(canonical, key: str) -> Column:
    """Value of ``key`` as Python compares it to 0/1: numbers as double, booleans as 1/0,
    anything else (string, null, object, missing key) -> null."""
    v = F.try_parse_json(_col(canonical))
    path = f"$['{key}']"
    item = F.try_variant_get(v, path, "variant")
    kind = F.schema_of_variant(item)
    return (F.when(kind == "BOOLEAN", F.try_variant_get(v, path, "boolean").cast("double"))
             .when(kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL"),
                   F.try_variant_get(v, path, "double")))


def label_json(values: list, keys: list[str], indent: str = "        ") -> Column:
    """JSN4: the label block written into prompts, one key per line.

    ``values`` are integer Columns; layout follows the reference's example block: the first
    line ends with ',', middle lines with ', ', the last line with two blanks.
    """
    inner = indent + "    "
    parts = [F.lit(indent + "{\n")]
    last = len(keys) - 1
    for i, (k, v) in enumerate(zip(keys, values)):
        tail = "  " if i == last else ("," if i == 0 else ", ")
        parts += [F.lit(f'{inner}"{k}": '), _col(v).cast("string"), F.lit(tail + "\n")]
    parts.append(F.lit(indent + "}"))
    return F.concat(*parts)
