"""JSON texts as values: objects out of answers, bounds, paths, schema checks, and cleaned tool results.

Nested values of unknown shape need recursion, so those run as Arrow-batched functions over JSON texts; the
rest are columns.
"""

from __future__ import annotations

import json
import math
import posixpath

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Bounds of a shown value.
MAX_ITEMS, MAX_FIELDS, MAX_CHARS, MAX_DEPTH = 20, 40, 2000, 6
DROPPED = ("session_id", "created_at")


def parse_object(text: Column) -> Column:
    """The JSON object in a text, as compact text: without a code fence, or between the outermost braces; else null."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(F.trim(text), r"^```[a-zA-Z]*\s*", ""), r"\s*```$", ""))
    inner = F.regexp_extract(bare, r"(?s)\{.*\}", 0)
    whole, part = F.try_parse_json(bare), F.try_parse_json(inner)
    is_object = lambda v: F.schema_of_variant(v).startswith("OBJECT")
    return F.when(is_object(whole), F.to_json(whole)).when(is_object(part), F.to_json(part))


def observed(text: Column, limit: int = 16_000) -> Column:
    """A long tool result as a record of its hash, length and beginning; a short one as it is."""
    short = F.to_json(F.struct(F.lit(True).alias("truncated"), F.sha2(text.cast("binary"), 256).alias("sha256"), F.length(text).alias("chars"), F.substring(text, 1, limit - 240).alias("preview")))
    return F.when(F.length(text) > limit, short).otherwise(text)


def without_session(text: Column) -> Column:
    """A text without the lines that name a session id, and with ids elsewhere replaced."""
    lines = F.filter(F.split(text, "\n"), lambda x: ~F.lower(x).rlike(r"^\s*session[_ ]id\s*[:=]"))
    return F.regexp_replace(F.array_join(lines, "\n"), r'("session_id"\s*:\s*)"[^"]*"', '$1"<session>"')


def argument_keys(source: Column) -> Column:
    """Keys that a source text takes from its arguments, sorted."""
    got = F.regexp_extract_all(source, F.lit(r"""args(?:\.get\(|\[)["']([A-Za-z_][A-Za-z0-9_]*)["']"""), F.lit(1))
    return F.array_sort(F.array_distinct(got))


def _bounded(v, depth: int = 0):
    if depth >= MAX_DEPTH:
        return "..."
    if isinstance(v, dict):
        kept = [(k, x) for k, x in v.items() if k not in DROPPED]
        out = {k: _bounded(x, depth + 1) for k, x in kept[:MAX_FIELDS]}
        return out | {"_omitted_fields": len(kept) - MAX_FIELDS} if len(kept) > MAX_FIELDS else out
    if isinstance(v, list):
        out = [_bounded(x, depth + 1) for x in v[:MAX_ITEMS]]
        return [*out, {"_omitted_items": len(v) - MAX_ITEMS}] if len(v) > MAX_ITEMS else out
    if isinstance(v, str) and len(v) > MAX_CHARS:
        return v[:MAX_CHARS] + "..."
    return None if isinstance(v, float) and not math.isfinite(v) else v


def _paths(v, at: str = "") -> list[str]:
    if isinstance(v, dict):
        return [p for k, x in v.items() for p in ([f"{at}.{k}".lstrip(".")] + _paths(x, f"{at}.{k}"))]
    if isinstance(v, list):
        return [p for x in v for p in ([f"{at}[].{x}".lstrip(".")] if not isinstance(x, dict | list) else _paths(x, f"{at}[]"))]
    return []


_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None), "number": (int, float), "integer": int}


def schema_errors(schema: dict, v, at: str = "$") -> list[str]:
    """Breaches of a JSON schema: type, const, enum, anyOf, required, properties, additionalProperties, items, bounds."""
    if "anyOf" in schema and all(schema_errors(s, v, at) for s in schema["anyOf"]):
        return [f"{at}: no alternative fits"]
    if "const" in schema and v != schema["const"]:
        return [f"{at}: not the constant"]
    if "enum" in schema and v not in schema["enum"]:
        return [f"{at}: not one of the values"]
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(isinstance(v, _TYPES[k]) and not (isinstance(v, bool) and k in ("number", "integer")) for k in kinds):
        return [f"{at}: not of type {'/'.join(kinds)}"]
    found = []
    if isinstance(v, int | float) and not isinstance(v, bool):
        found += [f"{at}: below minimum"] * (v < schema.get("minimum", v)) + [f"{at}: above maximum"] * (v > schema.get("maximum", v))
    if isinstance(v, dict):
        known = schema.get("properties", {})
        found += [f"{at}: {k} is missing" for k in schema.get("required", []) if k not in v]
        found += [e for k, x in v.items() if k in known for e in schema_errors(known[k], x, f"{at}.{k}")]
        if schema.get("additionalProperties") is False:
            found += [f"{at}: {k} is not allowed" for k in v if k not in known]
    if isinstance(v, list) and "items" in schema:
        found += [e for i, x in enumerate(v) for e in schema_errors(schema["items"], x, f"{at}[{i}]")]
    return found


def _clean_paths(v):
    if isinstance(v, dict):
        return {("uri" if k == "path" and isinstance(x, str) and x.startswith("/") else k): (posixpath.basename(x) if k == "path" and isinstance(x, str) and x.startswith("/") else _clean_paths(x)) for k, x in v.items()}
    return [_clean_paths(x) for x in v] if isinstance(v, list) else v


def _over_json(fn, kind: str):
    @F.pandas_udf(kind)
    def run(texts: pd.Series) -> pd.Series:
        def one(t):
            try:
                return fn(json.loads(t))
            except (TypeError, ValueError):
                return None

        return texts.map(one)

    return run


def bounded(text: Column) -> Column:
    """A JSON text with long lists, wide objects, long strings and deep values cut, with marks of what is left out."""
    return _over_json(lambda v: json.dumps(_bounded(v), ensure_ascii=False, allow_nan=False), "string")(text)


def paths(text: Column) -> Column:
    """All dotted paths of a JSON text, those of list values with the value."""
    return _over_json(lambda v: sorted(set(_paths(v))), "array<string>")(text)


def check_schema(text: Column, schema: dict) -> Column:
    """Breaches of ``schema`` by a JSON text; null where it isn't JSON."""
    return _over_json(lambda v: schema_errors(schema, v), "array<string>")(text)


def clean_result(text: Column) -> Column:
    """A tool result whose absolute paths are file names."""
    return _over_json(lambda v: json.dumps(_clean_paths(v), ensure_ascii=False, sort_keys=True), "string")(text)
