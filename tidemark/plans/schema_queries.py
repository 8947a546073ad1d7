"""Queries on tool schemas and arguments, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import json_schemas as js
from tidemark.plans.panel_queries import _t


def part_tools(s: SparkSession, d: str) -> DataFrame:
    """A tool for each brand of parts: sizes are its values, the first type a constant, other types may be null.

    The constant of a brand with an odd number of parts is said to be a whole number, which can't be shown.
    """
    brands = _t(s, d, "part").groupBy("p_brand").agg(F.array_sort(F.collect_set("p_size")).alias("sizes"), F.min("p_type").alias("first"), F.array_sort(F.collect_set("p_type")).alias("types"), (F.count("*") % 2 == 0).alias("even"))
    text = lambda c: F.to_json(c)
    size = F.concat(F.lit('{"$ref": "#/$defs/size", "title": "t"}'))
    parts = [
        F.lit('{"type": "object", "additionalProperties": false, "required": ["session_id", "size"], "$defs": {"size": {"type": ["integer", "null"], "minimum": 1, "enum": '), text(F.col("sizes")), F.lit("}}, "),
        F.lit('"properties": {"session_id": {"type": "string"}, "size": '), size, F.lit(', "first": {"const": "'), F.col("first"), F.lit('", "type": "'), F.when(F.col("even"), "string").otherwise("integer"),
        F.lit('"}, "kind": {"type": ["string", "integer", "null"], "enum": '), text(F.col("types")), F.lit("}}}"),
    ]
    return brands.select("p_brand", F.concat(*parts).alias("parameters"))


def shown_schemas(s: SparkSession, d: str) -> DataFrame:
    return part_tools(s, d).select("p_brand", js.shown_schema(F.col("parameters")).alias("x")).select("p_brand", "x.*")


def read_arguments(s: SparkSession, d: str) -> DataFrame:
    """Events' properties as arguments that a model wrote as texts, read back by each tool's own schema."""
    inner = '{"type": "object", "properties": {"k": {"type": "integer", "maximum": 50}}, "required": ["k"]}'
    tools = s.createDataFrame([("click", f'{{"properties": {{"props": {inner}}}}}'), ("view", f'{{"properties": {{"props": {inner}, "tags": {{"type": "array", "items": {inner}}}}}}}'), ("purchase", '{"properties": {"props": {"type": "string"}}}')], "event_type string, parameters string")
    wrote = F.to_json(F.struct(F.col("props"), F.concat(F.lit("["), F.col("props"), F.lit("]")).alias("tags")))
    calls = _t(s, d, "events").select("event_id", "event_type", wrote.alias("arguments")).join(F.broadcast(tools), "event_type", "left")
    read = calls.select("event_id", js.read_arguments(F.col("arguments"), F.col("parameters")).alias("x")).select("event_id", "x.*")
    return read.select("event_id", "decoded", F.get_json_object("arguments", "$.props.k").cast("long").alias("k"), F.get_json_object("arguments", "$.tags[0].k").cast("long").alias("tag_k"))


QUERIES = {"shown_schemas": shown_schemas, "read_arguments": read_arguments}

ORACLE_SQL = {
    "shown_schemas": """WITH b AS (SELECT p_brand, list(DISTINCT p_size ORDER BY p_size) AS sizes, min(p_type) AS first, list(DISTINCT p_type ORDER BY p_type) AS kinds, count(*) % 2 = 0 AS even FROM part GROUP BY p_brand)
        SELECT p_brand, CASE WHEN even THEN '{"properties": {"first": {"enum": ["' || first || '"], "type": "string"}, "kind": {"enum": ["' || array_to_string(kinds, '", "') || '"]}, "size": {"enum": [' || array_to_string(sizes, ', ') || '], "minimum": 1, "title": "t", "type": "integer"}}, "required": ["size"], "type": "object"}' END AS schema,
        CASE WHEN NOT even THEN 'values of another type than integer at $.first' END AS error FROM b""",
    "read_arguments": """WITH e AS (SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
        SELECT event_id, CAST(CASE WHEN k > 50 THEN 0 WHEN event_type = 'click' THEN 1 WHEN event_type = 'view' THEN 2 ELSE 0 END AS INTEGER) AS decoded, CASE WHEN k <= 50 AND event_type IN ('click', 'view') THEN k END AS k, CASE WHEN k <= 50 AND event_type = 'view' THEN k END AS tag_k FROM e""",
}
