"""Tool schemas as models are shown them, and arguments read back: rules on small trees, queries against SQL."""

from __future__ import annotations

import json

import pytest
from oracle import connection, same
from pyspark.sql import functions as F

from tidemark.functions import json_schemas as js
from tidemark.plans.schema_queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    df = QUERIES[name](spark, sf)
    assert df.count() > 0
    same(df, connection(sf), ORACLE_SQL[name])


def test_words_that_change():
    tree = {"type": ["object"], "title": "t", "properties": {"title": {"type": ["string", "null"], "enum": ["a", None], "default": "a"}, "n": {"type": ["integer", "number"], "minimum": 1, "oneOf": []}, "c": {"const": 3}}, "anyOf": [{"const": "x"}], "prefixItems": [{"const": "x", "default": "y"}]}
    assert js.portable(tree) == {"type": "object", "title": "t", "properties": {"title": {"type": "string", "enum": ["a"]}, "n": {"minimum": 1}, "c": {"enum": [3]}}, "prefixItems": [{"enum": ["x"]}]}
    assert tree["properties"]["c"] == {"const": 3}
    assert js.without_parameter({"properties": {"session_id": {}, "a": {}}, "required": ["session_id", "a"]}) == {"properties": {"a": {}}, "required": ["a"]}
    assert js.without_parameter({"required": ["session_id"]}) == {}


def test_references_are_put_in():
    tree = {"$defs": {"a": {"type": "string"}, "b": {"$ref": "#/$defs/a", "description": "b"}}, "properties": {"x": {"$ref": "#/$defs/b"}, "y": {"type": "array", "items": {"$ref": "#/$defs/a"}}}}
    assert js.portable(tree) == {"properties": {"x": {"type": "string", "description": "b"}, "y": {"type": "array", "items": {"type": "string"}}}}
    for ref in ({"$ref": "#/$defs/none"}, {"$ref": "other.json"}, {"$defs": {"a": {"properties": {"x": {"$ref": "#/$defs/a"}}}}, "$ref": "#/$defs/a"}):
        with pytest.raises(js.NotPortable):
            js.portable(ref)


@pytest.mark.parametrize("tree", [{"type": ["null"]}, {"type": ["string", "null"], "enum": [None]}, {"enum": []}, {"type": "integer", "enum": [1, "a"]}, {"properties": {"a": {"type": "string", "const": 1}}}])
def test_what_cannot_be_shown(tree):
    with pytest.raises(js.NotPortable):
        js.portable(tree)


def test_texts_are_read_where_they_fit():
    schema = {"properties": {"a": {"type": "array", "items": {"type": "integer"}}, "o": {"type": ["object", "null"], "required": ["k"]}, "s": {"type": "string"}}}
    assert js.decoded({"a": "[1, 2]", "o": '{"k": 1}', "s": "[1]", "z": "[1]"}, schema) == ({"a": [1, 2], "o": {"k": 1}, "s": "[1]", "z": "[1]"}, 2)
    assert js.decoded({"a": '["x"]', "o": "{}"}, schema) == ({"a": '["x"]', "o": "{}"}, 0)


def test_columns_of_odd_texts(spark):
    rows = [(None, None), ("{", "{"), ("[]", "{}"), ('{"a": 1}', "[]"), ('{"a": "[1]"}', '{"properties": {"a": {"type": "array"}}}')]
    df = spark.createDataFrame(rows, "t string, s string")
    got = df.select("t", js.read_arguments(F.col("t"), F.col("s")).alias("r"), js.shown_schema(F.col("s")).alias("x")).collect()
    assert [r.r.decoded for r in got] == [0, 0, 0, 0, 1]
    assert [r.x.error for r in got] == ["not JSON", "not JSON", None, "not an object", None]
    assert json.loads(got[4].r.arguments) == {"a": [1]} and got[1].r.arguments == "{"
