"""Tool-use trajectories, JSON values and scanned sources on literals."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import json_values as jv
from tidemark.operators import trajectories as tr
from tidemark.sources.source_scan import scan_functions

MESSAGES = "id int, pos int, role string, call_id string, text string, name string, arguments string"
EVENTS = "id int, ord int, call_id string, name string, arguments string, ok boolean"


def conversation(k, calls, answer="a final answer of some length"):
    rows = [(k, 0, "system", None, "s", None, None), (k, 1, "user", None, "u", None, None)]
    for i, (call, reply) in enumerate(calls):
        rows += [(k, 2 * i + 2, "assistant", call, "", "t", "{}"), (k, 2 * i + 3, "tool", reply, "r", "t", None)]
    return [*rows, (k, 2 * len(calls) + 2, "assistant", None, answer, None, None)]


def test_review_of_trajectories(spark):
    rows = conversation(1, [("a", "a"), ("b", "b")]) + conversation(2, [("a", "x")]) + conversation(3, [("a", "a")], "no") + conversation(4, [(str(i), str(i)) for i in range(9)])
    rows += [(5, 0, "user", None, "u", None, None), (5, 1, "tool", "z", "r", None, None)]
    events = [(1, 1, "a", "t", "{}", True), (1, 2, "b", "t", "{1}", True), (2, 1, "a", "t", "{}", True), (3, 1, "a", "t", "{}", False)]
    events += [(4, i, str(i), "t", "{}", True) for i in range(9)]
    got = {r.id: r for r in tr.review(spark.createDataFrame(rows, MESSAGES), spark.createDataFrame(events, EVENTS), "id").collect()}
    assert got[1].flags == "" and got[1].passed and got[1].score == 1.0
    assert got[2].flags == "grammar" and not got[2].passed
    assert got[3].flags == "short_answer,no_evidence"
    assert got[4].flags == "over_budget,repeated_call"
    assert set(got[5].flags.split(",")) >= {"grammar", "no_final_answer", "no_evidence"}


def test_swapped_events_do_not_match(spark):
    rows = conversation(1, [("a", "a"), ("b", "b")])
    events = [(1, 1, "b", "t", "{}", True), (1, 2, "a", "t", "{1}", True)]
    got = tr.review(spark.createDataFrame(rows, MESSAGES), spark.createDataFrame(events, EVENTS), "id").first()
    assert got.flags == "unmatched_call"


def test_chat_messages(spark):
    rows = spark.createDataFrame(conversation(1, [("a", "a")]), MESSAGES)
    messages = tr.chat_messages(rows, "id").first().messages
    assert [m.role for m in messages] == ["system", "user", "assistant", "tool", "assistant"]
    assert json.loads(messages[2].call) == {"name": "t", "arguments": "{}"} and messages[2].text is None
    assert messages[3].tool == "t"
    with pytest.raises(Exception, match="unknown role"):
        tr.chat_messages(rows.withColumn("role", F.lit("robot")), "id").collect()


def test_json_values(spark):
    texts = ['```json\n{"a": 1}\n```', 'so: {"a": {"b": [1, 2]}} ok', "[1]", "nothing", None, '{"path": "/x/y.csv", "session_id": "s", "v": [' + ",".join(["1"] * 30) + "]}"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string").withColumn("o", jv.parse_object(F.col("t")))
    got = {r.k: r for r in df.select("k", "o", jv.paths(F.col("o")).alias("p"), jv.bounded(F.col("o")).alias("b"), jv.clean_result(F.col("o")).alias("c")).collect()}
    assert [got[k].o for k in range(5)] == ['{"a":1}', '{"a":{"b":[1,2]}}', None, None, None]
    assert got[1].p == ["a", "a.b", "a.b[].1", "a.b[].2"]
    bounded = json.loads(got[5].b)
    assert "session_id" not in bounded and bounded["v"][-1] == {"_omitted_items": 10}
    assert json.loads(got[5].c)["uri"] == "y.csv"


@pytest.mark.parametrize(
    ("schema", "value", "n"),
    [
        ({"type": "object", "required": ["a"], "properties": {"a": {"type": "integer"}}}, {"a": True}, 1),
        ({"type": "object", "required": ["a"]}, {}, 1),
        ({"type": "array", "items": {"enum": [1, 2]}}, [1, 3, 2], 1),
        ({"anyOf": [{"type": "string"}, {"const": 4}]}, 4, 0),
        ({"anyOf": [{"type": "string"}, {"const": 4}]}, 5, 1),
        ({"type": "object", "properties": {}, "additionalProperties": False}, {"x": 1, "y": 2}, 2),
        ({"type": ["number", "null"], "minimum": 2}, 1, 1),
    ],
)
def test_schema_errors(schema, value, n):
    assert len(jv.schema_errors(schema, value)) == n


def test_text_of_results(spark):
    row = spark.createDataFrame([("x" * 500, "keep\nsession_id: 9\n\"session_id\": \"abc\"", "args.get('b') + args[\"a\"] + args.get('b')")], "a string, b string, c string")
    got = row.select(jv.observed(F.col("a"), 400).alias("a"), jv.without_session(F.col("b")).alias("b"), jv.argument_keys(F.col("c")).alias("c")).first()
    cut = json.loads(got.a)
    assert cut["truncated"] and cut["chars"] == 500 and len(cut["preview"]) == 160
    assert got.b == 'keep\n"session_id": "<session>"'
    assert got.c == ["a", "b"]


def test_scanned_functions(spark, tmp_path):
    (tmp_path / "a.py").write_text('import x\n\n\n@x.tool(name="f")\ndef f(a, b):\n    """Does f.\n\n    More.\n    """\n    return a\n\n\ndef g():\n    pass\n')
    (tmp_path / "b.py").write_text("def broken(:\n")
    rows = {r.name: r for r in scan_functions(spark, str(tmp_path)).collect()}
    assert set(rows) == {"f", None}
    assert (rows["f"].first_line, rows["f"].arguments, rows["f"].doc) == (5, "a,b", "Does f.")
    assert rows[None].error
