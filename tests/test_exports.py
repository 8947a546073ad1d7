"""Exported conversations and question records: the query against its SQL, and small runs."""

from __future__ import annotations

import json

from oracle import connection, same
from pyspark.sql import functions as F

from tidemark.operators import exports as ex
from tidemark.plans.export_queries import ORACLE_SQL, QUERIES

DDL = "run int, pos int, role string, text string, images array<string>, name string, calls array<struct<name: string, arguments: string>>"


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    df = QUERIES["tool_conversations"](spark, sf)
    assert df.where("error IS NOT NULL").count() > 0
    same(df, connection(sf), ORACLE_SQL["tool_conversations"])


def test_a_run_as_training_messages(spark):
    rows = [
        (1, 0, "system", "be brief", None, None, None), (1, 1, "user", "<image>\nlook", ["a.png"], None, None), (1, 2, "assistant", " so ", None, None, [("plot", '{"n": [1, 2], "s": "x"}')]),
        (1, 3, "tool", "done", ["b.png"], "plot", None), (1, 4, "assistant", "an answer", None, None, None), (2, 0, "narrator", "x", None, None, None), (3, 0, "assistant", "", None, None, [("plot", "[]")]), (4, 0, None, None, None, None, None),
    ]
    made = ex.tool_conversations(spark.createDataFrame(rows, DDL), "run", "what {name} drew")
    got = {r.run: r for r in made.select("*", ex.as_json(F.col("messages")).alias("j")).collect()}
    text = lambda t: {"type": "text", "text": t}
    assert json.loads(got[1].j) == [
        {"role": "system", "content": [text("be brief")]}, {"role": "user", "content": [{"type": "image", "path": "a.png"}, text("look")]},
        {"role": "assistant", "content": [text("so")], "tool_calls": [{"type": "function", "function": {"name": "plot", "arguments": {"n": [1, 2], "s": "x"}}}]},
        {"role": "tool", "content": [text("done")], "name": "plot"}, {"role": "user", "content": [{"type": "image", "path": "b.png"}, text("what plot drew")]}, {"role": "assistant", "content": [text("an answer")]},
    ]
    assert got[1].images == ["a.png", "b.png"]
    assert [(got[k].error, got[k].messages) for k in (2, 3, 4)] == [("role narrator", None), ("arguments", None), ("role null", None)]
    assert ex.tool_conversations(spark.createDataFrame([], DDL), "run").collect() == []


def test_question_records(spark):
    specs = spark.createDataFrame([("q1", "pair", "h1", "t", "e", "g", "text_only", None, "d.csv", None, ["a", "", "a"]), ("q2", "pair", "h2", "t", "e", "g", "image_text", "forecast", "d.csv", ["x.png"], ["b"]), ("q3", "alone", "h3", "t", "e", "g", "text_only", "none", "d.csv", [], [])], "id string, group_id string, spec_hash string, task string, spec string, goal string, mode string, scope string, data_path string, images array<string>, tools array<string>")
    made = ex.runtime_records(specs, spark.createDataFrame([("pair", "one text"), ("alone", " ")], "group_id string, user_request string"), "v2", "4")
    got = {r.id: r for r in made.collect()}
    assert set(got) == {"q1", "q2"} and {r.prompt.user_request for r in got.values()} == {"one text"}
    assert got["q1"].allowed_tools == ["a"] and got["q1"].task.model_catalog_scope == "none" and got["q2"].resources.images[0].path == "x.png"
    covered = ex.coverage_rows(specs, made, spark.createDataFrame([("q2", True, "goal_first")], "id string, passed boolean, style string"))
    assert {r.id: (r.style, r.passed) for r in covered.collect()} == {"q1": ("missing", None), "q2": ("goal_first", True)}
