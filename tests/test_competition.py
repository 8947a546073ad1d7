"""Competing runs and graded answers: queries against their SQL, and small runs."""

from __future__ import annotations

import json

import pytest
from oracle import connection, same

from tidemark.operators import competition as cp
from tidemark.operators import graded_answers as ga
from tidemark.plans.competition_queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    df = QUERIES[name](spark, sf)
    assert not df.isEmpty()
    same(df, connection(sf), ORACLE_SQL[name])


CANDIDATES = "id int, index int, attempt int, model string, status string, answer string, tokens long, latency double, error_type string, error string"
MESSAGES = "id int, index int, attempt int, pos int, role string, text string, calls array<string>"
EVENTS = "id int, index int, attempt int, ord int, call_id string, name string, arguments string, ok boolean, result string, error_type string, error string, images array<string>"


def small(spark):
    candidates = [(1, 0, 1, "m", "error", None, 5, 1.0, None, " "), (1, 0, 2, "m", "ok", None, None, 1.23456, None, None), (1, 1, 1, "n", "error", "late", 7, None, "Stop", "over"), (2, 0, 1, None, None, None, None, None, None, None)]
    messages = [
        (1, 0, 1, 0, "assistant", "first", ["a"]), (1, 0, 2, 0, "assistant", "look", ["a", "b"]), (1, 0, 2, 1, "assistant", "look again", ["a"]), (1, 0, 2, 2, "user", "no", None),
        (1, 0, 2, 3, "assistant", " done ", None), (1, 0, 2, 4, "assistant", "not final", ["z"]), (1, 0, 2, 5, "assistant", " ", ["b"]),
    ]
    events = [
        (1, 0, 1, 0, "a", "plot", None, False, "not json", None, None, None), (1, 0, 2, 0, "a", "search", '{"q":1}', True, '{"structuredContent":{"summary":{"candidates":[{"name":"x"},{"name":""},3]}}}', None, None, ["/p/a.png", "b.png"]),
        (1, 0, 2, 1, "b", "plot", "{}", None, '{"content":[{"text":""},{"text":"t"},5]}', None, "broke", ["/p/a.png"]), (1, 0, 2, 2, None, "plot", "{}", True, None, None, None, None),
    ]
    return spark.createDataFrame(candidates, CANDIDATES), spark.createDataFrame(messages, MESSAGES), spark.createDataFrame(events, EVENTS)


def test_records_of_a_competition(spark):
    candidates, messages, events = small(spark)
    attempts = cp.attempt_records(candidates, messages, events, "search")
    reviews = spark.createDataFrame([(1, 0, True, 0.9, None), (1, 1, False, None, ["bad"])], "id int, index int, passed boolean, score double, flags array<string>")
    choices = spark.createDataFrame([(1, 0, "only_passed"), (2, None, "all_failed"), (3, None, "all_failed")], "id int, winner int, rule string")
    got = {r.id: r for r in cp.competition_records(attempts, reviews, choices).collect()}
    won = got[1].selected
    assert (got[1].status, won.final_answer, won.metrics.tool_calls, won.metrics.failed, won.metrics.tools, won.metrics.latency_seconds) == ("ok", "done", 3, 1, ["plot", "search"], 1.235)
    assert [(c.decision, c.ok, c.error and c.error.message, c.images, c.found) for c in won.tool_calls] == [("look again", True, None, ["a.png", "b.png"], ["x"]), ("look", False, "broke", ["a.png"], []), (None, True, None, [], [])]
    assert [c.result and json.loads(c.result) for c in won.tool_calls] == [{"candidates": [{"name": "x"}, {"name": ""}, 3]}, {"text": ["t"]}, None]
    first, second = got[1].candidates
    assert [(a.attempt, a.error.type, a.error.message, len(a.tool_calls)) for a in first.failed_attempts] == [(1, "generation_error", "Candidate generation failed", 1)]
    assert (second.ok, second.error.type, second.final_answer, second.review.flags, second.review.score) == (False, "Stop", "late", ["bad"], 0.0)
    assert got[2].status == "error" and got[2].selected is None and got[2].candidates[0].review is None
    assert got[3].candidates == []


def test_what_a_selector_sees(spark):
    candidates, messages, events = small(spark)
    attempts = cp.attempt_records(candidates, messages, events)
    seen = {(r.id, r["index"], r.attempt): r for r in cp.selector_material(attempts, events, 30).collect()}
    assert seen[(2, 0, 1)].events == [] and len(seen) == 4
    cut = json.loads(seen[(1, 0, 2)].events[0].result)
    assert cut["truncated"] and len(cut["preview"]) == 30 < cut["full_result_chars"]
    asked = spark.createDataFrame([(1, 0, "/q/q.png"), (1, 1, "b.png"), (1, 2, "gone.png")], "id int, pos int, path string")
    existing = spark.createDataFrame([("/q/q.png",), ("b.png",), ("/p/a.png",), ("/p/a.png",)], "path string")
    images = sorted(cp.selector_images(asked, events, existing).collect(), key=lambda r: r.image_index)
    assert [(r.image_index, r.source, r["index"], r.tool, r.filename) for r in images] == [(0, "initial_question", None, None, "q.png"), (1, "initial_question", None, None, "b.png"), (2, "tool_result", 0, "search", "a.png")]
    assert cp.selector_images(asked.limit(0), events.limit(0), existing).collect() == []


def test_grades_and_new_seeds(spark):
    full = json.dumps(dict.fromkeys(ga.FIELDS, "x") | {"answer": "y" * 300 + "".join(ga.SIGNALS[:6]) + "heatmap stl next step"}, ensure_ascii=False)
    rows = [(1, full, ["stl"], ["next_step"], "image_text"), (2, "[1]", ["stl"], ["a_b"], "image_text"), (3, None, None, None, None), (4, "", [], [], "text_only")]
    graded = {r.id: r for r in ga.grade_answers(spark.createDataFrame(rows, "id int, answer string, tools array<string>, cover array<string>, mode string"), ["id"]).collect()}
    assert (graded[1].score, graded[1].flags, graded[1].label) == (1.0, [], "pass")
    assert graded[2].label == "reply_error" and graded[2].score == round(0.22 * 0.2 + 0.14 * 0.2 + 0.12 * 0.25, 4) and len(graded[2].flags) == 6
    assert graded[3][1:] == graded[4][1:] and graded[3].marks.tools == 1.0
    seeds = spark.createDataFrame([("s", "ask"), ("t", None), ("u", "none")], "id string, question string")
    reviews = spark.createDataFrame([("s", "reply_error", 0.5, ["f"], ["i"] * 9), ("t", None, None, None, None)], "id string, final_label string, final_score double, flags array<string>, issues array<string>")
    told = spark.createDataFrame([("reply_error", "again"), (None, "other")], "label string, instruction string")
    got = {r.recycled_from: r for r in ga.recycled(seeds, reviews, told).collect()}
    assert set(got) == {"s", "t"} and got["s"].question == "ask\n\nagain" and got["s"].critique.count("i;") == 7 and got["s"].id == "s_recycle_v2"
    assert (got["t"].question, got["t"].recycle_label, got["t"].critique) == ("\n\nother", "needs_rewrite", "label: needs_rewrite\nflags: ")
    chats = spark.createDataFrame([("s", [("user", "ask")]), ("t", None)], "id string, messages array<struct<role: string, content: string>>")
    made = {r.id: r.messages for r in ga.training_seeds(chats, spark.createDataFrame([("s", "said"), ("t", "x"), ("u", " ")], "id string, answer string")).collect()}
    assert [tuple(m) for m in made["s"]] == [("user", "ask"), ("assistant", "said")] and len(made["t"]) == 1
