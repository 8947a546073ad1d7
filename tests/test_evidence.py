"""Recorded evidence: the query against its SQL, single rules on small runs; decomposition and forecast queries."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from oracle import connection, same

from tidemark.operators import arima
from tidemark.operators.evidence import evidence_review
from tidemark.operators.stl import stl
from tidemark.plans.evidence_queries import ORACLE_SQL, QUERIES
from tidemark.plans.panel_queries import _filled

SF = "/root/testdata/sf0.01"
TOOLS = {"a": {"type": "object", "required": ["k"], "properties": {"k": {"type": "integer"}}}}


def test_query_equals_sql(spark):
    df = QUERIES["evidence_review"](spark, SF).cache()
    rows = df.collect()
    assert {f for r in rows for f in r.flags.split(",") if f} >= {"undefined_tool", "tool_event_evidence_hash_mismatch", "successful_invalid_tool_arguments", "absolute_dataset_path_leak", "distinct_successful_tools_mismatch"}
    assert {0.7, 1.0} == {r.relevance for r in rows} and {r.passed for r in rows} == {True, False}
    same(df, connection(SF), ORACLE_SQL["evidence_review"])
    df.unpersist()


def judged(spark, call, event, run=None, shown=("fine",)):
    calls = spark.createDataFrame([(1, 0, *call)] if call else [], "run int, ord int, call_id string, name string, arguments string")
    events = spark.createDataFrame([(1, 0, *event)] if event else [], "run int, ord int, call_id string, name string, arguments string, ok boolean, result string, evidence string")
    runs = spark.createDataFrame([(1, *(run or ("an answer that is long enough to be more than a brief one, as it should", 1, ["a"], "/data/x.csv", [])))], "run int, answer string, declared long, declared_tools array<string>, dataset_path string, preferred array<string>")
    return evidence_review(calls, events, runs, spark.createDataFrame([(1, t) for t in shown], "run int, text string"), "run", TOOLS).first()


GOOD = ("c", "a", '{"k": 1}')
HASH = hashlib.sha256(b'ok:{"uri": "x.csv"}').hexdigest()
DONE = (*GOOD, True, '{"path": "/tmp/x.csv"}', HASH)


def test_a_run_that_agrees_passes(spark):
    r = judged(spark, GOOD, DONE)
    assert (r.flags, r.warnings, r.score, r.passed) == ([], [], 1.0, True)


@pytest.mark.parametrize(
    ("call", "event", "flag"),
    [
        (("d", *GOOD[1:]), DONE, "tool_event_call_id_mismatch"),
        (("c", "a", '{"k": 2}'), DONE, "tool_event_payload_mismatch"),
        (GOOD, (*DONE[:5], "0" * 64), "tool_event_evidence_hash_mismatch"),
        (("c", "a", '{"k": "x"}'), ("c", "a", '{"k": "x"}', True, None, None), "successful_invalid_tool_arguments"),
        (("c", "a", "{"), ("c", "a", "{", True, None, None), "malformed_tool_arguments"),
        (("c", "b", "{}"), ("c", "b", "{}", True, None, None), "undefined_tool"),
        (None, None, "no_successful_tool_call"),
    ],
)
def test_each_flag(spark, call, event, flag):
    r = judged(spark, call, event)
    assert flag in r.flags and not r.passed


def test_texts_answers_and_nulls(spark):
    r = judged(spark, GOOD, DONE, (None, None, None, "/data/x.csv", ["z"]), ("see /data/x.csv", "C:\\x", None))
    assert r.flags == ["absolute_dataset_path_leak", "distinct_successful_tools_mismatch", "empty_final_answer", "runtime_absolute_path_leak", "successful_tool_count_mismatch"]
    assert (r.relevance, r.answer, r.evidence, r.warnings) == (0.7, 0.0, 0.0, ["final_answer_brief"])
    mended = judged(spark, ("c", "a", "{}"), ("c", "a", "{}", False, None, None))
    assert "recovered_invalid_tool_arguments" in mended.warnings and "successful_invalid_tool_arguments" not in mended.flags


def test_decomposition_and_forecasts_of_the_panel(spark):
    sf = "/root/testdata/sf0.001"
    series = {}
    for r in sorted(_filled(spark, sf).collect(), key=lambda r: (r.series_id, r.t)):
        series.setdefault(r.series_id, []).append(r.value)
    parts = {}
    for r in sorted(QUERIES["stl_robust"](spark, sf).collect(), key=lambda r: (r.series_id, r.t)):
        parts.setdefault(r.series_id, []).append((r.trend, r.season, r.rest, r.weight))
    for s, v in series.items():
        assert np.array(parts[s]).T == pytest.approx(np.array(stl(np.array(v), 24)), abs=2e-6)
        assert np.array(parts[s])[:, :3].sum(1) == pytest.approx(v, abs=1e-5)
    for r in QUERIES["arima_likelihood"](spark, sf).where("step = 1").collect():
        v = np.array(series[r.series_id])
        model = arima.fit(v, (r.p, r.d, r.q))
        assert r.value == pytest.approx(arima.forecast(v, model, 1)[0][0], rel=1e-6)
        assert r.aic == pytest.approx(min(arima.fit(v, o).aic for o in [(1, 1, 1), (0, 1, 1), (1, 1, 0)]), rel=1e-6)
