"""Offered tools, modalities and hashes of question specifications on small rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import question_specs as sp

EVEN = {"low": {"text_only": 1.0, "image_text": 0.0}, "medium": {"text_only": 0.0, "image_text": 0.0}, "high": {"text_only": 0.0, "image_text": 1.0}}


def planned(spark, rows):
    df = spark.createDataFrame(rows, "scenario string, spec string, image_policy string, task string, goal string, analysis_difficulty string, entry_difficulty string, preferred array<string>, focus array<string>")
    return sp.modality_plan(df, EVEN, 1)


def row(k, spec, policy, hard=True):
    return (f"s{k}", spec, policy, "model_selection", "sequence_anomaly_detection", "hard", "hard" if hard else "medium", ["p1", "gone"], ["f1", "p1", "no"])


def test_every_entry_is_asked_both_ways(spark):
    rows = [row(k, spec, policy) for spec, policy, n in (("a", "low", 9), ("b", "high", 9), ("c", "conditional", 9), ("d", "low", 1), ("e", "high", 2)) for k in range(n)]
    got = planned(spark, rows).collect()
    by = {}
    for r in got:
        by.setdefault(r.spec, []).append(r)
    assert all({m for r in own for m in r.modes} == {"text_only", "image_text"} for own in by.values())
    assert sorted(r.reason for r in by["a"])[:2] == ["policy_primary_modality", "stratified_low_text_only"]
    assert sum(r.reason == "subtask_counter_modality" for r in by["b"]) == 1
    assert sum(len(r.modes) == 2 for r in by["c"]) == 8
    assert [r.reason for r in by["d"]] == ["forced_pair_for_subtask_coverage"]


def test_specs_and_their_hashes(spark):
    tools = spark.createDataFrame([(t,) for t in ["f1", "p1", "u1", "no", "x1", "x2", "x3"]], "name string")
    make = lambda rows, **more: sp.question_specs(planned(spark, rows), tools, universal=["u1"], excluded=["no"], size=4, **more)
    rows = [row(k, "z", "conditional", k > 0) for k in range(3)]
    first = make(rows).cache()
    got = {r.id: r for r in first.collect()}
    for r in got.values():
        assert r.tools[:3] == ["p1", "u1", "f1"] and r.tools[3] in ("x1", "x2", "x3")
        assert r.scope == "anomaly_detection" and r.group_id == (r.pair_id or r.id)
        assert (r.difficulty, r.decisions) == (("medium", 2) if r.scenario == "s0" else ("hard", 3))
    assert len({r.spec_hash for r in got.values()}) == len(got)
    again = {r.id: r.unchanged for r in make([row(k, "z", "conditional", k > 1) for k in range(3)], previous=first.select("id", "spec_hash")).collect()}
    assert {r.split("_")[0] for r, same in again.items() if not same} == {"s1"}
    first.unpersist()


def test_required_tools_stay_when_there_are_too_many(spark):
    one = spark.createDataFrame([("q",)], "q string")
    names = lambda v: F.array(*map(F.lit, v)).cast("array<string>")
    pick = lambda size: one.select(sp.offered_tools(F.col("q"), names(["b", "a", "b", "z"]), names(["c", "d", "a"]), names(["a", "b", "c", "d", "e"]), names(["d"]), size, 1).alias("t")).first().t
    assert pick(2) == ["b", "a"] and pick(3) == ["b", "a", "c"] and pick(9) == ["b", "a", "c", "e"] and pick(1) == ["b"]
