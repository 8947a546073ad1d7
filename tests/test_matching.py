"""First come, first served against a fold in plain Python, and the pool's rule table."""

from __future__ import annotations

import random

import pytest

from tidemark.operators.matching import PATTERNS, POOL, assign, patterns_of, pool

SPECS, SCENARIOS = "task string, spec string, ord int, patterns array<string>", "task string, scenario string, ord int, pattern string"


def fold(specs, scenarios):
    found = []
    for task in {t for t, *_ in specs}:
        entries = sorted((o, s, p) for t, s, o, p in specs if t == task)
        unused = [(s, p) for _, s, p in sorted((o, s, p) for t, s, o, p in scenarios if t == task)]
        fits = lambda patterns, p: patterns is None or p in patterns
        for _, spec, patterns in entries:
            hit = next((u for u in unused if fits(patterns, u[1])), None)
            if hit:
                found.append((task, hit[0], spec, 1))
                unused.remove(hit)
        for k, (s, p) in enumerate(unused):
            able = [e for _, e, patterns in entries if fits(patterns, p)] or [e for _, e, _ in entries]
            found.append((task, s, able[k % len(able)], 2))
    return sorted(found)


@pytest.mark.parametrize("seed", range(4))
def test_assignment_equals_the_fold(spark, seed):
    r = random.Random(seed)
    specs = [(t, f"{t}{k}", k, r.choice([None, ["a"], ["a"], ["a", "b"], ["b", "c"], ["z"], ["b", "a"]])) for t in "XY" for k in range(r.choice([3, 14]))]
    scenarios = [(r.choice("XXXYW"), f"s{k}", r.randint(0, 40), r.choice(["a", "b", "c", "d", ""])) for k in range(r.choice([5, 60]))]
    got = assign(spark.createDataFrame(specs, SPECS), spark.createDataFrame(scenarios, SCENARIOS).repartition(3))
    assert sorted(map(tuple, got.collect())) == fold(specs, scenarios)


def test_entries_that_compete_for_one_scenario_move_on_in_order(spark):
    specs = [("t", f"e{k}", k, [["a"], ["a", "b"], None][k % 3]) for k in range(9)]
    scenarios = [("t", f"s{k}", k, "ab"[k % 2]) for k in range(7)]
    got = assign(spark.createDataFrame(specs, SPECS), spark.createDataFrame(scenarios, SCENARIOS))
    assert sorted(map(tuple, got.collect())) == fold(specs, scenarios)


def test_odd_tables(spark):
    none = spark.createDataFrame([], SCENARIOS)
    some = spark.createDataFrame([("t", "e", 0, ["a"])], SPECS)
    assert assign(some, none).collect() == []
    assert assign(some.limit(0), spark.createDataFrame([("t", "s", 0, "a")], SCENARIOS)).collect() == []
    rows = spark.createDataFrame([("t", "s", 0, None), ("t", "u", 1, None)], SCENARIOS)
    assert sorted(map(tuple, assign(some, rows).collect())) == [("t", "s", "e", 2), ("t", "u", "e", 2)]


def test_the_pool(spark):
    entries = {e for own in POOL.values() for e in own}
    assert set(PATTERNS) <= entries and len(entries) == 58
    assert patterns_of("model_result_analysis", "result_group_error") == ["residual_period", "residual_hetero"]
    assert patterns_of("data_profile", "profile_trend_types") is None
    assert pool(spark).count() == 58
