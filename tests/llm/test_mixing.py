"""Mixing by schedules: targets, places in the training, and the cases of its docstring, against plain Python."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing
from tidemark.llm.mixing import Schedule, mix, training_order

DDL = "doc_id long, text string, source string"


def targets(sizes: dict, weights, share=Fraction(3, 2), most=2):
    """Excess over a cap is dealt out again by weight until no target is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: Fraction(weights[i % len(weights)]) for i, s in enumerate(names)}
    capped: set = set()
    while True:
        left = share * sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        total = sum(weight[s] for s in names if s not in capped)
        found = {s: Fraction(most * sizes[s]) if s in capped else left * weight[s] / total for s in names}
        over = {s for s in names if found[s] > most * sizes[s]}
        if not over:
            return found
        capped |= over


@pytest.mark.parametrize("seed", range(4))
def test_targets_and_taken_words(spark, seed):
    import random

    r = random.Random(seed)
    names = [*"zabYé€", "\U0001f600", None][: 3 + seed]
    rows = [(i, " ".join(["w"] * r.choice([0, 1, 3, 20, 400 * (i % 50 == 0)])), r.choice(names + names[:1] * 8)) for i in range(600)]
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(t.split())
    want = targets(sizes, [5, 2, 1])
    got = {x.doc_id: x for x in mix(spark.createDataFrame(rows, DDL)).collect()}
    assert set(got) == {i for i, _, _ in rows}
    taken = defaultdict(int)
    for i, t, s in rows:
        x = got[i]
        assert x["size"] == len(t.split()) and x.source_size == sizes[s] and 0 <= x.taken <= 2 * x["size"]
        assert x.target == pytest.approx(float(want[s]))
        assert x.taken == sum(d.words for d in x.draws)
        taken[s] += x.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    again = {x.doc_id: x for x in mix(spark.createDataFrame(rows[::-1], DDL).repartition(7)).collect()}
    assert again == got


def test_places_follow_the_schedules(spark):
    """What is due by a time is the schedule's integral so far, for each source; the order is that of the positions."""
    schedules = [Schedule(((0, 0.0), (0.5, 4.0), (1, 0.0))), Schedule(((0, 1.0), (0.25, 1.0), (0.5, 0.0), (0.75, 0.0), (1, 3.0)))]
    rows = [(i, "a b c d e", "ab"[i % 2]) for i in range(4000)]
    mixed = mix(spark.createDataFrame(rows, DDL), schedules, share=1.2).cache()
    names = {i: s for i, _, s in rows}
    copies = training_order(mixed).collect()
    assert [c.position for c in copies] == sorted(c.position for c in copies)
    for k, s in enumerate("ab"):
        own = [c for c in copies if names[c.doc_id] == s]
        total = sum(c.words for c in own)
        for t in (0.1, 0.3, 0.45, 0.6, 0.8, 0.95):
            steps = 20_000
            knots = schedules[k].knots

            def weight(x, knots=knots):
                return next(a + (b - a) * (x - t0) / (t1 - t0) for (t0, a), (t1, b) in zip(knots, knots[1:], strict=False) if x <= t1)

            area = sum(weight((j + 0.5) / steps) for j in range(int(t * steps))) / steps
            due = sum(c.words for c in own if c.position < t) / total
            assert due == pytest.approx(area / schedules[k].weight, abs=0.002)
    mixed.unpersist()


def test_order_of_a_source_comes_from_the_ids(spark):
    rows = [(i, "a b c", "s") for i in range(200)]
    got = {x.doc_id: x for x in mix(spark.createDataFrame(rows, DDL), share=0.4).collect()}
    order = sorted(range(200), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    assert [got[i].taken for i in order] == [3] * 80 + [0] * 120


def test_buckets_do_not_change_the_result(spark, monkeypatch):
    rows = [(i % 97, "x " * (i % 11), ["s", None, "t"][i % 3]) for i in range(500)]
    df = spark.createDataFrame(rows, DDL)
    whole = sorted(map(repr, mix(df).collect()))
    monkeypatch.setattr(mixing, "BUCKET_DOCS", 7)
    assert sorted(map(repr, mix(df).collect())) == whole
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(map(repr, mix(df).collect())) == whole


def test_odd_rows(spark):
    text = " x y \x1c a\tb\nc\x0bd\x0ce\rf" + " long" * 300_000
    rows = [(1, None, "s"), (2, "", "s"), (None, "one", None), (3, " \n", None), (3, "two words", None), (3, "two words", None), (4, text, "s")]
    df = spark.createDataFrame(rows, DDL).withColumns({c: F.lit("clash") for c in ("size", "key", "no", "target", "draws", "id", "at")})
    got = mix(df).collect()
    assert len(got) == 7
    sizes = sorted(x["size"] for x in got)
    assert sizes == [0, 0, 0, 1, 2, 2, len(re.findall(mixing.WORD, text))]
    assert all(not x.draws and x.taken == 0 for x in got if x["size"] == 0)
    assert mix(spark.createDataFrame([], DDL)).collect() == []
    assert [x.taken for x in mix(spark.createDataFrame([(1, None, None), (2, " ", "s")], DDL)).collect()] == [0, 0]


def test_schedules_are_checked():
    for knots in (((0, 1),), ((0, 1), (0.5, 1)), ((0, 0), (1, 0)), ((0, 1), (1, -1)), ((0, 1), (0, 2), (1, 1))):
        with pytest.raises(ValueError):
            Schedule(knots)
