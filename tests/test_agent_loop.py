"""The tool-use loop: rules on small runs, and batches of a stream that give the rows of one batch."""

from __future__ import annotations

import json
import random

import pytest

from tidemark.streaming.agent_loop import Limits, agent_loop, run_loop

TOOLS = {"profile": {"type": "object", "required": ["uri"], "properties": {"uri": {"type": "string"}}, "additionalProperties": False}, "plot": {"type": "object"}}
DDL = "run long, step int, text string, calls array<struct<id string, name string, arguments string>>, ok boolean, error_type string, error string"


def call(run, step, name="profile", arguments='{"uri": "a"}', ok=True, error=None, id=None):  # noqa: A002
    return (run, step, "why", [(id or f"c{step}", name, arguments)], ok, None if ok else "ToolError", error)


def final(run, step, text="the answer"):
    return (run, step, text, [], None, None, None)


def looped(spark, rows, limits=Limits(), tmp=None, parts=1, files=None):
    df = spark.createDataFrame(rows, DDL)
    if tmp is None:
        return sorted(map(tuple, agent_loop(df, "run", TOOLS, limits).collect()), key=repr)
    df.repartition(parts).write.parquet(f"{tmp}/in")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files or 1).parquet(f"{tmp}/in")
    run_loop(stream, "run", TOOLS, f"file://{tmp}/out", f"file://{tmp}/state", limits)
    return sorted(map(tuple, spark.read.parquet(f"file://{tmp}/out").collect()), key=repr)


def in_python(rows, limits=Limits()):
    """(run, step, kind, ok, error_type, forced, remaining, status, reason) of the steps taken."""
    runs: dict[int, dict[int, tuple]] = {}
    for r in rows:
        runs.setdefault(r[0], {}).setdefault(r[1], r)
    out = []
    for run, steps in runs.items():
        used, good, fails, ids = 0, [], {}, set()
        for n in range(limits.calls + 1):
            if n not in steps:
                break
            _, _, text, calls, ok, kind, error = steps[n]
            forced = used >= limits.calls
            if not calls:
                why = "empty_answer" if not text.strip() else "too_few_calls" if len(good) < limits.succeeded else "too_few_tools" if len(set(good)) < limits.tools else None
                out.append((run, n, "final", None, None, forced, None, "error" if why else "ok", why))
                break
            why = "several_calls" if len(calls) > 1 else "call_after_budget" if forced else "repeated_call_id" if calls[0][0] in ids else None
            if why:
                out.append((run, n, "stop", None, None, forced, None, "error", why))
                break
            ids.add(calls[0][0])
            name, args = calls[0][1:]
            if name not in TOOLS:
                ok, kind, error = False, "unknown_tool", None
            elif name == "profile" and set(json.loads(args)) != {"uri"}:
                ok, kind, error = False, "schema_validation", None
            used += 1
            left = limits.calls - used
            if ok:
                good.append(name)
                kind = None
            else:
                fails[(name, args, kind, error)] = fails.get((name, args, kind, error), 0) + 1
            why = None if ok or fails[(name, args, kind, error)] < limits.failures else "repeated_failure"
            out.append((run, n, "call", ok, kind, False, left if left <= 1 else None, "error" if why else "running", why))
            if why:
                break
    return sorted(out, key=repr)


def short(rows):
    return sorted(((r[0], r[1], r[2], r[5], r[6], r[7], r[9], r[12], r[13]) for r in rows), key=repr)


def random_runs(seed, n):
    r = random.Random(seed)
    rows = []
    for run in range(n):
        for step in range(r.randint(1, 12)):
            k = r.random()
            if k < 0.1:
                rows.append(final(run, step, r.choice(["done", " "])))
            elif k < 0.14:
                rows.append((run, step, "x", [("a", "plot", "{}"), ("b", "plot", "{}")], True, None, None))
            else:
                rows.append(call(run, step, r.choice(["profile", "plot", "other"]), r.choice(['{"uri": "a"}', '{"uri": "b"}', '{"url": "a"}']), r.random() < 0.8, r.choice(["e", "f"]), id=r.choice([None, None, None, None, "same"])))
    return rows


def test_budget_warns_with_one_call_left_and_forces_an_answer(spark):
    got = looped(spark, [call(1, k) for k in range(8)] + [final(1, 8)] + [call(2, k) for k in range(9)])
    rows = {(r[0], r[1]): r for r in got}
    assert [rows[1, k][9] for k in (5, 6, 7)] == [None, 1, 0]
    assert (rows[1, 8][2], rows[1, 8][7], rows[1, 8][12]) == ("final", True, "ok")
    assert (rows[2, 8][2], rows[2, 8][7], rows[2, 8][12], rows[2, 8][13]) == ("stop", True, "error", "call_after_budget")


def test_a_failure_may_be_mended_but_not_repeated(spark):
    bad = '{"session": 1}'
    mended = [call(1, 0, arguments=bad), call(1, 1, arguments='{"session": 2}'), call(1, 2), final(1, 3)]
    repeated = [call(2, 0, arguments=bad), call(2, 1, arguments=bad), call(2, 2), final(2, 3)]
    got = looped(spark, mended + repeated)
    assert [(r[0], r[5], r[12]) for r in got] == [(1, False, "running"), (1, False, "running"), (1, True, "running"), (1, None, "ok"), (2, False, "running"), (2, False, "error")]


@pytest.mark.parametrize("limits", [Limits(), Limits(calls=3, succeeded=2, tools=2, failures=1)])
def test_rows_equal_plain_ones(spark, limits):
    rows = random_runs(5, 60)
    assert short(looped(spark, rows, limits)) == in_python(rows, limits)


def test_batches_of_any_order_give_the_rows_of_one(spark, tmp_path):
    rows = random_runs(9, 40)
    random.Random(1).shuffle(rows)
    got = looped(spark, rows, tmp=tmp_path, parts=6, files=2)
    assert short(got) == in_python(rows)
    assert got == looped(spark, rows)


def test_a_later_run_goes_on(spark, tmp_path):
    first, later = [call(1, 0), call(1, 2)], [call(1, 1), final(1, 3), call(1, 4)]
    for k, rows in enumerate((first, later)):
        spark.createDataFrame(rows, DDL).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(spark.createDataFrame(first, DDL).schema).parquet(f"{tmp_path}/in")
        run_loop(stream, "run", TOOLS, f"file://{tmp_path}/out", f"file://{tmp_path}/state")
        got = sorted(r.step for r in spark.read.parquet(f"file://{tmp_path}/out").collect())
        assert got == ([0], [0, 1, 2, 3])[k]


def test_odd_steps(spark):
    rows = [(1, None, "x", None, None, None, None), (None, 0, "x", [], None, None, None), (2, 0, None, None, None, None, None), (3, 0, "x", [(None, None, None)], True, None, None), (4, 0, "x", [("c", "plot", None)], None, None, None), (5, 1, "late", [], None, None, None)]
    got = looped(spark, rows)
    assert [(r[0], r[2], r[5], r[6], r[12], r[13]) for r in got] == [(2, "final", None, None, "error", "empty_answer"), (3, "call", False, "unknown_tool", "running", None), (4, "call", False, got[2][6], "running", None)]
    assert looped(spark, []) == []


def test_state_takes_rows_as_they_come():
    """A run's steps are taken row by row, without a table for each run and batch."""
    from pyspark.sql import Row

    from tidemark.streaming import agent_loop as al

    class Held:
        kept = None

        def get(self):
            return self.kept

        def update(self, value):
            self.kept = value

    loop = al._Loop(Limits(), "run")
    loop.held = Held()
    step = lambda n, calls: Row(run=7, step=n, text="done", n_calls=calls, call_id=f"c{n}", name="plot", ok=True, error_type=None, signature="s")
    assert list(loop.handleInputRows((7,), iter([step(1, 0)]), None)) == []
    got = list(loop.handleInputRows((7,), iter([step(0, 1)]), None))
    assert [(r.run, r.step, r.kind, r.used, r.status) for r in got] == [(7, 0, "call", 1, "running"), (7, 1, "final", 1, "ok")]
