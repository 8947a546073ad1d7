"""A bounded tool-use loop over recorded steps, with its state kept by Structured Streaming.

A trajectory is a model's steps: each calls one tool or gives the final answer.  What the loop may still do
depends on all earlier steps (calls used, tools that worked, failures by signature), so each trajectory has
a state that grows with the budget and no further, and steps may come in any order and in any batches.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions import json_values as jv

OUT = "step int, kind string, call_id string, name string, ok boolean, error_type string, forced boolean, used int, remaining int, succeeded int, tools string, status string, reason string"
COLUMNS = [column.split()[0] for column in OUT.split(", ")]
STEP = ("step", "text", "n_calls", "call_id", "name", "ok", "error_type", "signature")
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class Limits:
    """Calls at most, successful calls and different successful tools at least, and failures of one signature that end a run."""

    calls: int = 8
    succeeded: int = 1
    tools: int = 1
    failures: int = 2


@dataclass
class LoopState:
    """What a trajectory's further steps depend on; ``waiting`` are steps that came before their turn."""

    expected: int = 0
    used: int = 0
    succeeded: int = 0
    tools: list[str] = field(default_factory=list)
    ids: list[str] = field(default_factory=list)
    failures: dict[str, int] = field(default_factory=dict)
    waiting: dict[str, dict] = field(default_factory=dict)
    status: str = "running"

    def offer(self, step: dict, limits: Limits) -> None:
        """Keep a step until its turn; one that was there already, or can't be reached any more, is left out."""
        n = step["step"]
        if self.status == "running" and self.expected <= n <= limits.calls:
            self.waiting.setdefault(str(n), step)

    def rows(self, limits: Limits) -> Iterator[dict]:
        while self.status == "running" and (step := self.waiting.pop(str(self.expected), None)):
            yield self._take(step, limits)
            self.expected += 1
        if self.status != "running":
            self.waiting, self.ids, self.failures = {}, [], {}

    def _take(self, step: dict, limits: Limits) -> dict:
        forced, kind, reason, made = self.used >= limits.calls, "call", None, step["n_calls"]
        row = dict.fromkeys(("call_id", "name", "ok", "error_type", "remaining"))
        if made == 0:
            kind, reason = "final", self._why_not_final(step, limits)
            self.status = "error" if reason else "ok"
        elif made > 1:
            kind, reason = "stop", "several_calls"
        elif forced:
            kind, reason = "stop", "call_after_budget"
        elif step["call_id"] in self.ids:
            kind, reason = "stop", "repeated_call_id"
        else:
            row |= {k: step[k] for k in ("call_id", "name", "ok", "error_type")}
            self.ids.append(step["call_id"])
            self.used += 1
            left = limits.calls - self.used
            row["remaining"] = left if left <= 1 else None
            if step["ok"]:
                self.succeeded += 1
                self.tools = sorted({*self.tools, step["name"]})
            else:
                again = self.failures[step["signature"]] = self.failures.get(step["signature"], 0) + 1
                reason = "repeated_failure" if again >= limits.failures else None
        if reason:
            self.status = "error"
        return row | {"step": step["step"], "kind": kind, "forced": forced, "used": self.used, "succeeded": self.succeeded, "tools": ",".join(self.tools), "status": self.status, "reason": reason}

    def _why_not_final(self, step: dict, limits: Limits) -> str | None:
        if not (step["text"] or "").strip():
            return "empty_answer"
        if self.succeeded < limits.succeeded:
            return "too_few_calls"
        return "too_few_tools" if len(self.tools) < limits.tools else None


def checked_steps(steps: DataFrame, key: str, tools: dict[str, dict]) -> DataFrame:
    """Steps (key, step, text, calls, ok, error_type, error) with each call's outcome and failure signature.

    ``calls`` are structs of id, name and arguments (JSON); ``ok``, ``error_type`` and ``error`` are what the
    tool answered.  A tool that isn't in ``tools`` (name to JSON schema) or arguments that break its schema
    never ran, so they fail as such.  A signature is the name, arguments and failure, so changed arguments
    are another try.
    """
    first = F.get("calls", F.lit(0))
    breach: Column = F.lit(False)
    for name, schema in tools.items():
        breach = F.when(first["name"] == name, F.size(jv.check_schema(first["arguments"], schema)) > 0).otherwise(breach)
    known = F.coalesce(first["name"].isin(*tools), F.lit(False)) if tools else F.lit(False)
    invalid = F.when(~known, "unknown_tool").when(F.coalesce(breach, F.lit(True)), "schema_validation")
    called = F.size(F.coalesce("calls", F.array().cast(steps.schema["calls"].dataType)))
    ok = invalid.isNull() & F.coalesce("ok", F.lit(False))
    kind = F.coalesce(invalid, F.when(~ok, F.coalesce("error_type", F.lit("tool_error"))))
    told = F.when(invalid.isNull(), F.col("error"))
    signature = F.sha2(F.to_json(F.struct(first["name"].alias("n"), kind.alias("k"), told.alias("e"), first["arguments"].alias("a"))), 256)
    return steps.where("step >= 0").select(
        key, F.col("step").cast("int").alias("step"), F.col("text").cast("string").alias("text"), called.alias("n_calls"),
        F.coalesce(first["id"].cast("string"), F.lit("")).alias("call_id"), first["name"].alias("name"), (ok & (called == 1)).alias("ok"),
        F.when(called == 1, kind).alias("error_type"), signature.alias("signature"),
    )


def _frame(key: str, value, rows: list[dict]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=COLUMNS)
    out.insert(0, key, value)
    return out.astype({"remaining": "Int32"})


def _offer_all(state: LoopState, steps: pd.DataFrame, limits: Limits) -> None:
    for step in steps.astype(object).where(steps.notna(), None).to_dict("records"):
        state.offer({k: step[k] for k in STEP} | {"step": int(step["step"]), "n_calls": int(step["n_calls"]), "ok": bool(step["ok"])}, limits)


class _Loop(StatefulProcessor):
    def __init__(self, limits: Limits, key: str):
        self.limits, self.key = limits, key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("loop", "state string")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        known = self.held.get()
        state = LoopState(**json.loads(known[0])) if known else LoopState()
        for row in rows:
            state.offer({k: row[k] for k in STEP}, self.limits)
        made = list(state.rows(self.limits))
        self.held.update((json.dumps(asdict(state)),))
        for row in made:
            yield Row(**{self.key: key[0]}, **{c: row[c] for c in COLUMNS})

    def close(self) -> None:
        pass


def agent_loop(steps: DataFrame, key: str, tools: dict[str, dict], limits: Limits = Limits()) -> DataFrame:
    """A row for each step that the loop takes, in a batch or a stream (whose state store ``state_store`` sets).

    Steps are numbered from 0.  A step with one call is an event (kind ``call``), one without is the final
    answer (``final``), one that may not be (``stop``) ends the run; ``forced`` says that no call was allowed
    any more, ``remaining`` counts the calls left when it is one or none.  ``status`` is running, ok or error
    with a ``reason``.  What follows an end is left out, as is what a run of so many calls can't reach, before
    any shuffle; so a trajectory's state and rows are bounded by the budget, however many steps it recorded.

    Of steps with one number the first to come counts, in a batch the least by its columns; a step waits for those before it, and one that never
    comes keeps the run open.  A null number or key is left out; null calls are none, a null answer is empty,
    a null outcome is a failure.
    """
    few = checked_steps(steps, key, tools).where((F.col("step") <= limits.calls) & F.col(key).isNotNull())
    schema = f"`{key}` {steps.schema[key].dataType.simpleString()}, {OUT}"
    if steps.isStreaming:
        return few.groupBy(key).transformWithState(_Loop(limits, key), outputStructType=schema, outputMode="Append", timeMode="None")

    def fold(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        state = LoopState()
        _offer_all(state, rows, limits)
        return _frame(key, group[0], list(state.rows(limits)))

    one = few.groupBy(key, "step").agg(F.min(F.struct(*STEP[1:])).alias("s")).select(key, "step", "s.*")
    return one.groupBy(key).applyInPandas(fold, schema)


@contextmanager
def state_store(spark: SparkSession):
    """Within, streams keep their state in RocksDB, which processors with state of their own need."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def run_loop(stream: DataFrame, key: str, tools: dict[str, dict], target: str, checkpoint: str, limits: Limits = Limits()) -> None:
    """Take the steps that are there, write the rows, and stop; a later run goes on where this one stopped.

    State and the log of written files are in ``checkpoint`` and ``target``, so a batch that is run again after a
    failure counts once.
    """
    with state_store(stream.sparkSession):
        query = agent_loop(stream, key, tools, limits).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
        query.outputMode("append").trigger(availableNow=True).start().awaitTermination()
