"""Whether a recorded run's calls, events and evidence agree: each call against its tool's schema, each result against its hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import json_values as jv

# Parts of the score, the score to pass, the relevance of a run without a preferred tool, a short answer, paths that mustn't be shown.
PARTS = {"structure": 0.30, "evidence": 0.30, "tools": 0.20, "relevance": 0.10, "answer": 0.10}
PASS, OFF_TOPIC, BRIEF = 0.8, 0.7, 60
LOCAL_PATHS = ["/Users/", "/private/tmp/", "/private/var/", "C:\\"]


def evidence_hash(ok: Column, result: Column) -> Column:
    """SHA-256 of what a run shows of an event: whether it worked, and the result without absolute paths."""
    return F.sha2(F.concat(F.when(ok, "ok:").otherwise("failed:"), F.coalesce(jv.clean_result(result), F.lit("null"))), 256)


def _breach(calls: DataFrame, tools: dict[str, dict]) -> Column:
    """undefined, malformed or invalid: why a call's arguments don't fit its tool; null if they do."""
    found: Column = F.lit(None).cast("string")
    for name, schema in tools.items():
        errors = jv.check_schema(F.col("arguments"), schema)
        found = F.when(F.col("name") == name, F.when(errors.isNull(), "malformed").when(F.size(errors) > 0, "invalid")).otherwise(found)
    return F.when(~F.coalesce(F.col("name").isin(*tools), F.lit(False)), "undefined").otherwise(found)


def evidence_review(calls: DataFrame, events: DataFrame, runs: DataFrame, shown: DataFrame, key: str, tools: dict[str, dict]) -> DataFrame:
    """A row for each run: sorted flags and warnings, the five parts of the score, score and passed.

    ``calls`` (ord, call_id, name, arguments) are what the messages ask for, ``events`` (ord, call_id, name, arguments, ok,
    result, evidence) what was recorded, with the hash noted then (null: none), ``shown`` (text) all texts of the run,
    and ``runs`` its answer, dataset_path, declared (successful calls), declared_tools and preferred (arrays of names).
    ``tools`` maps a tool's name to the schema of its arguments.

    Calls meet events place by place and by id; everything else is sums by run, so no run is gathered.  A run without
    calls lacks a successful one; a null answer is empty, null arrays are; calls of unknown runs are left out.
    """
    asked = calls.select(key, F.row_number().over(Window.partitionBy(key).orderBy("ord")).alias("n"), "call_id", "name", "arguments", _breach(calls, tools).alias("breach"))
    done = events.select(
        key, F.row_number().over(Window.partitionBy(key).orderBy("ord")).alias("n"), F.col("call_id").alias("e_id"), F.col("name").alias("e_name"), F.col("arguments").alias("e_arguments"),
        F.coalesce("ok", F.lit(False)).alias("ok"), (evidence_hash(F.coalesce("ok", F.lit(False)), F.col("result")) != F.col("evidence")).alias("other"),
        F.row_number().over(Window.partitionBy(key, "name", "arguments", "ok").orderBy("ord")).alias("nth"),
    )
    met = asked.join(done, [key, "n"], "full")
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    here = F.col("call_id").isNotNull() & F.col("e_id").isNotNull()
    counts = met.groupBy(key).agg(
        n(~F.col("call_id").eqNullSafe(F.col("e_id"))).alias("unmatched"),
        n(here & (~F.col("name").eqNullSafe(F.col("e_name")) | ~F.col("arguments").eqNullSafe(F.col("e_arguments")))).alias("payload"), n(F.col("other")).alias("hash"),
        n(F.col("breach") == "undefined").alias("undefined"), n(F.col("breach") == "malformed").alias("malformed"), n((F.col("breach") == "invalid") & F.col("ok")).alias("invalid"),
        n((F.col("breach") == "invalid") & ~F.coalesce("ok", F.lit(False))).alias("mended"), n(F.col("ok")).alias("good"), n(~F.col("ok")).alias("bad"), n(F.col("ok") & (F.col("nth") > 1)).alias("again"),
        F.array_sort(F.collect_set(F.when(F.col("ok"), F.col("e_name")))).alias("used"),
    )
    path = F.col("dataset_path")
    leaks = shown.join(runs.select(key, "dataset_path"), key).groupBy(key).agg(n((path != "") & F.col("text").contains(path)).alias("leaked"), n(F.exists(F.array(*map(F.lit, LOCAL_PATHS)), lambda p: F.col("text").contains(p))).alias("local"))
    none = F.array().cast("array<string>")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    used, wanted, answer = F.coalesce("used", none), F.coalesce("preferred", none), F.trim(F.coalesce("answer", F.lit("")))
    flags = {
        "absolute_dataset_path_leak": zero("leaked") > 0,
        "distinct_successful_tools_mismatch": F.array_sort(F.array_distinct(F.coalesce("declared_tools", none))) != used,
        "empty_final_answer": answer == "",
        "malformed_tool_arguments": zero("malformed") > 0,
        "no_successful_tool_call": zero("good") == 0,
        "runtime_absolute_path_leak": zero("local") > 0,
        "successful_invalid_tool_arguments": zero("invalid") > 0,
        "successful_tool_count_mismatch": ~F.col("declared").eqNullSafe(zero("good")),
        "tool_event_call_id_mismatch": zero("unmatched") > 0,
        "tool_event_evidence_hash_mismatch": zero("hash") > 0,
        "tool_event_payload_mismatch": zero("payload") > 0,
        "undefined_tool": zero("undefined") > 0,
    }
    warnings = {
        "final_answer_brief": F.length(answer) < BRIEF,
        "recovered_invalid_tool_arguments": zero("mended") > 0,
        "recovered_tool_failures": zero("bad") > 0,
        "redundant_identical_successful_call": zero("again") > 0,
    }
    named = lambda rules: F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in rules.items()]))
    whole = runs.join(counts, key, "left").join(leaks, key, "left").withColumns({"flags": named(flags), "warnings": named(warnings)})
    free = lambda *starts: (~F.exists("flags", lambda f: F.exists(F.array(*map(F.lit, starts)), lambda s: f.startswith(s)))).cast("double")
    parts = {
        "structure": free("tool_event_"),
        "evidence": free("absolute_", "runtime_absolute_"),
        "tools": F.when(F.array_contains("flags", "no_successful_tool_call"), 0.0).otherwise(free("undefined_", "malformed_", "successful_invalid_")),
        "relevance": F.when((F.size(wanted) == 0) | F.arrays_overlap(wanted, used), 1.0).otherwise(OFF_TOPIC),
        "answer": (answer != "").cast("double"),
    }
    scored = whole.withColumns(parts)
    score = F.round(sum((F.col(p) * w for p, w in PARTS.items()), F.lit(0.0)), 4)
    return scored.select(key, "flags", "warnings", *PARTS, score.alias("score"), ((score >= PASS) & (F.size("flags") == 0)).alias("passed"))
