"""Competing runs of a question as compact records: calls, answers, metrics, what a selector sees, selection and audit.

Tables: ``candidates`` (id, index, attempt, model, status, answer, tokens, latency, error_type, error), ``messages`` (id,
index, attempt, pos, role, text, calls: the ids of its calls), ``events`` (id, index, attempt, ord, call_id, name,
arguments, ok, result, error_type, error, images; arguments and result are JSON texts).  An attempt is one run; the
last attempt of (id, index) is the candidate, earlier ones are its failed attempts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import json_values as jv

KEY = ["id", "index", "attempt"]


def _error(type_: Column, text: Column, kind: str, said: str) -> Column:
    filled = lambda c, other: F.when(F.trim(c) != "", c).otherwise(other)
    return F.struct(F.coalesce(filled(type_, kind), F.lit(kind)).alias("type"), F.coalesce(filled(text, said), F.lit(said)).alias("message"))


def result_summary(result: Column) -> Column:
    """What to show of a tool's result: its summary, else its error, else its texts, else all of it, with bounds.

    ``result`` is a JSON text; one that isn't JSON gives null.
    """
    whole = F.try_parse_json(result)

    def part(path: str) -> Column:
        found = F.try_variant_get(whole, path, "variant")
        return F.when(~F.is_variant_null(found), F.to_json(found))

    texts = F.transform(F.try_variant_get(whole, "$.content", "array<variant>"), lambda v: F.try_variant_get(v, "$.text", "string"))
    said = F.filter(texts, lambda t: F.coalesce(t, F.lit("")) != "")
    error = F.concat(F.lit('{"error":'), part("$.structuredContent.error"), F.lit("}"))
    shown = F.coalesce(part("$.structuredContent.summary"), error, F.when(F.size(said) > 0, F.to_json(F.struct(said.alias("text")))), F.to_json(whole))
    return jv.bounded(shown)


def call_views(events: DataFrame, messages: DataFrame, search: str = "model_catalog_search") -> DataFrame:
    """A row for each event: name, arguments, ok, result (summary), decision, error, images (file names), found (names).

    A call's decision is the text of the assistant's message that asked for it; blank texts decide nothing, and of two
    messages that name one call the later counts.  ``found`` are the names of the candidates that a successful
    ``search`` returned.  Failed calls without a message get a plain one.  Null call ids meet no message.
    """
    asked = messages.where((F.col("role") == "assistant") & (F.trim("text") != ""))
    decisions = asked.select(*KEY, "pos", F.trim("text").alias("text"), F.explode("calls").alias("call_id")).groupBy(*KEY, "call_id").agg(F.max_by("text", F.struct("pos", "text")).alias("decision"))
    names = F.transform(F.try_variant_get(F.try_parse_json("result"), "$.structuredContent.summary.candidates", "array<variant>"), lambda v: F.try_variant_get(v, "$.name", "string"))
    found = F.when(F.col("ok") & (F.col("name") == search), F.filter(names, lambda n: F.coalesce(n, F.lit("")) != ""))
    ok = F.coalesce("ok", F.lit(False))
    return events.join(decisions, [*KEY, "call_id"], "left").select(
        *KEY, "ord", "call_id", "name", F.coalesce("arguments", F.lit("{}")).alias("arguments"), ok.alias("ok"), result_summary(F.col("result")).alias("result"), "decision",
        F.when(~ok, _error(F.col("error_type"), F.col("error"), "tool_error", "Tool call failed")).alias("error"),
        F.transform(F.coalesce("images", F.array().cast("array<string>")), lambda p: F.element_at(F.split(p, "/"), -1)).alias("images"),
        F.coalesce(found, F.array().cast("array<string>")).alias("found"),
    )


def run_metrics(candidates: DataFrame, events: DataFrame) -> DataFrame:
    """Calls, successes, failures, sorted distinct successful tools, tokens, seconds and number of each attempt."""
    counted = events.groupBy(*KEY).agg(F.count("*").alias("calls"), F.count_if("ok").alias("good"), F.array_sort(F.collect_set(F.when(F.col("ok"), F.col("name")))).alias("tools"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    made = F.struct(
        zero("calls").alias("tool_calls"), zero("good").alias("successful"), (zero("calls") - zero("good")).alias("failed"), F.coalesce("tools", F.array().cast("array<string>")).alias("tools"),
        zero("tokens").cast("long").alias("total_tokens"), F.round(zero("latency").cast("double"), 3).alias("latency_seconds"), F.col("attempt").alias("attempts"),
    )
    return candidates.select(*KEY, "tokens", "latency").join(counted, KEY, "left").select(*KEY, made.alias("metrics"))


def final_answers(candidates: DataFrame, messages: DataFrame) -> DataFrame:
    """Each attempt's recorded answer, else the text of its last assistant message without calls, else an empty text."""
    open_ = (F.col("role") == "assistant") & (F.coalesce(F.size("calls"), F.lit(0)) <= 0)
    last = messages.where(open_).groupBy(*KEY).agg(F.max(F.struct("pos", F.trim(F.coalesce("text", F.lit(""))).alias("text"))).alias("last"))
    recorded = F.when(F.trim("answer") != "", F.trim("answer"))
    return candidates.select(*KEY, "answer").join(last, KEY, "left").select(*KEY, F.coalesce(recorded, "last.text", F.lit("")).alias("final_answer"))


def _gathered(rows: DataFrame, key: list[str], columns: list[str], name: str, order: str) -> DataFrame:
    """The rows of a key as an array in their order; a key is one run, whose record holds them anyway."""
    return rows.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct(order, *[c for c in columns if c != order]))).alias(name))


def attempt_records(candidates: DataFrame, messages: DataFrame, events: DataFrame, search: str = "model_catalog_search") -> DataFrame:
    """A row for each attempt: model, ok, tool_calls, final_answer, metrics and error (of one that isn't ok)."""
    columns = ["call_id", "name", "arguments", "ok", "result", "decision", "error", "images", "found"]
    calls = _gathered(call_views(events, messages, search), KEY, columns, "tool_calls", "ord")
    ok = F.coalesce(F.col("status") == "ok", F.lit(False))
    told = candidates.select(*KEY, "model", ok.alias("ok"), F.when(~ok, _error(F.col("error_type"), F.col("error"), "generation_error", "Candidate generation failed")).alias("error"))
    whole = told.join(calls, KEY, "left").join(final_answers(candidates, messages), KEY).join(run_metrics(candidates, events), KEY)
    return whole.withColumn("tool_calls", F.coalesce("tool_calls", F.array().cast(whole.schema["tool_calls"].dataType)))


def competition_records(attempts: DataFrame, reviews: DataFrame, choices: DataFrame) -> DataFrame:
    """A row for each question: status, rule, winner, selected (the winner's record, null if none), candidates (the audit).

    ``attempts`` are those of ``attempt_records``, ``reviews`` has id, index, passed, score and flags (array), ``choices``
    id, winner (an index, null if no candidate passed) and rule.  In the audit a candidate that isn't ok shows no
    calls but its error; its failed attempts show theirs.  A question without attempts has an empty audit.
    """
    last = Window.partitionBy("id", "index")
    placed = attempts.withColumn("last", F.max("attempt").over(last))
    failed = _gathered(placed.where("attempt < last"), ["id", "index"], ["attempt", "error", "tool_calls", "metrics"], "failed_attempts", "attempt")
    marks = reviews.select("id", "index", F.struct(F.coalesce("passed", F.lit(False)).alias("passed"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"), F.coalesce("flags", F.array().cast("array<string>")).alias("flags")).alias("review"))
    own = placed.where("attempt = last").join(failed, ["id", "index"], "left").join(marks, ["id", "index"], "left")
    none = F.array().cast(own.schema["tool_calls"].dataType)
    kept = own.withColumns({"failed_attempts": F.coalesce("failed_attempts", F.array().cast(own.schema["failed_attempts"].dataType)), "tool_calls": F.when(F.col("ok"), F.col("tool_calls")).otherwise(none)})
    columns = ["model", "ok", "error", "tool_calls", "final_answer", "metrics", "review", "failed_attempts"]
    audit = _gathered(kept, ["id"], columns, "candidates", "index")
    met = choices.select("id", "winner", "rule").join(audit, "id", "left").withColumn("candidates", F.coalesce("candidates", F.array().cast(audit.schema["candidates"].dataType)))
    won = F.get(F.filter("candidates", lambda c: c["index"] == F.col("winner")), F.lit(0))
    selected = F.when(won.isNotNull(), F.struct(won["model"].alias("model"), won["tool_calls"].alias("tool_calls"), won["final_answer"].alias("final_answer"), won["metrics"].alias("metrics")))
    return met.select("id", F.when(won.isNotNull(), "ok").otherwise("error").alias("status"), "rule", "winner", selected.alias("selected"), "candidates")


def selector_material(attempts: DataFrame, events: DataFrame, limit: int = 6000) -> DataFrame:
    """What a selector reads of each attempt: model, final_answer and its calls with whole results up to ``limit`` characters.

    A longer result becomes a record of its hash, length and beginning; absolute paths become file names first.
    """
    clean = F.to_json(F.try_parse_json(jv.clean_result(F.col("result"))))
    long = F.to_json(F.struct(F.lit(True).alias("truncated"), F.sha2(clean.cast("binary"), 256).alias("full_result_sha256"), F.length(clean).alias("full_result_chars"), F.substring(clean, 1, limit).alias("preview")))
    shown = events.withColumn("result", F.when(F.length(clean) > limit, long).otherwise(clean))
    calls = _gathered(shown, KEY, ["name", "arguments", "ok", "result"], "events", "ord")
    return attempts.select(*KEY, "model", "final_answer").join(calls, KEY, "left").withColumn("events", F.coalesce("events", F.array().cast(calls.schema["events"].dataType)))


def selector_images(asked: DataFrame, events: DataFrame, existing: DataFrame) -> DataFrame:
    """id, image_index, source, index, tool, filename and path of each question's images that exist, each once.

    ``asked`` has id, pos and path of the question's own images, which come first; those of the tools follow by
    candidate, attempt, event and place.  ``existing`` has the paths that exist.  Numbers run within a question.
    """
    none = F.lit(None)
    first = asked.select("id", "path", F.struct(F.lit(0).alias("source"), F.lit(-1).cast("long").alias("index"), F.lit(0).cast("long").alias("attempt"), F.lit(0).cast("long").alias("ord"), F.col("pos").cast("long").alias("pos"), none.cast("string").alias("tool")).alias("at"))
    drawn = events.select("id", "index", "attempt", "ord", "name", F.posexplode("images").alias("pos", "path"))
    later = drawn.select("id", "path", F.struct(F.lit(1).alias("source"), F.col("index").cast("long").alias("index"), F.col("attempt").cast("long").alias("attempt"), F.col("ord").cast("long").alias("ord"), F.col("pos").cast("long").alias("pos"), F.col("name").alias("tool")).alias("at"))
    once = first.unionByName(later).groupBy("id", "path").agg(F.min("at").alias("at")).join(existing.select("path").distinct(), "path", "left_semi")
    number = F.row_number().over(Window.partitionBy("id").orderBy("at", "path")) - 1
    tool = F.col("at.source") == 1
    return once.select("id", number.alias("image_index"), F.when(tool, "tool_result").otherwise("initial_question").alias("source"), F.when(tool, F.col("at.index")).alias("index"), "at.tool", F.element_at(F.split("path", "/"), -1).alias("filename"), "path")
