"""Recorded runs and questions as the nested records that training and audits read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTENT = "array<struct<type: string, text: string, path: string>>"


def _content(text: Column, images: Column) -> Column:
    """Parts of a message: its images, then its text without their placeholders."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), r"<image>\s*", "")
    shown = F.transform(images, lambda p: F.struct(F.lit("image").alias("type"), F.lit(None).cast("string").alias("text"), p.alias("path")))
    return F.concat(shown, F.array(F.struct(F.lit("text").alias("type"), bare.alias("text"), F.lit(None).cast("string").alias("path")))).cast(CONTENT)


def tool_conversations(messages: DataFrame, key: str, notice: str = "{name}") -> DataFrame:
    """A row for each run: its messages as conversational training data, its images, and why it can't be exported (else null).

    ``messages`` has pos, role, text, images (array), name (of a tool's answer) and calls (array of name and
    arguments as a JSON text).  An assistant's calls become objects with their arguments as values; a tool's
    images follow its answer as a turn of the user, with ``notice`` as text ({name} is the tool).  An unknown
    role, or arguments that aren't an object, make no messages but an error.

    A run is gathered into its own record, which holds it anyway.  Null texts are empty, null images and calls
    none; equal places go by role and text.
    """
    images = F.coalesce("images", F.array().cast("array<string>"))
    parsed = F.transform(F.coalesce("calls", F.array().cast(messages.schema["calls"].dataType)), lambda c: F.struct(c["name"].alias("name"), F.try_parse_json(c["arguments"]).alias("arguments")))
    wrong = F.exists(parsed, lambda c: ~F.coalesce(F.schema_of_variant(c["arguments"]).startswith("OBJECT"), F.lit(False)))
    error = F.when(~F.coalesce(F.col("role").isin("system", "user", "assistant", "tool"), F.lit(False)), F.concat(F.lit("role "), F.coalesce("role", F.lit("null")))).when((F.col("role") == "assistant") & wrong, "arguments")
    calls = F.when((F.col("role") == "assistant") & (F.size(parsed) > 0), F.transform(parsed, lambda c: F.struct(F.lit("function").alias("type"), F.struct(c["name"].alias("name"), F.to_json(c["arguments"]).alias("arguments")).alias("function"))))
    text, shown = F.coalesce("text", F.lit("")), F.when(F.col("role").isin("system", "user"), images).otherwise(F.array().cast("array<string>"))
    content = F.when(calls.isNotNull() & (F.trim(text) == ""), None).otherwise(_content(F.when(calls.isNotNull(), F.trim(text)).otherwise(text), shown))
    turn = lambda role, content, calls, name: F.struct(role.alias("role"), content.alias("content"), calls.alias("tool_calls"), name.alias("name"))
    none = F.lit(None)
    own = turn(F.col("role"), content, calls, F.when(F.col("role") == "tool", F.col("name")))
    told = F.replace(F.lit(notice), F.lit("{name}"), F.coalesce("name", F.lit("")))
    after = turn(F.lit("user"), _content(told, images), none.cast("array<struct<type: string, function: struct<name: string, arguments: string>>>"), none.cast("string"))
    turns = F.when((F.col("role") == "tool") & (F.size(images) > 0), F.array(own, after)).otherwise(F.array(own))
    kept = F.when(F.col("role").isin("system", "user", "tool"), images).otherwise(F.array().cast("array<string>"))
    each = messages.select(key, "pos", F.col("role").alias("r"), text.alias("x"), turns.alias("turns"), kept.alias("kept"), error.alias("error"))
    whole = each.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("pos", "r", "x", "turns", "kept"))).alias("m"), F.min("error").alias("error"))
    fine = F.col("error").isNull()
    flat = lambda name: F.when(fine, F.flatten(F.transform("m", lambda t: t[name])))
    return whole.select(key, flat("turns").alias("messages"), flat("kept").alias("images"), "error")


def as_json(messages: Column) -> Column:
    """The messages as JSON, the arguments of calls as objects; absent fields are left out."""
    one = lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"), F.transform(m["tool_calls"], lambda c: F.struct(c["type"].alias("type"), F.struct(c["function"]["name"].alias("name"), F.parse_json(c["function"]["arguments"]).alias("arguments")).alias("function"))).alias("tool_calls"), m["name"].alias("name"))
    return F.to_json(F.transform(messages, one))


def runtime_records(specs: DataFrame, generations: DataFrame, version: str, spec_version: str) -> DataFrame:
    """What a runtime needs of each question that has a text: id, spec_ref, task, prompt, resources and allowed_tools.

    ``specs`` has id, group_id, spec_hash, task, spec, goal, mode, scope, data_path, images and tools; ``generations``
    has group_id and user_request, so the questions of a pair share their text.
    """
    texts = generations.where(F.trim(F.coalesce("user_request", F.lit(""))) != "").groupBy("group_id").agg(F.min("user_request").alias("user_request"))
    met = specs.join(texts, "group_id")
    return met.select(
        "id", F.lit(version).alias("format_version"), F.struct(F.lit(spec_version).alias("version"), F.col("spec_hash").alias("hash")).alias("spec_ref"),
        F.struct(F.col("task").alias("category"), F.col("spec").alias("subtask_id"), "goal", F.col("mode").alias("input_mode"), F.coalesce("scope", F.lit("none")).alias("model_catalog_scope")).alias("task"),
        F.struct("user_request").alias("prompt"),
        F.struct(
            F.struct(F.col("data_path").alias("path"), F.lit("csv").alias("format")).alias("dataset"),
            F.transform(F.coalesce("images", F.array().cast("array<string>")), lambda p: F.struct(p.alias("path"), F.lit("image/png").alias("media_type"))).alias("images"),
        ).alias("resources"), F.array_distinct(F.filter("tools", lambda t: t != "")).alias("allowed_tools"),
    )


def coverage_rows(specs: DataFrame, runtime: DataFrame, audits: DataFrame) -> DataFrame:
    """``specs`` of the questions that exist, with their text, whether they passed (null if unknown) and their style (missing if unknown)."""
    texts = runtime.select("id", F.col("prompt.user_request").alias("user_request"))
    told = audits.select("id", "passed", "style")
    return specs.join(texts, "id").join(told, "id", "left").withColumn("style", F.coalesce("style", F.lit("missing")))
