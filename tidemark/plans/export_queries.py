"""Queries on exported records, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import exports as ex
from tidemark.plans.loop_queries import _RUN, _run
from tidemark.plans.panel_queries import _t


def tool_conversations(s: SparkSession, d: str) -> DataFrame:
    """A user's events of a week as a run: a request, a call and an answer for each event, purchases with an image; small values called wrongly."""
    e = _t(s, d, "events").withColumn("run", _run())
    none, no_calls = F.array().cast("array<string>"), F.array().cast("array<struct<name: string, arguments: string>>")
    kind, value, props = F.col("event_type"), F.col("value"), F.col("props")
    call = F.struct((F.col("event_id") * 2).alias("pos"), F.lit("assistant").alias("role"), F.when(value > 50, "why").otherwise(" ").alias("text"), none.alias("images"), F.lit(None).cast("string").alias("name"), F.array(F.struct(kind.alias("name"), F.when(value < 0.3, "[]").otherwise(props).alias("arguments"))).alias("calls"))
    image = F.when(kind == "purchase", F.array(F.concat(F.lit("p"), F.col("event_id"), F.lit(".png")))).otherwise(none)
    answer = F.struct((F.col("event_id") * 2 + 1).alias("pos"), F.lit("tool").alias("role"), F.format_string("%.2f", value).alias("text"), image.alias("images"), kind.alias("name"), no_calls.alias("calls"))
    turns = e.select("run", F.inline(F.array(call, answer)))
    opening = e.select("run").distinct().select("run", F.lit(-1).cast("long").alias("pos"), F.lit("user").alias("role"), F.lit("<image> look").alias("text"), F.array(F.lit("a.png")).alias("images"), F.lit(None).cast("string").alias("name"), no_calls.alias("calls"))
    made = ex.tool_conversations(opening.unionByName(turns), "run", "image of {name}")
    return made.select("run", F.size(F.coalesce("images", none)).alias("n_images"), F.sha2(ex.as_json(F.col("messages")), 256).alias("messages_sha256"), "error")


QUERIES = {"tool_conversations": tool_conversations}

_TEXT = lambda x: f"'{{\"type\":\"text\",\"text\":\"' || {x} || '\"}}'"
_IMAGE = lambda x: f"'{{\"type\":\"image\",\"path\":\"' || {x} || '\"}}'"

ORACLE_SQL = {
    "tool_conversations": f"""WITH e AS (
          SELECT {_RUN}, event_id, event_type, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k, 'p' || event_id || '.png' AS image FROM events
        ), t AS (
          SELECT run, event_id, value < 0.3 AS wrong, event_type = 'purchase' AS shows,
                 '{{"role":"assistant",' || CASE WHEN value > 50 THEN '"content":[' || {_TEXT("'why'")} || '],' ELSE '' END || '"tool_calls":[{{"type":"function","function":{{"name":"' || event_type || '","arguments":{{"k":' || k || '}}}}}}]}}' || ','
                 || '{{"role":"tool","content":[' || {_TEXT("printf('%.2f', value)")} || '],"name":"' || event_type || '"}}'
                 || CASE WHEN event_type = 'purchase' THEN ',{{"role":"user","content":[' || {_IMAGE('image')} || ',' || {_TEXT("'image of ' || event_type")} || ']}}' ELSE '' END AS m FROM e
        )
        SELECT run, CAST(CASE WHEN bool_or(wrong) THEN 0 ELSE 1 + count(*) FILTER (shows) END AS INTEGER) AS n_images,
               CASE WHEN NOT bool_or(wrong) THEN sha256('[{{"role":"user","content":[' || {_IMAGE("'a.png'")} || ',' || {_TEXT("'look'")} || ']}},' || string_agg(m, ',' ORDER BY event_id) || ']') END AS messages_sha256,
               CASE WHEN bool_or(wrong) THEN 'arguments' END AS error FROM t GROUP BY run""",
}
