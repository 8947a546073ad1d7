"""Queries on recorded evidence, robust decomposition and likelihood forecasts, with the SQL that checks what SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.stats import r6
from tidemark.operators import arima, evidence, stl
from tidemark.plans.loop_queries import _RUN, _run
from tidemark.plans.panel_queries import _filled, _t

_SCHEMA = {"type": "object", "required": ["k"], "properties": {"k": {"type": "integer", "maximum": 60}}}
_TOOLS = {"click": _SCHEMA, "purchase": _SCHEMA, "view": {"type": "object"}, "signup": {"type": "object"}}


def evidence_review(s: SparkSession, d: str) -> DataFrame:
    """A user's events of a week as a run's calls; some were recorded otherwise, some hashes and declarations are off, some texts show a path."""
    e = _t(s, d, "events").withColumn("run", _run()).withColumns({"k": F.from_json("props", "k long")["k"], "ok": F.col("value") >= 20, "id": F.col("event_id").cast("string")})
    arguments = F.concat(F.lit('{"k": '), F.col("k"), F.lit("}"))
    result = F.concat(F.lit('{"path": "/data/'), F.col("event_type"), F.lit('.csv", "n": '), F.col("k"), F.lit("}"))
    calls = e.select("run", F.col("event_id").alias("ord"), F.when(F.col("value") < 300, F.col("id")).otherwise("other").alias("call_id"), F.col("event_type").alias("name"), F.when(F.col("value").between(0.5, 0.6), '{"k": 0}').otherwise(arguments).alias("arguments"))
    noted = F.when(F.col("value") >= 1, F.when(F.col("value") > 150, "stale").otherwise(evidence.evidence_hash(F.col("ok"), result)))
    events = e.select("run", F.col("event_id").alias("ord"), F.col("id").alias("call_id"), F.col("event_type").alias("name"), arguments.alias("arguments"), "ok", result.alias("result"), noted.alias("evidence"))
    runs = e.groupBy("run").agg(
        F.when(F.max("value") > 200, F.concat(F.lit("the answer rests on what the calls gave: "), F.array_join(F.array_sort(F.collect_set("event_type")), ", "))).otherwise(F.lit("short")).alias("answer"),
        (F.count_if("ok") + F.count_if(F.col("k") == 99)).alias("declared"), F.collect_set(F.when(F.col("ok") | (F.col("k") == 98), F.col("event_type"))).alias("declared_tools"),
    ).select("run", "answer", "declared", "declared_tools", F.lit("/data/view.csv").alias("dataset_path"), F.array(F.lit("purchase")).alias("preferred"))
    shown = e.select("run", F.when(F.col("value") > 180, result).otherwise(F.col("event_type")).alias("text"))
    judged = evidence.evidence_review(calls, events, runs, shown, "run", _TOOLS)
    return judged.select("run", F.array_join("flags", ",").alias("flags"), F.array_join("warnings", ",").alias("warnings"), *evidence.PARTS, "score", "passed")


def stl_robust(s: SparkSession, d: str) -> DataFrame:
    return stl.robust_components(_filled(s, d), 24).select("series_id", "t", *[r6(c).alias(c) for c in ("trend", "season", "rest", "weight")])


def arima_likelihood(s: SparkSession, d: str) -> DataFrame:
    """Twelve hours ahead of each hourly series, by the best of three models of its differences."""
    return arima.arima_forecast(_filled(s, d), [(1, 1, 1), (0, 1, 1), (1, 1, 0)], 12)


QUERIES = {"evidence_review": evidence_review, "stl_robust": stl_robust, "arima_likelihood": arima_likelihood}

_NAMED = lambda rules: "list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in rules.items()) + "], lambda x: x IS NOT NULL)"
_FLAGS = {
    "absolute_dataset_path_leak": "leaked > 0",
    "distinct_successful_tools_mismatch": "coalesce(told, []) <> coalesce(used, [])",
    "no_successful_tool_call": "good = 0",
    "successful_invalid_tool_arguments": "invalid > 0",
    "successful_tool_count_mismatch": "more > 0",
    "tool_event_call_id_mismatch": "unmatched > 0",
    "tool_event_evidence_hash_mismatch": "stale > 0",
    "tool_event_payload_mismatch": "payload > 0",
    "undefined_tool": "undefined > 0",
}
_WARNINGS = {"final_answer_brief": "length(answer) < 60", "recovered_invalid_tool_arguments": "mended > 0", "recovered_tool_failures": "bad > 0", "redundant_identical_successful_call": "again > 0"}

ORACLE_SQL = {
    "evidence_review": f"""WITH e AS (
          SELECT {_RUN}, event_id, event_type, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k, value >= 20 AS ok FROM events
        ), c AS (
          SELECT *, CASE WHEN value BETWEEN 0.5 AND 0.6 THEN 0 ELSE k END AS asked, row_number() OVER (PARTITION BY run, event_type, k, ok ORDER BY event_id) AS nth FROM e
        ), b AS (
          SELECT *, CASE WHEN event_type = 'error' THEN 'undefined' WHEN event_type IN ('click', 'purchase') AND asked > 60 THEN 'invalid' END AS breach FROM c
        ), r AS (
          SELECT run, count(*) FILTER (value > 180 AND event_type = 'view') AS leaked, count(*) FILTER (ok) AS good, count(*) FILTER (NOT ok) AS bad, count(*) FILTER (k = 99) AS more, count(*) FILTER (value >= 300) AS unmatched,
                 count(*) FILTER (value > 150) AS stale, count(*) FILTER (asked <> k) AS payload, count(*) FILTER (breach = 'undefined') AS undefined, count(*) FILTER (breach = 'invalid' AND ok) AS invalid, count(*) FILTER (breach = 'invalid' AND NOT ok) AS mended,
                 count(*) FILTER (ok AND nth > 1) AS again, list(DISTINCT event_type ORDER BY event_type) FILTER (ok) AS used, list(DISTINCT event_type ORDER BY event_type) FILTER (ok OR k = 98) AS told,
                 CASE WHEN max(value) > 200 THEN 'the answer rests on what the calls gave: ' || string_agg(DISTINCT event_type, ', ' ORDER BY event_type) ELSE 'short' END AS answer FROM b GROUP BY run
        ), g AS (
          SELECT *, {_NAMED(_FLAGS)} AS flags, {_NAMED(_WARNINGS)} AS warnings FROM r
        ), p AS (
          SELECT *, CASE WHEN unmatched + stale + payload > 0 THEN 0.0 ELSE 1.0 END AS structure, CASE WHEN leaked > 0 THEN 0.0 ELSE 1.0 END AS evidence, CASE WHEN good = 0 OR undefined + invalid > 0 THEN 0.0 ELSE 1.0 END AS tools,
                 CASE WHEN list_contains(coalesce(used, []), 'purchase') THEN 1.0 ELSE 0.7 END AS relevance, 1.0 AS answer_part FROM g
        )
        SELECT run, array_to_string(flags, ',') AS flags, array_to_string(warnings, ',') AS warnings, CAST(structure AS DOUBLE) AS structure, CAST(evidence AS DOUBLE) AS evidence, CAST(tools AS DOUBLE) AS tools, CAST(relevance AS DOUBLE) AS relevance,
               CAST(answer_part AS DOUBLE) AS answer, CAST(round(0.3 * structure + 0.3 * evidence + 0.2 * tools + 0.1 * relevance + 0.1, 4) AS DOUBLE) AS score, round(0.3 * structure + 0.3 * evidence + 0.2 * tools + 0.1 * relevance + 0.1, 4) >= 0.8 AND len(flags) = 0 AS passed FROM p""",
}
