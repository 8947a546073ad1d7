"""Queries on competing runs and graded answers, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import competition as cp
from tidemark.operators import graded_answers as ga
from tidemark.operators.review import choose_candidate
from tidemark.plans.loop_queries import _RUN, _START, _run
from tidemark.plans.panel_queries import _t

#: A purchase is a search, a click has a summary, a view has texts, an error has one; anything else answers with its properties.
_RESULT = """CASE event_type WHEN 'purchase' THEN concat('{"structuredContent": {"summary": {"candidates": [{"name": "m', event_id % 5, '"}, {"size": 1}]}}}')
    WHEN 'click' THEN concat('{"structuredContent": {"summary": ', props, '}}') WHEN 'error' THEN '{"structuredContent": {"summary": null, "error": "bad"}}'
    WHEN 'view' THEN '{"content": [{"type": "image"}, {"type": "text", "text": "seen"}]}' ELSE props END"""


def _recorded(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A user's week as a question with two candidates: even and odd events; what came from its fourth day on is a second attempt."""
    day = F.datediff(F.col("ts").cast("date"), F.lit(_START).cast("date")) % 7
    e = _t(s, d, "events").withColumns({"id": _run(), "index": F.col("event_id") % 2, "attempt": F.when(day < 3, 1).otherwise(2)})
    call = F.col("event_id").cast("string")
    events = e.select(
        *cp.KEY, F.col("event_id").alias("ord"), call.alias("call_id"), F.col("event_type").alias("name"), F.col("props").alias("arguments"), (F.col("value") >= 20).alias("ok"), F.expr(_RESULT).alias("result"),
        F.when(F.col("value") < 5, "Timeout").otherwise(" ").alias("error_type"), F.lit(None).cast("string").alias("error"),
        F.when(F.col("event_type") == "purchase", F.array(F.concat(F.lit("/r/p"), F.get_json_object("props", "$.k"), F.lit(".png")))).alias("images"), "value", "user_id",
    )
    none = F.array().cast("array<string>")
    turns = events.select(*cp.KEY, "ord", F.when(F.col("value") > 10, F.concat(F.lit(" try "), F.col("name"))).otherwise(" ").alias("text"), F.array("call_id").alias("calls"))
    closing = events.groupBy(*cp.KEY).agg((F.max("ord") + 1).alias("ord"), F.concat(F.lit("answer "), F.count("*"), F.lit(" ")).alias("text")).withColumn("calls", none)
    messages = turns.unionByName(closing).select(*cp.KEY, F.col("ord").alias("pos"), F.lit("assistant").alias("role"), "text", "calls")
    runs = events.groupBy(*cp.KEY).agg(F.max("value").alias("top"), F.count("*").alias("n"))
    candidates = runs.select(
        *cp.KEY, F.concat(F.lit("model"), F.col("index")).alias("model"), F.when(F.col("top") >= 40, "ok").otherwise("error").alias("status"), F.when(F.col("n") > 3, "recorded").alias("answer"),
        (F.col("n") * 10).alias("tokens"), F.lit(1.0).alias("latency"), F.lit(None).cast("string").alias("error_type"), F.lit(None).cast("string").alias("error"),
    )
    return candidates, messages, events


def tool_call_views(s: SparkSession, d: str) -> DataFrame:
    """The recorded calls as an audit shows them."""
    _, messages, events = _recorded(s, d)
    views = cp.call_views(events, messages, "purchase")
    return views.select("id", "index", "attempt", F.col("ord").alias("event_id"), "ok", "result", "decision", F.concat_ws(":", "error.type", "error.message").alias("error"), F.array_join("images", ",").alias("images"), F.array_join("found", ",").alias("found"))


def competitions(s: SparkSession, d: str) -> DataFrame:
    """The better of each question's two candidates, and the audit of both."""
    candidates, messages, events = _recorded(s, d)
    attempts = cp.attempt_records(candidates, messages, events, "purchase")
    m = F.col("metrics")
    last = attempts.groupBy("id", "index").agg(F.max_by(F.struct(m["tool_calls"].alias("calls"), m["successful"].alias("good"), "ok"), "attempt").alias("r")).select("id", "index", "r.*")
    scored = last.select("id", "index", (F.col("ok") & (F.col("good") > 0)).alias("passed"), F.round(F.col("good") / F.col("calls"), 4).alias("score"), (F.col("calls") - F.col("good")).alias("failures"), "calls", F.when(F.col("good") == 0, F.array(F.lit("no_evidence"))).alias("flags"))
    choices = choose_candidate(scored, "id").withColumnRenamed("reason", "rule")
    made = cp.competition_records(attempts, scored, choices)
    short = lambda c: F.concat_ws(":", c["index"], c["model"], c["ok"], F.size(c["tool_calls"]), F.size(c["failed_attempts"]), c["metrics"]["attempts"], c["review"]["passed"], c["error"]["type"])
    return made.select("id", "status", "rule", "winner", "selected.model", "selected.final_answer", F.array_join("selected.metrics.tools", ",").alias("tools"), F.col("selected.metrics.total_tokens").alias("total_tokens"), F.array_join(F.transform("candidates", short), ";").alias("audit"))


def selector_views(s: SparkSession, d: str) -> DataFrame:
    """The images that a selector is shown with each question; those of purchases below 10 weren't kept, those of the question were."""
    _, _, events = _recorded(s, d)
    asked = events.groupBy("id").agg(F.min("user_id").alias("u")).select("id", F.lit(0).alias("pos"), F.concat(F.lit("/q/"), F.col("u"), F.lit(".png")).alias("path"))
    existing = asked.select("path").unionByName(events.where("value >= 10").select(F.explode("images").alias("path")))
    return cp.selector_images(asked, events, existing).drop("path")


#: What the query's rules look for: the texts are made of these bits of words.
_RULES = ga.Rules(image_terms=("heat", "ound"), signals=("and", "the ", "tion", "of", "ing", "ness"), short=120, long=(250, 2500))


def _answers(s: SparkSession, d: str) -> DataFrame:
    """A question and the answer after it, every third conversation as a record; the question's first words are to be covered."""
    c = _t(s, d, "conversations")
    asked = c.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    said = c.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("said"))
    record = F.concat(F.lit('{"tool_plan": [], "answer": '), F.to_json(F.array("said")), F.lit(', "quality_checks": "and"}'))
    words = F.split(F.lower("question"), " ")
    return asked.join(said, ["conv_id", "turn"]).select(
        "conv_id", "turn", "question", F.when(F.col("conv_id") % 3 == 0, record).otherwise(F.col("said")).alias("answer"),
        F.slice(words, 1, 2).alias("tools"), F.slice(words, 3, 3).alias("cover"), F.when(F.length("question") > 150, "image_text").otherwise("text_only").alias("mode"),
    )


def graded(s: SparkSession, d: str) -> DataFrame:
    """Marks, flags and label of each answer."""
    g = ga.grade_answers(_answers(s, d), ["conv_id", "turn"], _RULES)
    return g.select("conv_id", "turn", "score", "label", F.array_join("flags", ",").alias("flags"))


def recycled_seeds(s: SparkSession, d: str) -> DataFrame:
    """The questions whose answers didn't pass, with what to do better."""
    rows = _answers(s, d)
    g = ga.grade_answers(rows, ["conv_id", "turn"], _RULES)
    name = F.concat_ws("-", "conv_id", "turn").alias("id")
    issues = F.transform("flags", lambda f: F.concat(F.lit("fix "), f))
    reviews = g.where("label <> 'pass'").select(name, F.col("label").alias("final_label"), F.col("score").alias("final_score"), "flags", issues.alias("issues"))
    told = s.createDataFrame([("reply_error", "answer again"), (None, "rewrite")], "label string, instruction string")
    made = ga.recycled(rows.select(name, "question"), reviews, told, most=3)
    return made.select("id", "recycled_from", "recycle_label", "question", "critique")


QUERIES = {"tool_call_views": tool_call_views, "competitions": competitions, "selector_views": selector_views, "graded_answers": graded, "recycled_seeds": recycled_seeds}

_E = f"""e AS (
      SELECT *, event_id % 2 AS i, CASE WHEN date_diff('day', DATE '{_START}', CAST(ts AS DATE)) % 7 < 3 THEN 1 ELSE 2 END AS a, value >= 20 AS ok
      FROM (SELECT {_RUN}, * FROM events)
    )"""

_G = """c AS (
      SELECT q.conv_id, q.turn, q.text AS question, q.conv_id % 3 = 0 AS rec, a.text AS said, string_split(lower(q.text), ' ') AS w FROM conversations q
      JOIN conversations a ON a.conv_id = q.conv_id AND a.turn = q.turn + 1 AND a.role = 'assistant' WHERE q.role = 'user'
    ), x AS (
      SELECT *, CASE WHEN rec THEN '{"tool_plan":[],"answer":' || CAST(to_json([said]) AS VARCHAR) || ',"quality_checks":"and"}' ELSE '{"answer":' || CAST(to_json(said) AS VARCHAR) || '}' END AS t, w[1:2] AS tools, w[3:5] AS cover FROM c
    ), m AS (
      SELECT *, CASE WHEN rec THEN 0.6 ELSE 0.2 END AS schema, coalesce(len(list_filter(tools, lambda z: contains(t, z))) / nullif(len(tools), 0), 1.0) AS tool,
             coalesce(len(list_filter(cover, lambda z: contains(t, z) OR contains(t, replace(z, '_', ' ')))) / nullif(len(cover), 0), 1.0) AS cov,
             CASE WHEN length(question) <= 150 OR contains(t, 'heat') OR contains(t, 'ound') THEN 1.0 ELSE 0.2 END AS image,
             length(CASE WHEN rec THEN CAST(to_json([said]) AS VARCHAR) ELSE said END) AS n,
             least(1.0, len(list_filter(['and', 'the ', 'tion', 'of', 'ing', 'ness'], lambda z: contains(t, z))) / 6) AS complex FROM x
    ), s AS (SELECT *, CASE WHEN n BETWEEN 250 AND 2500 THEN 1.0 WHEN n >= 120 THEN 0.55 ELSE 0.25 END AS len FROM m
    ), r AS (
      SELECT *, 0.22 * CAST(schema AS DOUBLE) + 0.22 * CAST(tool AS DOUBLE) + 0.18 * CAST(cov AS DOUBLE) + 0.14 * CAST(image AS DOUBLE) + 0.12 * CAST(len AS DOUBLE) + 0.12 * CAST(complex AS DOUBLE) AS raw,
             list_filter(['schema_incomplete', CASE WHEN tool < 0.6 THEN 'missing_expected_tools' END, CASE WHEN cov < 0.45 THEN 'missing_required_aspects' END, CASE WHEN image < 1 THEN 'image_evidence_missing' END,
                          CASE WHEN len < 0.6 THEN 'too_short_or_too_long' END, CASE WHEN complex < 0.5 THEN 'possibly_too_simple' END], lambda f: f IS NOT NULL) AS flags FROM s
    ), g AS (
      SELECT *, round(raw, 4) AS score, CASE WHEN raw < 0.58 THEN 'reply_error' WHEN complex < 0.5 OR cov < 0.65 THEN 'question_too_simple_or_answer_shallow' ELSE 'pass' END AS label FROM r
    )"""

ORACLE_SQL = {
    "tool_call_views": f"""WITH {_E}
        SELECT run AS id, i AS index, a AS attempt, event_id, ok,
               CASE event_type WHEN 'purchase' THEN '{{"candidates": [{{"name": "m' || event_id % 5 || '"}}, {{"size": 1}}]}}' WHEN 'error' THEN '{{"error": "bad"}}' WHEN 'view' THEN '{{"text": ["seen"]}}' ELSE props END AS result,
               CASE WHEN value > 10 THEN 'try ' || event_type END AS decision, CASE WHEN ok THEN '' WHEN value < 5 THEN 'Timeout:Tool call failed' ELSE 'tool_error:Tool call failed' END AS error,
               CASE WHEN event_type = 'purchase' THEN 'p' || json_extract_string(props, '$.k') || '.png' ELSE '' END AS images, CASE WHEN ok AND event_type = 'purchase' THEN 'm' || event_id % 5 ELSE '' END AS found FROM e""",
    "competitions": f"""WITH {_E}, t AS (
          SELECT run, i, a, count(*) AS n, count(*) FILTER (ok) AS good, max(value) >= 40 AS fine, string_agg(DISTINCT event_type, ',' ORDER BY event_type) FILTER (ok) AS tools FROM e GROUP BY run, i, a
        ), l AS (
          SELECT *, count(*) OVER (PARTITION BY run, i) - 1 AS failed, fine AND good > 0 AS passed, round(good / n, 4) AS score FROM t QUALIFY a = max(a) OVER (PARTITION BY run, i)
        ), b AS (
          SELECT run, count(*) FILTER (passed) AS p, string_agg(i || ':model' || i || ':' || CAST(fine AS VARCHAR) || ':' || CASE WHEN fine THEN n ELSE 0 END || ':' || failed || ':' || a || ':' || CAST(passed AS VARCHAR) || CASE WHEN fine THEN '' ELSE ':generation_error' END, ';' ORDER BY i) AS audit FROM l GROUP BY run
        ), w AS (SELECT * FROM l WHERE passed QUALIFY row_number() OVER (PARTITION BY run ORDER BY score DESC, n - good, n, i) = 1)
        SELECT b.run AS id, CASE WHEN p = 0 THEN 'error' ELSE 'ok' END AS status, CASE p WHEN 0 THEN 'all_failed' WHEN 1 THEN 'only_passed' ELSE 'best_score' END AS rule, w.i AS winner, 'model' || w.i AS model,
               CASE WHEN w.n > 3 THEN 'recorded' ELSE 'answer ' || w.n END AS final_answer, w.tools, w.n * 10 AS total_tokens, audit FROM b LEFT JOIN w ON w.run = b.run""",
    "selector_views": f"""WITH {_E}, p AS (
          SELECT DISTINCT run, '/q/' || user_id || '.png' AS path, 0 AS src, -1 AS i, 0 AS a, 0 AS event_id, NULL AS tool FROM e
          UNION ALL SELECT run, '/r/p' || json_extract_string(props, '$.k') || '.png', 1, i, a, event_id, event_type FROM e WHERE event_type = 'purchase'
            AND json_extract_string(props, '$.k') IN (SELECT json_extract_string(props, '$.k') FROM events WHERE event_type = 'purchase' AND value >= 10)
        ), o AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY run, path ORDER BY src, i, a, event_id) = 1)
        SELECT run AS id, CAST(row_number() OVER (PARTITION BY run ORDER BY src, i, a, event_id) - 1 AS INTEGER) AS image_index, CASE src WHEN 1 THEN 'tool_result' ELSE 'initial_question' END AS source,
               CASE src WHEN 1 THEN i END AS index, tool, string_split(path, '/')[-1] AS filename FROM o""",
    "graded_answers": f"WITH {_G} SELECT conv_id, turn, score, label, array_to_string(flags, ',') AS flags FROM g",
    "recycled_seeds": f"""WITH {_G}
        SELECT conv_id || '-' || turn || '_recycle_v2' AS id, conv_id || '-' || turn AS recycled_from, label AS recycle_label, question || chr(10) || chr(10) || CASE label WHEN 'reply_error' THEN 'answer again' ELSE 'rewrite' END AS question,
               'label: ' || label || chr(10) || 'flags: ' || array_to_string(flags, ', ') || CASE WHEN len(flags) > 0 THEN chr(10) || 'issues: ' || array_to_string(list_transform(flags[1:3], lambda f: 'fix ' || f), '; ') ELSE '' END AS critique
        FROM g WHERE label <> 'pass'""",
}
