"""Registered queries over tool calls, JSON values, relations between series and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import arrays as ar
from tidemark.functions import json_values as jv
from tidemark.functions.stats import r6
from tidemark.operators import diagnostics as dg
from tidemark.operators import generators as gn
from tidemark.operators import relations as rl
from tidemark.operators import review as rv
from tidemark.operators import trajectories as tr
from tidemark.plans.panel_queries import _CORR, _FILLED, _RES, _filled, _grid, _r, _residuals, _t

SCHEMA = {"type": "object", "required": ["k"], "properties": {"k": {"type": "integer", "minimum": 0, "maximum": 50}}, "additionalProperties": False}


def _calls(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "events").select("user_id", F.col("event_id").alias("ord"), F.col("event_type").alias("name"), F.col("props").alias("arguments"), (F.col("value") >= 20).alias("ok"))


def trajectory_review(s: SparkSession, d: str) -> DataFrame:
    """Trajectories made of users' events: two opening messages, a call and an answer for each event, a closing message."""
    calls = _calls(s, d).withColumn("call_id", F.col("ord").cast("string"))
    pairs = calls.select(
        "user_id", F.explode(F.array(
            F.struct((F.col("ord") * 2).alias("pos"), F.lit("assistant").alias("role"), F.col("call_id"), F.lit("").alias("text")),
            F.struct((F.col("ord") * 2 + 1).alias("pos"), F.lit("tool").alias("role"), F.when(F.col("ord") % 50 != 7, F.col("call_id")).alias("call_id"), F.lit("result").alias("text")),
        )).alias("m"),
    ).select("user_id", "m.*")
    users = calls.select("user_id").distinct()
    ends = users.select("user_id", F.explode(F.array(
        F.struct(F.lit(-2).cast("long").alias("pos"), F.lit("system").alias("role"), F.lit(None).cast("string").alias("call_id"), F.lit("s").alias("text")),
        F.struct(F.lit(-1).cast("long").alias("pos"), F.lit("user").alias("role"), F.lit(None).cast("string").alias("call_id"), F.lit("u").alias("text")),
        F.struct(F.lit(1 << 60).cast("long").alias("pos"), F.lit("assistant").alias("role"), F.lit(None).cast("string").alias("call_id"), F.lit("a final answer of some length").alias("text")),
    )).alias("m")).select("user_id", "m.*")
    return tr.review(pairs.unionByName(ends), calls, "user_id", budget=60)


def schema_breaches(s: SparkSession, d: str) -> DataFrame:
    errors = jv.check_schema(F.col("props"), SCHEMA)
    return _t(s, d, "events").select("event_id", F.array_join(errors, ";").alias("errors"))


def json_shapes(s: SparkSession, d: str) -> DataFrame:
    nested = F.concat(F.lit('```json\n{"user": '), F.col("user_id"), F.lit(', "props": '), F.col("props"), F.lit(', "path": "/data/x/'), F.col("event_type"), F.lit('.csv", "tags": ["a", "b"]}\n```'))
    parsed = jv.parse_object(nested)
    return _t(s, d, "events").select("event_id", F.array_join(jv.paths(parsed), ",").alias("paths"), F.get_json_object(jv.clean_result(parsed), "$.uri").alias("uri"))


def set_operations(s: SparkSession, d: str) -> DataFrame:
    labelled = _t(s, d, "labels").select("doc_id")
    long = _t(s, d, "documents").where("n_chars > 1500").select("doc_id")
    part = lambda df, name: df.agg(F.count("*").alias("n"), F.min("doc_id").alias("least"), F.max("doc_id").alias("greatest")).select(F.lit(name).alias("operation"), "n", "least", "greatest")
    return part(labelled.union(long).distinct(), "union").union(part(labelled.intersect(long), "intersection")).union(part(labelled.subtract(long), "difference"))


def peer_texts(s: SparkSession, d: str) -> DataFrame:
    """The first document of each source, and how many documents of other sources open with its first word."""
    docs = _t(s, d, "documents").select("doc_id", "source", F.lower(F.regexp_extract("text", "^([A-Za-z]+)", 1)).alias("word"))
    first = docs.groupBy("source").agg(F.min_by("word", "doc_id").alias("word"), F.min("doc_id").alias("doc_id"))
    words = docs.groupBy("word", "source").agg(F.count("*").alias("n"))
    all_words, own = words.groupBy("word").agg(F.sum("n").alias("all")), words.withColumnRenamed("n", "own")
    return first.join(all_words, "word").join(own, ["word", "source"]).select("source", "doc_id", "word", (F.col("all") - F.col("own")).alias("peers"))


def intermittency(s: SparkSession, d: str) -> DataFrame:
    points = _t(s, d, "events").select(F.col("user_id").cast("string").alias("series_id"), "event_id", (F.col("value") < 30).alias("small"))
    return dg.intermittency(points.withColumnRenamed("event_id", "t"))


def answer_review(s: SparkSession, d: str) -> DataFrame:
    return rv.review_answers(_t(s, d, "documents"), "doc_id", F.col("text"), F.array(F.lit("the"), F.lit("der"), F.lit("la"), F.lit("que")))


def judged_choice(s: SparkSession, d: str) -> DataFrame:
    marks = {f"mark{k}": (F.col("l_orderkey") * k % 7).cast("int") for k in range(1, 6)}
    rows = _t(s, d, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").alias("index"), F.when(F.col("l_linenumber") % 3 == 0, F.col("l_quantity")).alias("total"), *[F.when(F.col("l_orderkey") % 5 != 0, v).alias(k) for k, v in marks.items()],
        (F.col("l_linenumber") % 2).alias("failures"), F.col("l_quantity").cast("int").alias("calls"), F.col("l_linenumber").alias("tokens"),
    )
    return rv.judged_choice(rows, "l_orderkey")


def array_series_stats(s: SparkSession, d: str) -> DataFrame:
    e = F.transform("embedding", lambda x: x.cast("double"))
    st = ar.finite_stats(ar.differences(e))
    return _t(s, d, "embeddings").select("vec_id", F.round(st["mean"], 5).alias("mean_step"), F.round(st["greatest"], 5).alias("max_step"), st["n"].alias("n"), ar.longest(F.array(e, F.slice(e, 1, 3))).alias("longest"))


QUERIES = {
    "answer_review": answer_review,
    "judged_choice": judged_choice,
    "array_series_stats": array_series_stats,
    "circular_lag": lambda s, d: dg.circular_lag(_filled(s, d), 5),
    "training_dynamics": lambda s, d: dg.training_review(gn.training_curves(s, 24)),
    "intermittent_demand": lambda s, d: gn.intermittent_demand(s, 10),
    "drift_ramp": lambda s, d: gn.drift_ramp(_filled(s, d)).withColumn("value", F.round("value", 6)),
    "call_metrics": lambda s, d: tr.call_metrics(_calls(s, d), "user_id"),
    "trajectory_review": trajectory_review,
    "schema_breaches": schema_breaches,
    "json_shapes": json_shapes,
    "set_operations": set_operations,
    "peer_texts": peer_texts,
    "relation_gate": lambda s, d: rl.relation_gate(rl.correlations(_grid(s, d)), least_r=0.02),
    "series_separation": lambda s, d: rl.series_separation(rl.correlations(_grid(s, d)), "click"),
    "segment_correlation": lambda s, d: rl.segment_correlation(_filled(s, d), "click"),
    "model_tradeoff": lambda s, d: dg.model_tradeoff(_filled(s, d)),
    "residual_spread": lambda s, d: dg.residual_spread(_residuals(s, d)),
    "intermittency": intermittency,
    "token_totals": lambda s, d: _t(s, d, "conversations").groupBy("conv_id").agg(F.sum(F.size(F.split(F.trim("text"), "[ \t\n]+"))).alias("words"), F.max("turn").alias("last_turn"), F.count_if(F.col("role") == "assistant").alias("answers")),
    "monthly_orders": lambda s, d: _t(s, d, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderstatus").agg(F.count("*").alias("n"), F.round(F.avg("o_totalprice"), 4).alias("mean_price")),
    "label_rates": lambda s, d: _t(s, d, "labels").join(_t(s, d, "documents"), "doc_id").groupBy("lang").agg(F.count("*").alias("n"), r6(F.avg("quality")).alias("quality_rate"), r6(F.avg("toxic")).alias("toxic_rate")),
}

_HIT = " + ".join(f"contains(lower(text), '{w}')::INT" for w in ("the", "der", "la", "que"))
_SCORE = rf"round(0.25 * (trim(text) <> '')::INT + 0.25 * ({_HIT}) / 4 + 0.2 * regexp_matches(text, '[0-9]')::INT + 0.15 * (len(string_split(text, chr(10))) >= 3)::INT + 0.15 * (length(text) BETWEEN 200 AND 6000)::INT, 4)"

ORACLE_SQL = {
    "answer_review": f"SELECT doc_id, {_SCORE} AS score, {_SCORE} >= 0.75 AS passed FROM documents",
    "judged_choice": """WITH s AS (SELECT l_orderkey, l_linenumber AS i, coalesce(CASE WHEN l_linenumber % 3 = 0 THEN l_quantity END, CASE WHEN l_orderkey % 5 <> 0 THEN l_orderkey % 7 + l_orderkey * 2 % 7 + l_orderkey * 3 % 7 + l_orderkey * 4 % 7 + l_orderkey * 5 % 7 END) AS t,
          l_linenumber % 2 AS f, CAST(l_quantity AS INTEGER) AS c FROM lineitem)
        SELECT l_orderkey, CASE WHEN count(*) = count(t) THEN (list(i ORDER BY t DESC, f, c, i))[1] ELSE (list(i ORDER BY f, c, i))[1] END AS winner, CASE WHEN count(*) = count(t) THEN 'judge' ELSE 'tie_break' END AS reason FROM s GROUP BY l_orderkey""",
    "array_series_stats": """WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings), d AS (SELECT vec_id, len(e) AS n, list_transform(range(2, len(e) + 1), lambda i: e[i] - e[i - 1]) AS d FROM e)
        SELECT vec_id, round(list_sum(d) / len(d), 5) AS mean_step, round(list_max(d), 5) AS max_step, CAST(len(d) AS INTEGER) AS n, CAST(n AS INTEGER) AS longest FROM d""",
    "circular_lag": f"""WITH {_FILLED}, n AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY t) - 1 AS i, count(*) OVER (PARTITION BY series_id) AS n FROM filled)
        SELECT a.series_id, a.t, round(b.value, 6) AS lagged FROM n AS a JOIN n AS b ON a.series_id = b.series_id AND a.i = (b.i + 5) % b.n""",
    "training_dynamics": """WITH r AS (SELECT CAST(run AS INTEGER) AS run, CAST(step AS INTEGER) AS step, step / 60 AS x, (['good', 'overfit', 'underfit', 'oscillating'])[run % 4 + 1] AS kind FROM range(0, 24) AS a(run), range(1, 61) AS b(step)),
        c AS (SELECT *, CASE kind WHEN 'underfit' THEN 0.9 - 0.2 * x ELSE 0.1 + exp(-4 * x) END AS train, CASE kind WHEN 'overfit' THEN greatest(0, x - (0.48 + 0.02 * (run % 11))) * 0.8 WHEN 'oscillating' THEN 0.08 * sin(12 * x * pi()) ELSE 0.02 END AS extra FROM r),
        v AS (SELECT run, step, train, train + extra AS v, train + extra - lag(train + extra) OVER w AS d FROM c WINDOW w AS (PARTITION BY run ORDER BY step)),
        t AS (SELECT *, sign(d) <> sign(lag(d) OVER (PARTITION BY run ORDER BY step)) AS turn FROM v)
        SELECT run, (list(step ORDER BY round(v, 6), step))[1] AS best_step, round(max_by(v - train, step), 6) AS final_gap, count(*) FILTER (turn) AS turns, max(step) AS last_step FROM t GROUP BY run""",
    "intermittent_demand": f"""WITH r AS (SELECT 'd' || s AS series_id, CAST(t AS INTEGER) AS t FROM range(0, 10) AS a(s), range(0, 120) AS b(t)), u AS (SELECT *, CAST('0x' || substr(sha256('"demand:' || series_id || ':' || t || '"'), 1, 12) AS BIGINT) / power(16, 12) AS u FROM r)
        SELECT series_id, t, CASE WHEN u < 0.3 THEN round(1 + 20 * u / 0.3, 6) ELSE 0 END AS value FROM u""",
    "drift_ramp": f"""WITH {_FILLED}, n AS (SELECT *, (row_number() OVER (PARTITION BY series_id ORDER BY t) - 1) / (count(*) OVER (PARTITION BY series_id) - 1) AS x FROM filled)
        SELECT series_id, t, round(value + 8 * greatest(0, (x - 0.6) / (1 - 0.6)), 6) AS value FROM n""",
    "call_metrics": """WITH s AS (SELECT user_id, event_type AS name, value >= 20 AS ok, row_number() OVER (PARTITION BY user_id, event_type, props, value >= 20 ORDER BY event_id) AS nth FROM events)
        SELECT user_id, count(*) AS calls, count(*) FILTER (ok) AS succeeded, count(*) FILTER (NOT ok) AS failed, coalesce(string_agg(DISTINCT name, ',' ORDER BY name) FILTER (ok), '') AS tools,
        count(*) FILTER (ok AND nth > 1) AS repeats, count(*) FILTER (NOT ok AND nth = 2) AS stops FROM s GROUP BY user_id""",
    "trajectory_review": """WITH s AS (SELECT user_id, event_id, value >= 20 AS ok, row_number() OVER (PARTITION BY user_id, event_type, props, value >= 20 ORDER BY event_id) AS nth FROM events),
        c AS (SELECT user_id, count(*) AS n, count(*) FILTER (ok) AS good, count(*) FILTER (ok AND nth > 1) AS repeats, count(*) FILTER (NOT ok AND nth = 2) AS stops, count(*) FILTER (event_id % 50 = 7) AS lost FROM s GROUP BY user_id)
        SELECT user_id, array_to_string(list_filter([CASE WHEN lost > 0 THEN 'grammar' END, CASE WHEN n > 60 THEN 'over_budget' END, CASE WHEN good = 0 THEN 'no_evidence' END, CASE WHEN repeats > 0 THEN 'repeated_call' END, CASE WHEN stops > 0 THEN 'repeated_failure' END], lambda x: x IS NOT NULL), ',') AS flags,
        round(0.3 * (lost = 0 AND n <= 60)::INT + 0.3 * (good > 0)::INT + 0.2 * (repeats = 0 AND stops = 0)::INT + 0.2, 4)::DOUBLE AS score, lost = 0 AND round(0.3 * (lost = 0 AND n <= 60)::INT + 0.3 * (good > 0)::INT + 0.2 * (repeats = 0 AND stops = 0)::INT + 0.2, 4) >= 0.8 AS passed FROM c""",
    "schema_breaches": "SELECT event_id, CASE WHEN CAST(json_extract(props, '$.k') AS BIGINT) > 50 THEN '$.k: above maximum' ELSE '' END AS errors FROM events",
    "json_shapes": "SELECT event_id, 'path,props,props.k,tags,tags[].a,tags[].b,user' AS paths, event_type || '.csv' AS uri FROM events",
    "set_operations": """WITH a AS (SELECT doc_id FROM labels), b AS (SELECT doc_id FROM documents WHERE n_chars > 1500) SELECT 'union' AS operation, count(*) AS n, min(doc_id) AS least, max(doc_id) AS greatest FROM (SELECT * FROM a UNION SELECT * FROM b) AS x
        UNION ALL SELECT 'intersection', count(*), min(doc_id), max(doc_id) FROM (SELECT * FROM a INTERSECT SELECT * FROM b) AS x UNION ALL SELECT 'difference', count(*), min(doc_id), max(doc_id) FROM (SELECT * FROM a EXCEPT SELECT * FROM b) AS x""",
    "peer_texts": """WITH d AS (SELECT doc_id, source, lower(regexp_extract(text, '^([A-Za-z]+)', 1)) AS word FROM documents), f AS (SELECT source, doc_id, word FROM d QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) = 1)
        SELECT f.source, f.doc_id, f.word, (SELECT count(*) FROM d WHERE d.word = f.word AND d.source <> f.source) AS peers FROM f""",
    "relation_gate": f"""WITH {_CORR} SELECT a, b, array_to_string(list_filter([CASE WHEN overlap < 48 THEN 'few_points' END, CASE WHEN raw_r IS NULL THEN 'undefined' END, CASE WHEN abs(raw_r) < 0.02 THEN 'weak' END,
        CASE WHEN abs(raw_r) >= 0.02 AND abs(detrended_r) < 0.01 THEN 'only_trend' END, CASE WHEN sign(raw_r) * sign(diff_r) < 0 THEN 'opposite_steps' END], lambda x: x IS NOT NULL), ',') AS reasons FROM corr""",
    "series_separation": f"WITH {_CORR} SELECT round(avg(raw_r) FILTER (a <> 'click' AND b <> 'click'), 6) AS among, round(avg(raw_r) FILTER (a = 'click' OR b = 'click'), 6) AS between, count(*) FILTER (a = 'click' OR b = 'click') AS n_between FROM corr",
    "segment_correlation": f"""WITH {_FILLED}, p AS (SELECT f.series_id, CAST(floor(f.t / 24) AS INTEGER) AS segment, f.value AS v, g.value AS w FROM filled AS f JOIN filled AS g ON g.t = f.t AND g.series_id = 'click' WHERE f.series_id <> 'click')
        SELECT series_id, segment, round({_r('v', 'w')}, 6) AS r FROM p GROUP BY series_id, segment""",
    "model_tradeoff": f"""WITH {_FILLED}, l AS (SELECT *, lag(value, 1) OVER w AS a, lag(value, 24) OVER w AS b FROM filled WINDOW w AS (PARTITION BY series_id ORDER BY t)),
        e AS (SELECT series_id, floor(t / 72) AS w, avg(abs(value - a)) AS ea, avg(abs(value - b)) AS eb FROM l WHERE b IS NOT NULL GROUP BY ALL)
        SELECT series_id, count(*) AS windows, round(avg(ea), 6) AS mae_last, round(avg(eb), 6) AS mae_day, round(var_pop(ea), 6) AS var_last, round(var_pop(eb), 6) AS var_day, count(*) FILTER (ea < eb) AS last_wins FROM e GROUP BY series_id""",
    "residual_spread": f"""WITH {_RES}, c AS (SELECT quantile_cont(predicted, [0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875]) AS cuts FROM res)
        SELECT CAST(len(list_filter(cuts, lambda x: x < predicted)) AS INTEGER) AS bin, count(*) AS n, round(avg(e), 4) AS bias, round(stddev_pop(e), 4) AS spread FROM res, c GROUP BY 1""",
    "intermittency": """WITH p AS (SELECT CAST(user_id AS VARCHAR) AS series_id, event_id AS t, value < 30 AS small FROM events), g AS (SELECT series_id, t - lag(t) OVER (PARTITION BY series_id ORDER BY t) AS gap FROM p WHERE NOT small)
        SELECT p.series_id, n, small_share, mean_gap, max_gap FROM (SELECT series_id, count(*) AS n, round(avg(CAST(small AS INTEGER)), 6) AS small_share FROM p GROUP BY series_id) AS p LEFT JOIN (SELECT series_id, round(avg(gap), 6) AS mean_gap, max(gap) AS max_gap FROM g GROUP BY series_id) AS g USING (series_id)""",
    "token_totals": r"SELECT conv_id, CAST(sum(len(regexp_split_to_array(trim(text), '[ \t\n]+'))) AS BIGINT) AS words, max(turn) AS last_turn, count(*) FILTER (role = 'assistant') AS answers FROM conversations GROUP BY conv_id",
    "monthly_orders": "SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus, count(*) AS n, round(avg(o_totalprice), 4) AS mean_price FROM orders GROUP BY ALL",
    "label_rates": "SELECT lang, count(*) AS n, round(avg(quality), 6) AS quality_rate, round(avg(toxic), 6) AS toxic_rate FROM labels JOIN documents USING (doc_id) GROUP BY lang",
}
