"""Registered queries over texts, plans, reviews and exports, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text as tx
from tidemark.functions.hashing import stable_hash
from tidemark.operators import planning as pl
from tidemark.operators import review as rv

LEVELS = [("complex", 0.2), ("medium", 0.6), ("simple", 0.2)]
MIX = [("text", 0.25), ("image", 0.5), ("paired", 0.25)]
TOOLS = ["data_scan", "data_profile", "channel_stats", "summary_stats", "compute_acf", "adf_test", "find_peaks", "outlier_clipper", "cpt_detector", "ts_imputation", "dtw_distance", "feature_generate"]
# model, package, tasks
MODELS = [("The", "base", ["forecast"]), ("Rene", "base", ["forecast", "foundation_inference"]), ("Onst", "extra", ["anomaly_detection"]), ("Lich", "extra", ["forecast", "anomaly_detection"]), ("Tion", "base", ["imputation"])]
TEMPLATES = [("reuse", "qa", "summary_stats"), ("rewrite", "rewrite_qa", "data_quality_check"), ("truncate", "windowed_qa", "channel_values"), ("discard", "none", "none")]


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _users(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "conversations").where("role = 'user'").withColumn("ord", F.col("conv_id") * 1000 + F.col("turn"))


def _labelled(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "documents").select("doc_id", "lang", "source").join(_t(s, d, "labels"), "doc_id", "left")


def _candidates(s: SparkSession, d: str) -> DataFrame:
    docs, labels = _t(s, d, "documents"), _t(s, d, "labels")
    return docs.join(labels, "doc_id").select(
        F.col("source"), F.col("doc_id").alias("index"), (F.col("quality") == 1).alias("passed"), (F.col("n_chars") % 97).alias("score"), (F.col("toxic")).alias("failures"), (F.col("n_chars") % 8).alias("calls")
    )


def flags_and_routes(s: SparkSession, d: str) -> DataFrame:
    flags = tx.quality_flags(F.col("text"))
    routed = _t(s, d, "documents").select("doc_id", flags.alias("f")).select("doc_id", F.array_join("f", ",").alias("flags"), tx.reuse_route(F.col("f")).alias("route"))
    templates = s.createDataFrame(TEMPLATES, "route string, task_type string, tool string")
    return routed.join(F.broadcast(templates), "route")


def capabilities(s: SparkSession, d: str) -> DataFrame:
    key = F.col("event_type")
    return _t(s, d, "events").groupBy("event_type").count().select("event_type", tx.task_key(key).alias("task"), tx.capability(F.concat(F.lit("Forecast? "), key)).alias("capability"), "count")


def mentions(s: SparkSession, d: str) -> DataFrame:
    models = s.createDataFrame([(m, p) for m, p, _ in MODELS], "name string, package string")
    turns = _t(s, d, "conversations").select("conv_id", "turn", "text")
    # five names meet each turn: the list is a constant
    return turns.join(F.broadcast(models), tx.mentions(F.col("text"), F.col("name"))).groupBy("name", "package").agg(F.count("*").alias("n"), F.count_distinct("conv_id").alias("conversations"))


def search(s: SparkSession, d: str) -> DataFrame:
    models = s.createDataFrame([(k, *m) for k, m in enumerate(MODELS)], "ord int, name string, package string, tasks array<string>")
    return rv.catalogue_search(models, task="forecasting", package="base").select("ord", "name", "package")


def pools(s: SparkSession, d: str) -> DataFrame:
    needs = _t(s, d, "benchmark").select(F.col("item_id").cast("string").alias("question"), F.array(F.lit("data_profile"), F.lit("data_scan")).alias("preferred"))
    return pl.tool_pool(needs, s.createDataFrame([(t,) for t in TOOLS], "name string"), 6, "pool")


def schedule(s: SparkSession, d: str) -> DataFrame:
    weights = _t(s, d, "documents").groupBy("lang").agg(F.count("*").cast("double").alias("weight"))
    return pl.interleaved_schedule(pl.quotas(weights, 200, "lang").withColumnRenamed("lang", "task"))


def assignment(s: SparkSession, d: str) -> DataFrame:
    items = _t(s, d, "nation").select(F.concat(F.lit("task"), F.col("n_regionkey") % 3).alias("task"), F.concat(F.lit("s"), F.col("n_nationkey")).alias("scenario"), F.col("n_nationkey").alias("ord"), F.substring("n_name", -1, 1).alias("pattern"))
    specs = _t(s, d, "region").select(F.concat(F.lit("task"), F.col("r_regionkey") % 3).alias("task"), F.col("r_name").alias("spec"), F.col("r_regionkey").alias("ord"), F.lit(None).cast("string").alias("pattern"))
    return pl.assign_in_order(specs, items)


def resume(s: SparkSession, d: str) -> DataFrame:
    return rv.pending(_t(s, d, "documents").select("doc_id", "source"), _t(s, d, "labels"), "doc_id")


def reconcile(s: SparkSession, d: str) -> DataFrame:
    return rv.orphans(_t(s, d, "documents").select("doc_id"), _t(s, d, "labels").select((F.col("doc_id") * 2).alias("doc_id")), "doc_id")


def last_records(s: SparkSession, d: str) -> DataFrame:
    return rv.last_record_wins(_t(s, d, "events").select("user_id", "event_id", "event_type", "value"), "user_id", ["event_id"])


def text_checks(s: SparkSession, d: str) -> DataFrame:
    return tx.check_texts(_users(s, d), ["conv_id", "turn"], "text")


def judged(s: SparkSession, d: str) -> DataFrame:
    rows = _labelled(s, d).where("quality IS NOT NULL")
    return rv.judge_aggregate(rows, "source", F.col("quality").cast("double"), 1 - F.col("toxic").cast("double"))


QUERIES = {
    "coverage_axes": lambda s, d: rv.axis_counts(_labelled(s, d), ["lang", "source", "quality", "toxic"]),
    "coverage_crosstab": lambda s, d: rv.crosstabs(_labelled(s, d), [["lang", "quality"], ["lang", "toxic"], ["source", "quality", "toxic"]]),
    "coverage_missing": lambda s, d: rv.missing_values(_labelled(s, d), {"lang": ["de", "en", "es", "fr", "it", "pt"], "source": ["src0", "src1", "web"]}),
    "exact_duplicates": lambda s, d: rv.exact_duplicates(_t(s, d, "documents"), tx.normalized(F.col("text")), ["lang"]),
    "opening_prefix_overuse": lambda s, d: rv.prefix_uses(_users(s, d), "ord", tx.opening_prefix(F.col("text"), 4)),
    "opening_family": lambda s, d: _users(s, d).groupBy(tx.opening_family(F.col("text")).alias("family")).agg(F.count("*").alias("n")),
    "text_checks": text_checks,
    "text_compact": lambda s, d: _t(s, d, "documents").select("doc_id", F.length(tx.compact(F.col("text"), 400)).cast("long").alias("n"), F.sha2(tx.compact(F.col("text"), 400).cast("binary"), 256).alias("sha")),
    "quality_flags": flags_and_routes,
    "capability_route": capabilities,
    "stratified_sample": lambda s, d: pl.stratified_sample(_t(s, d, "documents").select("doc_id", "source", "lang"), ["source", "lang"], "doc_id", 5, "sample"),
    "complexity_schedule": lambda s, d: pl.spread_levels(_t(s, d, "documents"), "doc_id", LEVELS, "20260712"),
    "modality_plan": lambda s, d: pl.modality(_t(s, d, "documents"), "doc_id", "source", MIX, "modality"),
    "expression_profile": lambda s, d: pl.expression_profile(_t(s, d, "documents"), "doc_id"),
    "tool_pool": pools,
    "interleaved_schedule": schedule,
    "task_assignment": assignment,
    "conversation_review": lambda s, d: rv.review_conversations(_t(s, d, "conversations")),
    "budget_states": lambda s, d: rv.budget_states(_t(s, d, "conversations")),
    "candidate_selection": lambda s, d: rv.choose_candidate(_candidates(s, d), "source"),
    "judge_aggregate": judged,
    "chat_export": lambda s, d: rv.chat_export(_t(s, d, "conversations")),
    "export_summary": lambda s, d: _t(s, d, "conversations").groupBy("role").agg(F.count("*").alias("n"), F.count_distinct("conv_id").alias("conversations"), F.sum(F.length("text")).alias("chars")),
    "split_by_group": lambda s, d: pl.split_by_group(_t(s, d, "conversations").select("conv_id", "turn"), "conv_id"),
    "resume_pending": resume,
    "orphan_reconcile": reconcile,
    "last_record_wins": last_records,
    "catalog_search": search,
    "catalog_mentions": mentions,
    "array_series": lambda s, d: rv.array_profile(_t(s, d, "embeddings"), "vec_id", "embedding"),
    "record_hash": lambda s, d: _t(s, d, "documents").select("doc_id", stable_hash(F.col("source"), F.col("lang"), F.col("doc_id")).alias("h")),
}

_LAB = "lab AS (SELECT d.doc_id, lang, source, quality, toxic FROM documents AS d LEFT JOIN labels AS l ON l.doc_id = d.doc_id)"
_NORM = "lower(regexp_replace(text, '[^0-9A-Za-z一-鿿]', '', 'g'))"


def _h(*parts: str) -> str:
    joined = " || ':' || ".join(parts)
    return f"sha256('\"' || {joined} || '\"')"


def _hex(digest: str, n: int) -> str:
    return f"CAST('0x' || substr({digest}, 1, {n}) AS BIGINT)"


def _family() -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches(lower(text), '{p}') THEN '{n}'" for n, p in tx.OPENINGS) + " ELSE 'other' END"


_QUOTA = """exact AS (SELECT level, w * total AS x, floor(w * total) AS base FROM weights, total),
quota AS (SELECT level, base + CAST(row_number() OVER (ORDER BY round(x - base, 9) DESC, level) <= (SELECT any_value(total) FROM total) - sum(base) OVER () AS INTEGER) AS q FROM exact)"""
_CLAUSES = r"len(list_filter(regexp_split_to_array(text, '[,.;?!\n，。；？！]'), lambda c: trim(c) <> ''))"
_NUMS = r"regexp_extract_all(text, '(?:^|[^A-Za-z_0-9.])(\d+(?:\.\d+)?%?)', 1)"
_WS = r"trim(regexp_replace(text, '[ \t\r\n\f]+', ' ', 'g'))"
_COMPACT = f"CASE WHEN length({_WS}) > 400 THEN substr({_WS}, 1, 320) || ' ...[truncated]' ELSE {_WS} END"

ORACLE_SQL = {
    "coverage_axes": f"WITH {_LAB} " + " UNION ALL ".join(f"SELECT '{a}' AS axis, coalesce(CAST({a} AS VARCHAR), 'missing') AS value, count(*) AS n FROM lab GROUP BY 2" for a in ("lang", "source", "quality", "toxic")),
    "coverage_crosstab": f"WITH {_LAB} SELECT lang, quality, toxic, source, count(*) AS n FROM lab GROUP BY GROUPING SETS ((lang, quality), (lang, toxic), (source, quality, toxic))",
    "coverage_missing": """WITH e AS (SELECT 'lang' AS axis, unnest(['de', 'en', 'es', 'fr', 'it', 'pt']) AS v UNION ALL SELECT 'source', unnest(['src0', 'src1', 'web'])),
        seen AS (SELECT DISTINCT 'lang' AS axis, lang AS v FROM documents UNION SELECT DISTINCT 'source', source FROM documents)
        SELECT a.axis, coalesce(m, '') AS missing FROM (SELECT DISTINCT axis FROM e) AS a LEFT JOIN (SELECT axis, string_agg(v, ',' ORDER BY v) AS m FROM (SELECT * FROM e EXCEPT SELECT * FROM seen) AS x GROUP BY axis) AS y USING (axis)""",
    "exact_duplicates": f"WITH n AS (SELECT lang, {_NORM} AS k FROM documents) SELECT lang, count(*) AS n, count(DISTINCT k) AS n_distinct, count(*) - count(DISTINCT k) AS duplicates FROM n GROUP BY lang",
    "opening_prefix_overuse": f"""WITH u AS (SELECT conv_id * 1000 + turn AS ord, substr({_NORM}, 1, 4) AS prefix FROM conversations WHERE role = 'user')
        SELECT ord, prefix, row_number() OVER (PARTITION BY prefix ORDER BY ord) - 1 AS earlier, row_number() OVER (PARTITION BY prefix ORDER BY ord) - 1 < 2 AS ok FROM u""",
    "opening_family": f"SELECT {_family()} AS family, count(*) AS n FROM conversations WHERE role = 'user' GROUP BY 1",
    "text_checks": rf"""WITH c AS (SELECT conv_id, turn, length(text) BETWEEN 60 AND 360 AS ok_length, {_CLAUSES} >= 3 AS ok_clauses, len({_NUMS}) = 0 AS ok_numbers, NOT regexp_matches(text, '[#*$%&|<>]') AS ok_symbols,
          regexp_matches(text, '[.?!]\s*$') AS ok_closing, len(regexp_split_to_array(trim(text), '[ \t\n]+')) >= 8 AS ok_words, CAST({_CLAUSES} AS INTEGER) AS n_clauses FROM conversations WHERE role = 'user')
        SELECT *, round((CAST(ok_length AS INTEGER) + CAST(ok_clauses AS INTEGER) + CAST(ok_numbers AS INTEGER) + CAST(ok_symbols AS INTEGER) + CAST(ok_closing AS INTEGER) + CAST(ok_words AS INTEGER)) / 6, 4) AS complexity_score FROM c""",
    "text_compact": f"SELECT doc_id, CAST(length({_COMPACT}) AS BIGINT) AS n, sha256({_COMPACT}) AS sha FROM documents",
    "quality_flags": r"""WITH f AS (SELECT doc_id, list_filter([CASE WHEN length(text) < 100 THEN 'too_short' END, CASE WHEN length(text) > 10000 THEN 'too_long' END, CASE WHEN regexp_matches(text, '[0-9]') THEN 'has_numbers' END,
          CASE WHEN regexp_matches(text, '(^|\n)\s*\(?[A-D][).]') THEN 'multiple_choice' END, CASE WHEN length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) * 20 > length(text) THEN 'many_symbols' END,
          CASE WHEN replace(text, 'ß', '') = upper(text) THEN 'shouting' END, CASE WHEN len(string_split(text, chr(10))) > 20 THEN 'many_lines' END], lambda x: x IS NOT NULL) AS f FROM documents),
        r AS (SELECT doc_id, array_to_string(f, ',') AS flags, CASE WHEN list_contains(f, 'too_short') THEN 'discard' WHEN list_contains(f, 'many_symbols') OR list_contains(f, 'shouting') THEN 'rewrite' WHEN list_contains(f, 'too_long') THEN 'truncate' ELSE 'reuse' END AS route FROM f)
        SELECT doc_id, flags, route, task_type, tool FROM r JOIN (VALUES ('reuse', 'qa', 'summary_stats'), ('rewrite', 'rewrite_qa', 'data_quality_check'), ('truncate', 'windowed_qa', 'channel_values'), ('discard', 'none', 'none')) AS t(route, task_type, tool) USING (route)""",
    "capability_route": "SELECT event_type, regexp_replace(regexp_replace(lower(event_type), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS task, 'forecasting' AS capability, count(*) AS count FROM events GROUP BY event_type",
    "stratified_sample": f"SELECT doc_id, source, lang FROM documents QUALIFY row_number() OVER (PARTITION BY source, lang ORDER BY {_h(chr(39) + 'sample' + chr(39), 'doc_id')}, doc_id) <= 5",
    "complexity_schedule": f"""WITH total AS (SELECT count(*) AS total FROM documents), weights AS (SELECT * FROM (VALUES ('complex', 0.2::DOUBLE), ('medium', 0.6::DOUBLE), ('simple', 0.2::DOUBLE)) AS w(level, w)), {_QUOTA},
        edges AS (SELECT level, sum(q) OVER (ORDER BY level) - q AS lo, sum(q) OVER (ORDER BY level) AS hi FROM quota),
        r AS (SELECT doc_id, row_number() OVER (ORDER BY {_h("'20260712'", 'doc_id')}, doc_id) - 1 AS rank FROM documents) SELECT doc_id, level, rank FROM r JOIN edges ON rank >= lo AND rank < hi""",
    "modality_plan": f"""WITH u AS (SELECT doc_id, source, {_hex(_h("'modality'", 'doc_id'), 12)} / power(16, 12) AS u, min(doc_id) OVER (PARTITION BY source) AS lo, max(doc_id) OVER (PARTITION BY source) AS hi FROM documents)
        SELECT doc_id, source, CASE WHEN doc_id = lo THEN 'text' WHEN doc_id = hi THEN 'image' WHEN u < 0.25 THEN 'text' WHEN u < 0.75 THEN 'image' ELSE 'paired' END AS modality FROM u""",
    "expression_profile": f"SELECT doc_id, CAST({_hex(_h(chr(39) + 'style' + chr(39), 'doc_id'), 8)} % 8 AS INTEGER) AS style FROM documents",
    "tool_pool": f"""WITH t AS (SELECT unnest({TOOLS!r}) AS tool), q AS (SELECT CAST(item_id AS VARCHAR) AS question FROM benchmark),
        o AS (SELECT question, tool, CASE tool WHEN 'data_profile' THEN 0 WHEN 'data_scan' THEN 1 ELSE 2 END AS first, {_h("'pool'", 'question', 'tool')} AS h FROM q, t)
        SELECT question, CAST(row_number() OVER w - 1 AS INTEGER) AS place, tool FROM o WINDOW w AS (PARTITION BY question ORDER BY first, h, tool) QUALIFY row_number() OVER w <= 6""",
    "interleaved_schedule": f"""WITH total AS (SELECT 200 AS total), weights AS (SELECT lang AS level, count(*) / (SELECT count(*) FROM documents) AS w FROM documents GROUP BY lang), {_QUOTA},
        r AS (SELECT level AS task, CAST(unnest(range(1, CAST(q AS BIGINT) + 1)) AS BIGINT) AS round FROM quota WHERE q > 0) SELECT task, round, row_number() OVER (ORDER BY round, task) AS place FROM r""",
    "task_assignment": """WITH sp AS (SELECT 'task' || (r_regionkey % 3) AS task, r_name AS spec, row_number() OVER w - 1 AS k, count(*) OVER (PARTITION BY r_regionkey % 3) AS n FROM region WINDOW w AS (PARTITION BY r_regionkey % 3 ORDER BY r_regionkey)),
        sc AS (SELECT 'task' || (n_regionkey % 3) AS task, 's' || n_nationkey AS scenario, row_number() OVER (PARTITION BY n_regionkey % 3 ORDER BY n_nationkey) - 1 AS k FROM nation)
        SELECT sc.task, scenario, spec, CAST(CASE WHEN sc.k < n THEN 1 ELSE 2 END AS INTEGER) AS turn FROM sc JOIN sp ON sp.task = sc.task AND sp.k = CASE WHEN sc.k < n THEN sc.k ELSE (sc.k - n) % n END""",
    "conversation_review": """WITH s AS (SELECT *, lag(role) OVER w AS before, row_number() OVER w AS nth, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn) AS said FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
        c AS (SELECT conv_id, count(*) AS n_turns, count(*) FILTER (role NOT IN ('user', 'assistant', 'system')) AS a, count(*) FILTER (role = 'system' AND nth > 1) AS b, count(*) FILTER (role = before) AS c, count(*) FILTER (said > 1) AS d,
          count(*) FILTER (trim(text) = '') AS e, count(*) FILTER (role = 'assistant') AS answers, max_by(role, turn) AS last FROM s GROUP BY conv_id)
        SELECT conv_id, n_turns, answers, array_to_string(list_filter([CASE WHEN a > 0 THEN 'unknown_role' END, CASE WHEN b > 0 THEN 'misplaced_system' END, CASE WHEN c > 0 THEN 'role_order' END, CASE WHEN d > 0 THEN 'repeated_turn' END,
          CASE WHEN e > 0 THEN 'empty_turn' END, CASE WHEN answers = 0 THEN 'no_answer' END, CASE WHEN last <> 'assistant' THEN 'open_end' END], lambda x: x IS NOT NULL), ',') AS flags,
          round(0.3 * (a + b + c = 0)::INT + 0.3 * (answers > 0 AND last = 'assistant')::INT + 0.2 * (d = 0)::INT + 0.2 * (e = 0)::INT, 4)::DOUBLE AS score,
          round(0.3 * (a + b + c = 0)::INT + 0.3 * (answers > 0 AND last = 'assistant')::INT + 0.2 * (d = 0)::INT + 0.2 * (e = 0)::INT, 4) >= 0.8 AND a = 0 AND answers > 0 AS passed FROM c""",
    "budget_states": "SELECT conv_id, turn, CAST(8 - row_number() OVER w AS INTEGER) AS remaining, 8 - row_number() OVER w <= 1 AS warned FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)",
    "candidate_selection": """WITH c AS (SELECT source, doc_id, quality = 1 AS passed, n_chars % 97 AS score, toxic, n_chars % 8 AS calls FROM documents JOIN labels USING (doc_id))
        SELECT source, count(*) AS n, count(*) FILTER (passed) AS n_passed, (list(doc_id ORDER BY score DESC, toxic, calls, doc_id) FILTER (passed))[1] AS winner,
        CASE count(*) FILTER (passed) WHEN 0 THEN 'all_failed' WHEN 1 THEN 'only_passed' ELSE 'best_score' END AS reason FROM c GROUP BY source""",
    "judge_aggregate": f"""WITH {_LAB}, s AS (SELECT source, count(*) AS n, round(0.45 * avg(quality) + 0.55 * avg(1 - toxic), 4) AS final FROM lab WHERE quality IS NOT NULL GROUP BY source)
        SELECT *, CASE WHEN final >= 0.8 THEN 'accept' WHEN final >= 0.6 THEN 'revise' ELSE 'reject' END AS label FROM s""",
    "chat_export": """WITH m AS (SELECT conv_id, count(*) AS n_messages, string_agg(role || ': ' || text, chr(10) ORDER BY turn, role, text) AS chat, max_by(role, turn) AS last FROM conversations WHERE trim(text) <> '' GROUP BY conv_id)
        SELECT conv_id, CAST(n_messages AS INTEGER) AS n_messages, chat FROM m WHERE last = 'assistant'""",
    "export_summary": "SELECT role, count(*) AS n, count(DISTINCT conv_id) AS conversations, CAST(sum(length(text)) AS BIGINT) AS chars FROM conversations GROUP BY role",
    "split_by_group": f"SELECT conv_id, turn, CASE WHEN b < 80 THEN 'train' WHEN b < 90 THEN 'valid' ELSE 'test' END AS split FROM (SELECT conv_id, turn, {_hex(_h(chr(39) + 'split' + chr(39), 'conv_id'), 8)} % 100 AS b FROM conversations) AS x",
    "resume_pending": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "orphan_reconcile": """WITH b AS (SELECT DISTINCT doc_id * 2 AS doc_id FROM labels) SELECT doc_id, 'left' AS side FROM (SELECT DISTINCT doc_id FROM documents) AS a WHERE doc_id NOT IN (SELECT doc_id FROM b)
        UNION ALL SELECT doc_id, 'right' FROM b WHERE doc_id NOT IN (SELECT doc_id FROM documents)""",
    "last_record_wins": "SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1",
    "catalog_search": "SELECT * FROM (VALUES (0, 'The', 'base'), (1, 'Rene', 'base')) AS m(ord, name, package)",
    "catalog_mentions": """SELECT name, package, count(*) AS n, count(DISTINCT conv_id) AS conversations FROM conversations JOIN (VALUES ('The', 'base'), ('Rene', 'base'), ('Onst', 'extra'), ('Lich', 'extra'), ('Tion', 'base')) AS m(name, package)
        ON regexp_matches(lower(text), '(^|[^a-z0-9_])' || lower(name) || '($|[^a-z0-9_])') GROUP BY name, package""",
    "array_series": """SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n, CAST(least(len(embedding), 32) AS INTEGER) AS n_kept, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) / len(embedding), 5) AS mean,
        round(CAST(list_max(embedding) AS DOUBLE), 5) AS max, CAST(list_position(embedding, list_max(embedding)) AS BIGINT) AS argmax FROM embeddings""",
    "record_hash": f"SELECT doc_id, {_h('source', 'lang', 'doc_id')} AS h FROM documents",
}
