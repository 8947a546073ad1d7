"""Queries on open question sets and evidence packets, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.panel_queries import _t
from tidemark.sources import open_data as od

#: The question type of a conversation, by the number of its turn.
_TYPES = ("Forecast", "anomaly check", "", "chat")


def open_records(s: SparkSession, d: str) -> DataFrame:
    """User turns as problems, what follows as their answers, the lengths of the answer's words by line as their series."""
    c = _t(s, d, "conversations")
    said = c.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    lengths = F.transform(F.split("answer", "\n"), lambda line: F.transform(F.split(line, " "), lambda w: F.length(w).cast("double")))
    kind = F.get(F.array(*map(F.lit, _TYPES)), (F.col("turn") % len(_TYPES)).cast("int"))
    lines = c.where("role = 'user'").join(said, ["conv_id", "turn"], "left").select(F.col("conv_id").cast("string").alias("path"), F.col("turn").alias("row_index"), F.col("text").alias("problem"), "answer", F.when(F.col("conv_id") % 2 == 0, F.substring("answer", 1, 9)).alias("extracted_answer"), kind.alias("question_type"), lengths.alias("timeseries"))
    made = od.raw_records(od.reasoned_rows(lines), "conversations")
    return made.select("id", F.col("source_path").alias("conv_id"), F.col("source_row_index").alias("turn"), "normalized_capability", "answer", F.array_join("quality_flags", ",").alias("flags"), "reuse_strategy", "timeseries_summary.num_series", "timeseries_summary.max_length", F.col("metadata.has_cot").alias("has_cot"))


def evidence_packets(s: SparkSession, d: str) -> DataFrame:
    """What may be shown of each user's events."""
    columns = F.array(*map(F.lit, ("event_id", "event_type", "value")))
    contexts = _t(s, d, "events").groupBy("user_id").agg(
        columns.alias("columns"), F.lit("long").alias("data_layout"), F.lit(None).cast("map<string,string>").alias("wide_column_map"), F.count("*").alias("row_count"), F.count_distinct("event_type").alias("series_count"),
        F.round(F.count("*") / F.count_distinct("event_type"), 4).alias("history_length_per_series"), F.lit("irregular").alias("frequency"), F.min("event_id").alias("first_time"), F.max("event_id").alias("last_time"),
        F.struct(F.round(F.avg("value"), 4).alias("mean"), F.min("value").alias("least"), F.max("value").alias("most")).alias("summary"), F.lit("none").alias("business_constraints"),
        F.round(F.avg((F.col("value") == 0).cast("int")), 4).alias("target_zero_ratio"), F.max("props").alias("hidden_truth"),
    )
    e = F.col("evidence")
    made = od.evidence_packets(contexts, "user_id")
    return made.select("user_id", F.size(e["schema"]["columns"]).alias("n_columns"), e["data_scale"]["row_count"].alias("row_count"), e["data_scale"]["series_count"].alias("series_count"), e["data_scale"]["history_length_per_series"].alias("history"), e["time_index"]["observed_range"]["start"].alias("start"), e["time_index"]["observed_range"]["end"].alias("last"), e["statistics"]["mean"].alias("mean"), e["statistics"]["most"].alias("most"), e["target_zero_ratio"].alias("zero_ratio"))


QUERIES = {"open_records": open_records, "evidence_packets": evidence_packets}

ORACLE_SQL = {
    "open_records": r"""WITH p AS (
          SELECT q.conv_id, q.turn, trim(q.text) AS question, a.text AS answer, ['forecasting', 'anomaly_detection', NULL, NULL][q.turn % 4 + 1] AS typed FROM conversations q
          LEFT JOIN conversations a ON a.conv_id = q.conv_id AND a.turn = q.turn + 1 AND a.role = 'assistant' WHERE q.role = 'user'
        ), k AS (SELECT *, regexp_replace(lower(question), '[^a-z0-9]+', '_', 'g') AS key FROM p WHERE question <> ''
        ), f AS (
          SELECT *, coalesce(typed, CASE WHEN contains(key, 'forecast') OR contains(key, 'predict') THEN 'forecasting' WHEN contains(key, 'imput') OR contains(key, 'missing') THEN 'imputation' WHEN contains(key, 'anomal') OR contains(key, 'outlier') THEN 'anomaly_detection'
                   WHEN contains(key, 'change') THEN 'change_point' WHEN contains(key, 'season') OR contains(key, 'period') THEN 'seasonality' WHEN contains(key, 'trend') THEN 'trend' WHEN contains(key, 'caus') THEN 'causality'
                   WHEN contains(key, 'correl') OR contains(key, 'similar') THEN 'similarity' WHEN contains(key, 'classif') THEN 'classification' WHEN contains(key, 'noise') THEN 'noise' END) AS capability,
                 length(question) < 100 AS short, length(question) > 10000 AS long, length(regexp_replace(question, '[^#*$%&|<>]', '', 'g')) * 20 > length(question) AS symbols, question = upper(question) AS shout FROM k
        )
        SELECT 'openq_' || substr(sha1('conversations::' || conv_id || '::' || turn || '::' || question), 1, 16) AS id, CAST(conv_id AS VARCHAR) AS conv_id, turn, capability AS normalized_capability,
               trim(coalesce(CASE WHEN conv_id % 2 = 0 AND substr(answer, 1, 9) <> '' THEN substr(answer, 1, 9) END, answer, '')) AS answer,
               concat_ws(',', CASE WHEN short THEN 'too_short' END, CASE WHEN long THEN 'too_long' END, CASE WHEN regexp_matches(question, '[0-9]') THEN 'has_numbers' END, CASE WHEN regexp_matches(question, '(^|\n)\s*\(?[A-D][).]') THEN 'multiple_choice' END,
                         CASE WHEN symbols THEN 'many_symbols' END, CASE WHEN shout THEN 'shouting' END, CASE WHEN len(string_split(question, chr(10))) > 20 THEN 'many_lines' END) AS flags,
               CASE WHEN short THEN 'discard' WHEN symbols OR shout THEN 'rewrite' WHEN long THEN 'truncate' ELSE 'reuse' END AS reuse_strategy,
               CAST(CASE WHEN answer IS NULL THEN 0 ELSE least(12, len(string_split(answer, chr(10)))) END AS INTEGER) AS num_series,
               CAST(coalesce(list_max(list_transform(string_split(answer, chr(10))[1:12], lambda l: least(1024, len(string_split(l, ' '))))), 0) AS INTEGER) AS max_length, coalesce(contains(answer, '<think>'), false) AS has_cot
        FROM f WHERE capability IS NOT NULL""",
    "evidence_packets": """SELECT user_id, CAST(3 AS INTEGER) AS n_columns, count(*) AS row_count, count(DISTINCT event_type) AS series_count, round(count(*) / count(DISTINCT event_type), 4) AS history,
        CAST(min(event_id) AS VARCHAR) AS start, CAST(max(event_id) AS VARCHAR) AS last, round(avg(value), 4) AS mean, max(value) AS most, round(avg(CASE WHEN value = 0 THEN 1 ELSE 0 END), 4) AS zero_ratio FROM events GROUP BY user_id""",
}
