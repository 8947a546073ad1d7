"""Queries on series with injected events and on bundles, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import injections as ij
from tidemark.plans.panel_queries import _t
from tidemark.sources import bundles as bu


def _injected(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """A user's events as a series; how complex its events are goes by the user's number."""
    panel = _t(s, d, "events").select(F.col("user_id").cast("string").alias("series_id"), F.col("event_id").alias("t"), "value")
    users = panel.select("series_id").distinct()
    kind = F.element_at(F.array(*map(F.lit, ("controlled", "compositional", "confounded"))), (F.col("series_id").cast("long") % 3 + 1).cast("int"))
    return ij.inject_events(panel, users.select("series_id", kind.alias("complexity")))


def injected_events(s: SparkSession, d: str) -> DataFrame:
    """The series with their events."""
    points, _ = _injected(s, d)
    return points.select("series_id", "t", F.round("value", 6).alias("value"), F.array_join("kinds", ",").alias("kinds"))


def injected_truth(s: SparkSession, d: str) -> DataFrame:
    """What was done to each series."""
    _, truth = _injected(s, d)
    return truth.select("series_id", "n", "change", F.round("shift", 6).alias("shift"), F.round("spread", 6).alias("spread"), "spike_1", "spike_2", "cluster", "cluster_end", "contextual")


def bundle_sections(s: SparkSession, d: str) -> DataFrame:
    """Benchmark items as tools and documents as sources, each as its section of a bundle."""
    none = F.lit(None).cast("string")
    tools = _t(s, d, "benchmark").select(F.col("item_id").cast("string").alias("permission_name"), F.lit("items").alias("category"), none.alias("factory_function"), none.alias("handler_function"), F.lit("b").alias("source_file"), F.col("item_id").alias("start_line"), none.alias("schema_name"), F.length("text").cast("string").alias("description"), F.col("text").alias("implementation_source"))
    documents = _t(s, d, "documents").select(F.col("doc_id").cast("string").alias("path"), F.col("text").alias("source_code"), "lang")
    made = bu.bundle_sections(tools, documents.where("lang IS NOT NULL"), documents.where("lang IS NULL"))
    return made.select("part", "place", F.length("text").alias("n_chars"), F.sha2("text", 256).alias("sha256"))


QUERIES = {"injected_events": injected_events, "injected_truth": injected_truth, "bundle_sections": bundle_sections}

_U = lambda name: f"(CAST('0x' || substr(sha256('\"events:{name}:' || series_id || '\"'), 1, 12) AS BIGINT) / power(16, 12))"
_SIGN = lambda name: f"CASE WHEN {_U(name + ' sign')} < 0.5 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END"
_BY = lambda low, width, name: f"({low}::DOUBLE + {width} * {_U(name)})"
_W = {k: repr(b - a) + "::DOUBLE" for k, (a, b) in {"change": ij.CHANGE_AT, "spread": ij.SPREAD, "cluster": ij.CLUSTER_AT, "context": ij.CONTEXT}.items()}

_TRUTH = f"""p AS (SELECT CAST(user_id AS VARCHAR) AS series_id, user_id, event_id AS t, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id, value) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events),
    s AS (SELECT DISTINCT series_id, n, ['controlled', 'compositional', 'confounded'][user_id % 3 + 1] AS kind, greatest(2, CAST(floor(n * 0.12::DOUBLE) AS BIGINT)) AS low, least(n - 2, CAST(floor(n * 0.88::DOUBLE) AS BIGINT)) AS high FROM p),
    f AS (SELECT *, CAST(floor({_U('spike 1')} * (high - low)) AS BIGINT) AS d, CAST(floor(n * {_BY(0.24, _W['cluster'], 'cluster at')}) AS BIGINT) AS start FROM s WHERE n >= 12),
    g AS (SELECT series_id, CAST(floor(n * {_BY(0.5, _W['change'], 'change')}) AS BIGINT) AS change, {_SIGN('shift')} * {_BY(7.0, '9.0::DOUBLE', 'shift')} AS shift,
                 CASE WHEN kind <> 'controlled' THEN {_BY(1.35, _W['spread'], 'spread')} END AS spread, low + d AS spike_1, low + (d + 1 + CAST(floor({_U('spike 2')} * (high - low - 1)) AS BIGINT)) % (high - low) AS spike_2,
                 {_SIGN('size 1')} * {_BY(16.0, '14.0::DOUBLE', 'size 1')} AS size_1, {_SIGN('size 2')} * {_BY(16.0, '14.0::DOUBLE', 'size 2')} AS size_2,
                 CASE WHEN kind <> 'controlled' THEN start END AS cluster, CASE WHEN kind <> 'controlled' THEN least(n, start + greatest(3, n // 80)) END AS cluster_end,
                 {_SIGN('cluster')} * {_BY(6.0, '6.0::DOUBLE', 'cluster')} AS cluster_size, CASE WHEN kind = 'confounded' THEN {_BY(0.35, _W['context'], 'context')} END AS context FROM f),
    a AS (SELECT p.*, g.* EXCLUDE (series_id), coalesce(i >= change, false) AS after, CASE WHEN i >= change THEN value + shift ELSE value END AS v1 FROM p LEFT JOIN g ON g.series_id = p.series_id),
    b AS (SELECT *, avg(v1) FILTER (after) OVER (PARTITION BY series_id) AS m FROM a),
    c AS (SELECT *, CASE WHEN after AND spread IS NOT NULL THEN m + spread * (v1 - m) ELSE v1 END + CASE WHEN i = spike_1 THEN size_1 WHEN i = spike_2 THEN size_2 ELSE 0 END + CASE WHEN i >= cluster AND i < cluster_end THEN cluster_size ELSE 0 END AS v FROM b),
    x AS (SELECT series_id, arg_max(i, v) AS contextual FROM (SELECT * FROM c WHERE context IS NOT NULL AND i < greatest(3, floor(n * 0.8::DOUBLE))) AS e GROUP BY series_id)"""

_CODE = lambda c: f"chr(10) || '```python' || chr(10) || coalesce({c}, '') || chr(10) || '```' || chr(10)"

ORACLE_SQL = {
    "injected_events": f"""WITH {_TRUTH}
        SELECT c.series_id, t, round(CASE WHEN i = contextual THEN v * context ELSE v END, 6) AS value,
               concat_ws(',', CASE WHEN after THEN 'change' END, CASE WHEN i = spike_1 OR i = spike_2 THEN 'spike' END, CASE WHEN i >= cluster AND i < cluster_end THEN 'cluster' END, CASE WHEN i = contextual THEN 'contextual' END) AS kinds
        FROM c LEFT JOIN x ON x.series_id = c.series_id""",
    "injected_truth": f"""WITH {_TRUTH}
        SELECT s.series_id, s.n, change, round(shift, 6) AS shift, round(spread, 6) AS spread, spike_1, spike_2, cluster, cluster_end, contextual FROM s LEFT JOIN g ON g.series_id = s.series_id LEFT JOIN x ON x.series_id = s.series_id""",
    "bundle_sections": f"""WITH r AS (
          SELECT 0 AS part, CAST(item_id AS VARCHAR) AS place, '### `' || item_id || '`' || chr(10) || chr(10) || concat_ws(chr(10), '- Category: `items`', '- Factory: ``', '- Handler: ``', '- Source: `b:' || item_id || '`', '- Schema: ``', '- Description: ' || coalesce(CAST(length(text) AS VARCHAR), '')) || chr(10) || {_CODE('text')} AS text FROM benchmark
          UNION ALL SELECT CASE WHEN lang IS NULL THEN 2 ELSE 1 END, CAST(doc_id AS VARCHAR), '### `' || doc_id || '`' || chr(10) || {_CODE('text')} FROM documents
        ) SELECT part, place, CAST(length(text) AS INTEGER) AS n_chars, sha256(text) AS sha256 FROM r""",
}
