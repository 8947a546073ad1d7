"""Queries on migrated panels, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import migration as mg
from tidemark.plans.panel_queries import _t


def _records(s: SparkSession, d: str) -> DataFrame:
    """A user's events as an old panel by day, with what was done to make it."""
    panels = _t(s, d, "events").select(F.col("user_id").alias("id"), F.col("ts").cast("date").alias("time"), F.when(F.col("value") >= 0.5, F.col("event_type")).alias("series_id"), "value")
    known = panels.groupBy("id").agg(F.count("*").alias("n"))
    truth = F.format_string('{"trend": %d, "generator": {"version": "1", "seed": %d}}', F.col("n"), F.col("id"))
    scenarios = known.select("id", F.lit("1").alias("version"), F.sha2(F.col("id").cast("string"), 256).alias("scenario_hash"), truth.alias("truth"))
    return mg.migrated(scenarios, panels, mg.wide_rows(panels), "2")


def migrated_scenarios(s: SparkSession, d: str) -> DataFrame:
    """Counts, hash and flags of each migrated panel; events below 0.5 have no series."""
    return _records(s, d).select("id", "source_rows", "source_duplicates", "wide_rows", "wide_duplicate_times", "semantic_sha256", F.array_join("flags", ",").alias("flags"))


def migration_report(s: SparkSession, d: str) -> DataFrame:
    """What the migration came to."""
    return mg.migration_report(_records(s, d))


QUERIES = {"migrated_scenarios": migrated_scenarios, "migration_report": migration_report}

_M = """p AS (SELECT user_id AS id, CAST(ts AS DATE) AS day, CASE WHEN value >= 0.5 THEN event_type END AS series FROM events),
    c AS (SELECT id, day, series, count(*) AS n FROM p GROUP BY ALL), a AS (SELECT id, CAST(sum(n) AS BIGINT) AS source_rows, CAST(sum(n - 1) AS BIGINT) AS source_duplicates FROM c GROUP BY id),
    w AS (SELECT id, day, max(n) AS rows, sum(n) AS held, sum(n - 1) AS again FROM c WHERE series IS NOT NULL GROUP BY id, day), b AS (SELECT id, sum(rows) AS wide_rows, sum(rows - 1) AS times, sum(held) AS held, sum(again) AS again FROM w GROUP BY id),
    r AS (SELECT a.id, source_rows, source_duplicates, CAST(coalesce(wide_rows, 0) AS BIGINT) AS wide_rows, CAST(coalesce(times, 0) AS BIGINT) AS wide_duplicate_times, sha256('{"generator": {"seed": ' || a.id || '}, "trend": ' || source_rows || '}') AS semantic_sha256,
                 concat_ws(',', CASE WHEN coalesce(held, 0) <> source_rows THEN 'rows_lost' END, CASE WHEN coalesce(again, 0) <> source_duplicates THEN 'duplicates_changed' END, CASE WHEN wide_rows IS NULL THEN 'no_rows' END) AS flags FROM a LEFT JOIN b ON b.id = a.id)"""

ORACLE_SQL = {
    "migrated_scenarios": f"WITH {_M} SELECT * FROM r",
    "migration_report": f"""WITH {_M} SELECT count(*) AS records, count(*) FILTER (flags = '') AS passed, CAST(sum(source_duplicates) AS BIGINT) AS source_duplicates, CAST(sum(wide_duplicate_times) AS BIGINT) AS wide_duplicate_times,
        true AS semantic_truth_preserved, count(*) FILTER (contains(flags, 'lost') OR contains(flags, 'changed')) = 0 AS points_preserved FROM r""",
}
