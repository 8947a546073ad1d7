"""Queries over profiles, gap filling, index defects and gates over recorded rows, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import curation as cu
from tidemark.operators import diagnostics as dg
from tidemark.operators import profiles as pf
from tidemark.plans.panel_queries import _ACF, _FILLED, _GRID, _W, _filled, _grid, _t


def _catalogue(spark: SparkSession, sf: str) -> DataFrame:
    part = _t(spark, sf, "part").groupBy(F.substring_index("p_name", " ", 1).alias("name")).agg(F.min("p_retailprice").alias("price"))
    nation = _t(spark, sf, "nation").select(F.lower("n_name").alias("name"), F.col("n_regionkey").cast("int").alias("region"))
    region = _t(spark, sf, "region").select(F.lower("r_name").alias("name"), F.col("r_regionkey").cast("int").alias("region"))
    return cu.merged_catalogue([part, nation, region], "name").select("name", "source_rank", "price", "region")


def _facts(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    pick = lambda values, d: F.element_at(F.array(*map(F.lit, values)), (F.pmod(F.floor(k / d), F.lit(len(values))) + 1).cast("int"))
    mechanisms = [["block"], ["block", "synchronous"], ["value_dependent_high"]]
    return _t(spark, sf, "customer").select(
        k.alias("scenario"), pick(["clean", "confounded", "noisy"], 1).alias("complexity"), pick(["missing_blocks", "drift", "trend", "intermittent"], 3).alias("pattern"),
        (F.pmod(k, F.lit(7)) / 10).alias("within"), (F.pmod(k, F.lit(5)) / 10).alias("between"),
        F.element_at(F.array(*[F.array(*map(F.lit, m)) for m in mechanisms]), (F.pmod(k, F.lit(3)) + 1).cast("int")).alias("mechanisms"),
        F.pmod(k, F.lit(4)).alias("seasons"), (F.pmod(k, F.lit(2)) == 0).alias("season_moves"), pick(["gaussian", "student_t"], 2).alias("noise"),
    )


def _difficulty(spark: SparkSession, sf: str) -> DataFrame:
    return cu.difficulty(_facts(spark, sf)).select("scenario", F.array_join("reasons", ",").alias("reasons"), "difficulty")


def _findings(spark: SparkSession, sf: str) -> DataFrame:
    docs = _t(spark, sf, "documents").select("doc_id", cu.finding_assertions(F.col("text")).alias("found"))
    return docs.select("doc_id", F.size("found").alias("n_assertions"), F.coalesce(F.get("found", F.lit(0)), F.lit("")).alias("first"))


def _repairs(spark: SparkSession, sf: str) -> DataFrame:
    turns = _t(spark, sf, "conversations")
    taken = cu.limited_with_repairs(turns, "conv_id", F.length("text") < 20, 50)
    return taken.groupBy("conv_id", "repair").agg(F.count("*").alias("turns"))


QUERIES = {
    "channel_profile": lambda s, d: pf.channel_profile(_grid(s, d)),
    "variance_change": lambda s, d: pf.variance_change(_filled(s, d)),
    "gap_fills": lambda s, d: pf.gap_fills(_grid(s, d)),
    "white_noise": lambda s, d: pf.white_noise(dg.autocorrelation(_filled(s, d))),
    "index_defects": lambda s, d: pf.index_defects(_grid(s, d)).withColumn("value", F.round("value", 6)),
    "missing_mechanisms": lambda s, d: pf.missingness(_grid(s, d)),
    "version_gate": lambda s, d: cu.stale_rows(_t(s, d, "orders"), "o_orderkey", "o_orderstatus", "F"),
    "limit_and_repair": _repairs,
    "merged_catalogue": _catalogue,
    "analysis_difficulty": _difficulty,
    "finding_assertions": _findings,
}

_PICK = lambda values, d: f"[{', '.join(repr(v) for v in values)}][CAST(c_custkey // {d} AS BIGINT) % {len(values)} + 1]"

ORACLE_SQL = {
    "channel_profile": f"""WITH {_GRID}, five AS (
        SELECT series_id, count(*) AS n, min(t) AS first_t, max(t) AS last_t, min(value) AS mi, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS md, quantile_cont(value, 0.75) AS q3, max(value) AS ma
        FROM grid WHERE value IS NOT NULL GROUP BY series_id)
        SELECT f.series_id, n, first_t, last_t, round(mi, 6) AS min, round(q1, 6) AS q1, round(md, 6) AS median, round(q3, 6) AS q3, round(ma, 6) AS max,
        round(min(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS low, round(max(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS high,
        count(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS beyond FROM grid AS g JOIN five AS f USING (series_id) WHERE value IS NOT NULL GROUP BY ALL""",
    "variance_change": f"""WITH {_FILLED}, c AS (SELECT series_id, t, value - avg(value) OVER (PARTITION BY series_id) AS x FROM filled),
        r AS (SELECT series_id, t, row_number() OVER {_W} - 1 AS i, count(*) OVER p AS n, sum(x) OVER b AS s, sum(x * x) OVER b AS q, sum(x) OVER p AS sa, sum(x * x) OVER p AS qa FROM c
              WINDOW p AS (PARTITION BY series_id), b AS (PARTITION BY series_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        v AS (SELECT series_id, t, i, q / i - (s / i) ** 2 AS a, (qa - q) / (n - i) - ((sa - s) / (n - i)) ** 2 AS z FROM r WHERE i >= greatest(4, floor(n * 0.18)) AND i < least(n - 4, floor(n * 0.82)))
        SELECT series_id, t, score FROM (SELECT series_id, t, i, round(abs(ln(z / a)), 6) AS score FROM v WHERE a > 0 AND z > 0) AS x QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY score DESC, i) = 1""",
    "gap_fills": f"""WITH {_FILLED}, w AS (SELECT series_id, t, value, last_value(value IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS forward,
        avg(value) OVER (PARTITION BY series_id, t % 24) AS seasonal, avg(value) OVER (PARTITION BY series_id) AS mean FROM grid)
        SELECT w.series_id, w.t, round(forward, 6) AS forward, round(f.value, 6) AS linear, round(seasonal, 6) AS seasonal, round(mean, 6) AS mean FROM w JOIN filled AS f ON f.series_id = w.series_id AND f.t = w.t WHERE w.value IS NULL""",
    "white_noise": f"""WITH {_ACF}, b AS (SELECT series_id, n, count(*) AS lags, round(n * (n + 2) * sum(acf * acf / (n - lag)), 4) AS q FROM acf WHERE lag <= 10 GROUP BY series_id, n),
        p AS (SELECT *, round(exp(-q / 2) * (1 + q / 2 + (q / 2) ** 2 / 2 + (q / 2) ** 3 / 6 + (q / 2) ** 4 / 24), 6) AS p_value FROM b WHERE lags = 10)
        SELECT series_id, n, q, p_value, p_value > 0.05 AS white FROM p""",
    "index_defects": f"""WITH {_GRID}, k AS (SELECT * FROM grid WHERE t % 70 >= 3), r AS (
        SELECT *, CASE WHEN t % 90 IN (10, 11) THEN 'unsorted' ELSE 'none' END AS defect FROM k UNION ALL SELECT *, 'duplicate' FROM k WHERE t % 50 = 0)
        SELECT CASE t % 90 WHEN 10 THEN t + 1 WHEN 11 THEN t - 1 ELSE t END AS position, series_id, t, round(value, 6) AS value, defect FROM r""",
    "missing_mechanisms": f"""WITH {_GRID}, ends AS (SELECT min(t) AS t0, max(t) AS t1 FROM grid), r AS (
        SELECT g.*, row_number() OVER {_W} - 1 AS i, count(*) OVER (PARTITION BY series_id) AS n, quantile_cont(value, 0.9) OVER (PARTITION BY series_id) AS cut, t0, t1 FROM grid AS g, ends)
        SELECT series_id, t, 'block' AS mechanism FROM r WHERE i >= floor(n * 0.4) AND i < floor(n * (0.4 + 0.05))
        UNION ALL SELECT series_id, t, 'random' FROM r WHERE (t * 7919 + length(series_id) * 104729) % 1000 < 50
        UNION ALL SELECT series_id, t, 'value_dependent' FROM r WHERE value > cut
        UNION ALL SELECT series_id, t, 'synchronous' FROM r WHERE t >= t0 + floor((t1 - t0) * 0.7) AND t < t0 + floor((t1 - t0) * (0.7 + 0.05))""",
    "version_gate": "SELECT count(*) AS n_stale, (SELECT list(k ORDER BY k) FROM (SELECT o_orderkey AS k FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F' ORDER BY k LIMIT 3) AS x) AS first FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F'",
    "limit_and_repair": """WITH g AS (SELECT conv_id, bool_or(coalesce(length(text) < 20, false)) AS bad, row_number() OVER (ORDER BY conv_id) AS n, count(*) AS turns FROM conversations GROUP BY conv_id)
        SELECT conv_id, n > 50 AS repair, turns FROM g WHERE n <= 50 OR bad""",
    "merged_catalogue": """WITH u AS (SELECT split_part(p_name, ' ', 1) AS name, 0 AS source_rank, min(p_retailprice) AS price, NULL::INTEGER AS region FROM part GROUP BY 1
        UNION ALL SELECT lower(n_name), 1, NULL, CAST(n_regionkey AS INTEGER) FROM nation UNION ALL SELECT lower(r_name), 2, NULL, CAST(r_regionkey AS INTEGER) FROM region)
        SELECT name, source_rank, price, region FROM u QUALIFY row_number() OVER (PARTITION BY name ORDER BY source_rank, price, region) = 1""",
    "analysis_difficulty": f"""WITH f AS (SELECT c_custkey AS scenario, {_PICK(['clean', 'confounded', 'noisy'], 1)} AS complexity, {_PICK(['missing_blocks', 'drift', 'trend', 'intermittent'], 3)} AS pattern,
        c_custkey % 7 / 10 AS within, c_custkey % 5 / 10 AS between_, [['block'], ['block', 'synchronous'], ['value_dependent_high']][c_custkey % 3 + 1] AS m, c_custkey % 4 AS seasons, c_custkey % 2 = 0 AS moves,
        {_PICK(['gaussian', 'student_t'], 2)} AS noise FROM customer),
        r AS (SELECT scenario, list_filter([CASE WHEN complexity = 'confounded' THEN 'confounded_components' END, CASE WHEN abs(within - between_) >= 0.15 THEN 'cross_series_heterogeneity' END,
        CASE WHEN pattern = 'missing_blocks' AND len(list_filter(m, lambda x: contains(x, 'value_dependent') OR contains(x, 'synchronous'))) > 0 THEN 'ambiguous_missing_mechanism' END,
        CASE WHEN pattern = 'missing_blocks' AND len(list_distinct(m)) > 1 THEN 'mixed_missing_mechanisms' END,
        CASE WHEN pattern IN ('distribution_mismatch', 'sequence_anomaly', 'residual_hetero', 'drift') THEN 'diagnostic_conflict' END,
        CASE WHEN pattern <> 'intermittent' AND seasons >= 2 AND moves THEN 'time_varying_multiseasonality' END,
        CASE WHEN pattern <> 'intermittent' AND noise IN ('student_t', 'heteroscedastic', 'level_dependent', 'mixture') THEN 'nonstandard_noise' END], lambda x: x IS NOT NULL) AS reasons FROM f)
        SELECT scenario, array_to_string(reasons, ',') AS reasons, CASE WHEN len(reasons) >= 2 AND list_has_any(reasons, ['confounded_components', 'cross_series_heterogeneity', 'ambiguous_missing_mechanism', 'diagnostic_conflict'])
        THEN 'hard' ELSE 'medium' END AS difficulty FROM r""",
    "finding_assertions": f"""WITH c AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(coalesce(text, ''), '{cu.CLAUSE_ENDS}'), lambda x: trim(x)),
        lambda x: regexp_matches(x, '{cu.ENTITY}') AND regexp_matches(x, '{cu.FINDING}') AND regexp_matches(x, '{cu.ASSERTION}') AND NOT regexp_matches(x, '{cu.DOUBT}')) AS f FROM documents)
        SELECT doc_id, CAST(len(f) AS INTEGER) AS n_assertions, coalesce(f[1], '') AS first FROM c""",
}
