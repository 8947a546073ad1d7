"""Registered queries over panels, relations, diagnostics and residuals, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import diagnostics as dg
from tidemark.operators import panel as pn
from tidemark.operators import relations as rl


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _grid(spark: SparkSession, sf: str) -> DataFrame:
    return pn.full_grid(pn.hourly_panel(_t(spark, sf, "events")))


def _filled(spark: SparkSession, sf: str) -> DataFrame:
    return pn.interpolated(_grid(spark, sf)).drop("was_missing")


def _long(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "events").select(F.col("event_type").alias("series_id"), pn.hour_of("ts").alias("t"), "event_id", "value")


def _residuals(spark: SparkSession, sf: str) -> DataFrame:
    lines, parts = _t(spark, sf, "lineitem"), _t(spark, sf, "part")
    return lines.join(parts, lines.l_partkey == parts.p_partkey).select(
        F.col("l_extendedprice").alias("actual"), (F.col("l_quantity") * F.col("p_retailprice")).alias("predicted"), F.col("l_linenumber").alias("horizon"), F.col("p_brand").alias("grp")
    )


def _wide(spark: SparkSession, sf: str) -> DataFrame:
    return pn.to_wide(_long(spark, sf), ["t", "event_id"])


def _trips(spark: SparkSession, sf: str) -> DataFrame:
    o, c, n, r = (_t(spark, sf, x) for x in ("orders", "customer", "nation", "region"))
    return o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey)


def hierarchy_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Order totals of nations, regions and all; the levels add up."""
    return _trips(spark, sf).rollup("r_name", "n_name").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.count_distinct("c_custkey").alias("customers"))


def monthly_drift(spark: SparkSession, sf: str) -> DataFrame:
    orders = _t(spark, sf, "orders")
    return dg.drift_index(orders, "o_totalprice", F.col("o_orderdate") >= F.expr("TIMESTAMP_NTZ'1998-06-01 00:00:00'"))


def index_quality(spark: SparkSession, sf: str) -> DataFrame:
    return pn.index_quality(_long(spark, sf), "series_id", "t")


QUERIES = {
    "panel_summary": lambda s, d: pn.summary(_grid(s, d)),
    "wide_panel": _wide,
    "wide_to_long": lambda s, d: pn.to_long(_wide(s, d)),
    "index_quality": index_quality,
    "series_relations": lambda s, d: rl.correlations(_grid(s, d)),
    "lagged_best_corr": lambda s, d: rl.best_lags(_grid(s, d)),
    "rank_correlation": lambda s, d: rl.spearman(_grid(s, d)),
    "within_between_corr": lambda s, d: rl.group_separation(rl.correlations(_grid(s, d))),
    "series_links": lambda s, d: rl.components_at(rl.correlations(_grid(s, d)), 0.05),
    "wasserstein_pairs": lambda s, d: rl.wasserstein(pn.hourly_panel(_t(s, d, "events"))),
    "series_acf": lambda s, d: dg.autocorrelation(_filled(s, d)),
    "ljung_box_stat": lambda s, d: dg.ljung_box(dg.autocorrelation(_filled(s, d))),
    "robust_anomalies": lambda s, d: dg.robust_anomalies(_filled(s, d)),
    "change_point": lambda s, d: dg.change_point(_filled(s, d), 0.0),
    "interpolate_fill": lambda s, d: pn.interpolated(_grid(s, d)).withColumn("value", F.round("value", 6)),
    "zscore_overlay": lambda s, d: dg.zscores(_grid(s, d)),
    "histogram35": lambda s, d: dg.histogram(pn.hourly_panel(_t(s, d, "events"))),
    "missing_runs": lambda s, d: dg.missing_runs(_grid(s, d)),
    "local_trends": lambda s, d: dg.local_trends(_filled(s, d)),
    "shape_distribution": lambda s, d: dg.shape(pn.hourly_panel(_t(s, d, "events"))),
    "local_peaks": lambda s, d: dg.peaks(_filled(s, d)),
    "outlier_clip": lambda s, d: dg.clipped(_filled(s, d)),
    "leakage_features": lambda s, d: dg.lag_features(_filled(s, d)),
    "covariate_lags": lambda s, d: dg.covariate_effects(_filled(s, d)),
    "breach_runs": lambda s, d: dg.breach_runs(_filled(s, d), F.col("value") > 55),
    "residual_by_group": lambda s, d: dg.residual_summary(_residuals(s, d), ["grp"]),
    "residual_by_horizon": lambda s, d: dg.residual_summary(_residuals(s, d), ["horizon"]),
    "interval_coverage": lambda s, d: dg.interval_coverage(_residuals(s, d), ["horizon", "grp"]),
    "drift_psi": monthly_drift,
    "hierarchy_rollup": hierarchy_rollup,
}

_HOUR = "CAST(floor(epoch(ts) / 3600) - floor(epoch(TIMESTAMP '2024-01-01') / 3600) AS INTEGER)"
_PANEL = f"panel AS (SELECT event_type AS series_id, {_HOUR} AS t, avg(value) AS value FROM events GROUP BY ALL)"
_GRID = f"""{_PANEL}, grid AS (
  SELECT s.series_id, x.t, p.value FROM (SELECT DISTINCT series_id FROM panel) AS s
  CROSS JOIN (SELECT CAST(unnest(range(min(t), max(t) + 1)) AS INTEGER) AS t FROM panel) AS x LEFT JOIN panel AS p ON p.series_id = s.series_id AND p.t = x.t)"""
_FILLED = f"""{_GRID}, sides AS (
  SELECT series_id, t, value, last_value(value IGNORE NULLS) OVER b AS v0, last_value(CASE WHEN value IS NOT NULL THEN t END IGNORE NULLS) OVER b AS t0,
         first_value(value IGNORE NULLS) OVER a AS v1, first_value(CASE WHEN value IS NOT NULL THEN t END IGNORE NULLS) OVER a AS t1
  FROM grid WINDOW b AS (PARTITION BY series_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY series_id ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), filled AS (SELECT series_id, t, value IS NULL AS was_missing, coalesce(value, v0 + (v1 - v0) * (t - t0) / nullif(t1 - t0, 0), v0, v1) AS value FROM sides)"""
_R = "CASE WHEN stddev_pop({x}) FILTER ({b}) * stddev_pop({y}) FILTER ({b}) > 0 THEN covar_pop({x}, {y}) / (stddev_pop({x}) FILTER ({b}) * stddev_pop({y}) FILTER ({b})) END"


def _r(x: str, y: str) -> str:
    return _R.format(x=x, y=y, b=f"{x} IS NOT NULL AND {y} IS NOT NULL")


_CORR = f"""{_GRID}, fit AS (SELECT series_id, regr_slope(value, t) AS m, regr_intercept(value, t) AS c, count(value) AS n FROM grid GROUP BY series_id),
views AS (SELECT series_id, t, value AS v, value - lag(value) OVER (PARTITION BY series_id ORDER BY t) AS d, CASE WHEN n >= 3 THEN value - (m * t + c) END AS f FROM grid JOIN fit USING (series_id)),
pairs AS (SELECT a.series_id AS a, b.series_id AS b, a.v AS va, b.v AS vb, a.d AS da, b.d AS db, a.f AS fa, b.f AS fb FROM views AS a JOIN views AS b ON a.t = b.t AND a.series_id < b.series_id),
raw AS (SELECT a, b, count(*) FILTER (va IS NOT NULL AND vb IS NOT NULL) AS overlap, {_r('va', 'vb')} AS r1, {_r('da', 'db')} AS r2, {_r('fa', 'fb')} AS r3 FROM pairs GROUP BY a, b),
corr AS (SELECT a, b, overlap, CASE WHEN ok THEN round(r1, 6) END AS raw_r, CASE WHEN ok THEN round(r2, 6) END AS diff_r, CASE WHEN ok THEN round(r3, 6) END AS detrended_r
  FROM (SELECT *, overlap >= greatest(8, floor((SELECT count(DISTINCT t) FROM grid) / 10)) AS ok FROM raw) AS x)"""
_ACF = f"""{_FILLED}, centred AS (SELECT series_id, t, value - avg(value) OVER (PARTITION BY series_id) AS x, count(*) OVER (PARTITION BY series_id) AS n FROM filled),
acf AS (SELECT a.series_id, CAST(k AS INTEGER) AS lag, any_value(a.n) AS n, round(sum(a.x * b.x) / (SELECT sum(x * x) FROM centred AS c WHERE c.series_id = a.series_id), 6) AS acf
  FROM centred AS a CROSS JOIN range(1, 25) AS r(k) JOIN centred AS b ON b.series_id = a.series_id AND b.t = a.t - k WHERE k <= floor(a.n / 3) GROUP BY a.series_id, k)"""
_WIDE = f"""long AS (SELECT event_type AS series_id, {_HOUR} AS t, event_id, value FROM events),
names AS (SELECT series_id, 's' || lpad(CAST(row_number() OVER (ORDER BY t, event_id, series_id) AS VARCHAR), 2, '0') AS alias FROM (SELECT series_id, t, event_id FROM long QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY t, event_id) = 1) AS f),
occ AS (SELECT t, CAST(row_number() OVER (PARTITION BY t, series_id ORDER BY t, event_id) - 1 AS INTEGER) AS occ, alias, value FROM long JOIN names USING (series_id)),
wide AS (SELECT t, occ, {', '.join(f"max(value) FILTER (alias = 's0{k}') AS s0{k}" for k in range(1, 6))} FROM occ GROUP BY t, occ)"""
_RES = "res AS (SELECT l_extendedprice AS actual, l_quantity * p_retailprice AS predicted, l_linenumber AS horizon, p_brand AS grp, l_extendedprice - l_quantity * p_retailprice AS e FROM lineitem JOIN part ON l_partkey = p_partkey)"
_RESID = "count(*) AS n, round(avg(e), 4) AS bias, round(avg(abs(e)), 4) AS mae, round(sqrt(avg(e * e)), 4) AS rmse, round(quantile_cont(abs(e), 0.9), 4) AS p90, round(quantile_cont(abs(e), 0.99), 4) AS p99"
_W = "(PARTITION BY series_id ORDER BY t)"

ORACLE_SQL = {
    "panel_summary": f"""WITH {_GRID} SELECT series_id, count(value) AS n, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std, round(min(value), 4) AS min, round(max(value), 4) AS max,
        round(avg(CAST(value IS NULL AS INTEGER)), 4) AS missing_ratio, round(coalesce(count(*) FILTER (value = 0) / nullif(count(value), 0), 0), 4) AS zero_ratio FROM grid GROUP BY series_id""",
    "wide_panel": f"WITH {_WIDE} SELECT * FROM wide",
    "wide_to_long": f"WITH {_WIDE} SELECT * FROM ({' UNION ALL '.join(f"SELECT t, occ, 's0{k}' AS alias, s0{k} AS value FROM wide" for k in range(1, 6))}) AS x WHERE occ = 0 OR value IS NOT NULL",
    "index_quality": f"""WITH times AS (SELECT event_type AS series_id, {_HOUR} AS t, count(*) AS n FROM events GROUP BY ALL),
        steps AS (SELECT *, t - lag(t) OVER {_W} AS step FROM times), counts AS (SELECT series_id, step, count(*) AS c FROM steps WHERE step IS NOT NULL GROUP BY ALL)
        SELECT series_id, CAST(sum(n) AS BIGINT) AS points, count(*) AS distinct_times, CAST(sum(n) - count(*) AS BIGINT) AS duplicates,
        (SELECT max(c) FROM counts AS c WHERE c.series_id = s.series_id) AS regular_steps, count(step) AS steps FROM steps AS s GROUP BY series_id""",
    "series_relations": f"WITH {_CORR} SELECT * FROM corr",
    "within_between_corr": f"""WITH {_CORR} SELECT round(avg(raw_r) FILTER (split_part(a, '_', 1) = split_part(b, '_', 1)), 6) AS within_r, round(avg(raw_r) FILTER (split_part(a, '_', 1) <> split_part(b, '_', 1)), 6) AS between_r,
        count(raw_r) AS pairs, coalesce(min(raw_r) > 0.9, false) AS all_above_090 FROM corr""",
    "series_links": f"""WITH {_CORR}, both_ways AS (SELECT a, b, raw_r FROM corr UNION ALL SELECT b, a, raw_r FROM corr)
        SELECT a AS series_id, round(avg(raw_r), 6) AS mean_r, (list(b ORDER BY raw_r DESC, b DESC) FILTER (raw_r IS NOT NULL))[1] AS closest, count(*) FILTER (raw_r >= 0.05) AS links FROM both_ways GROUP BY a""",
    "lagged_best_corr": f"""WITH {_GRID}, points AS (SELECT * FROM grid WHERE value IS NOT NULL), reach AS (SELECT CAST(least(60, greatest(3, floor(count(DISTINCT t) / 6))) AS INTEGER) AS l FROM grid),
        met AS (SELECT a.series_id AS a, b.series_id AS b, k AS lag, {_r('a.value', 'b.value')} AS r, count(*) AS n FROM points AS a CROSS JOIN (SELECT unnest(range(-l, l + 1)) AS k FROM reach) AS k
          JOIN points AS b ON b.t = a.t + k AND a.series_id < b.series_id GROUP BY ALL)
        SELECT a, b, CAST(lag AS INTEGER) AS lag, round(r, 6) AS r, n FROM met WHERE r IS NOT NULL AND n >= 8 QUALIFY row_number() OVER (PARTITION BY a, b ORDER BY round(r, 6) DESC, abs(lag), lag) = 1""",
    "rank_correlation": f"""WITH {_GRID}, pairs AS (SELECT a.series_id AS a, b.series_id AS b, a.value AS x, b.value AS y FROM grid AS a JOIN grid AS b ON a.t = b.t AND a.series_id < b.series_id WHERE a.value IS NOT NULL AND b.value IS NOT NULL),
        ranked AS (SELECT a, b, rank() OVER (PARTITION BY a, b ORDER BY x) + (count(*) OVER (PARTITION BY a, b, x) - 1) / 2 AS ra, rank() OVER (PARTITION BY a, b ORDER BY y) + (count(*) OVER (PARTITION BY a, b, y) - 1) / 2 AS rb FROM pairs)
        SELECT a, b, round({_r('ra', 'rb')}, 6) AS rho, count(*) AS n FROM ranked GROUP BY a, b""",
    "wasserstein_pairs": f"""WITH {_PANEL}, pair AS (SELECT l.s AS a, r.s AS b FROM (SELECT DISTINCT series_id AS s FROM panel) AS l JOIN (SELECT DISTINCT series_id AS s FROM panel) AS r ON l.s < r.s),
        both_sides AS (SELECT a, b, CAST(series_id = a AS INTEGER) AS is_a, value FROM pair JOIN panel ON series_id IN (a, b)),
        steps AS (SELECT a, b, value, sum(is_a) AS na, sum(1 - is_a) AS nb FROM both_sides GROUP BY ALL),
        gaps AS (SELECT a, b, sum(na) OVER w / sum(na) OVER (PARTITION BY a, b) AS fa, sum(nb) OVER w / sum(nb) OVER (PARTITION BY a, b) AS fb, lead(value) OVER w - value AS gap FROM steps WINDOW w AS (PARTITION BY a, b ORDER BY value)),
        d AS (SELECT a, b, sum(abs(fa - fb) * coalesce(gap, 0)) AS w FROM gaps GROUP BY a, b)
        SELECT a, b, round(w, 6) AS w1, round(w / (sd + 1e-8), 6) AS w1_scaled FROM d JOIN (SELECT a, b, stddev_samp(value) AS sd FROM both_sides GROUP BY a, b) AS s USING (a, b)""",
    "series_acf": f"WITH {_ACF} SELECT * FROM acf",
    "ljung_box_stat": f"WITH {_ACF} SELECT series_id, n, count(*) AS lags, round(n * (n + 2) * sum(acf * acf / (n - lag)), 4) AS q FROM acf WHERE lag <= 10 GROUP BY series_id, n",
    "robust_anomalies": f"""WITH {_FILLED}, rest AS (SELECT series_id, t, value - quantile_cont(value, 0.5) OVER (PARTITION BY series_id ORDER BY t ROWS BETWEEN 15 PRECEDING AND 15 FOLLOWING) AS r FROM filled),
        med AS (SELECT series_id, quantile_cont(r, 0.5) AS m, count(*) AS n FROM rest GROUP BY series_id), mad AS (SELECT series_id, quantile_cont(abs(r - m), 0.5) AS mad FROM rest JOIN med USING (series_id) GROUP BY series_id),
        scored AS (SELECT series_id, t, n, 0.6745 * (r - m) / (mad + 1e-8) AS z FROM rest JOIN med USING (series_id) JOIN mad USING (series_id))
        SELECT series_id, t, round(z, 4) AS z FROM scored WHERE abs(z) > 4.5 QUALIFY row_number() OVER {_W} <= greatest(3, least(12, floor(n / 50)))""",
    "change_point": f"""WITH {_FILLED}, s AS (SELECT series_id, t, row_number() OVER {_W} - 1 AS i, count(*) OVER p AS n, sum(value) OVER (PARTITION BY series_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l, sum(value) OVER p AS a, stddev_pop(value) OVER p AS sd
          FROM filled WINDOW p AS (PARTITION BY series_id)), scored AS (SELECT series_id, t, i, round(abs(l / i - (a - l) / (n - i)) / (sd + 1e-8), 6) AS score FROM s WHERE i >= greatest(4, floor(n * 0.18)) AND i < least(n - 4, floor(n * 0.82)))
        SELECT series_id, t, score FROM scored WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY score DESC, i) = 1""",
    "interpolate_fill": f"WITH {_FILLED} SELECT series_id, t, was_missing, round(value, 6) AS value FROM filled",
    "zscore_overlay": f"WITH {_GRID} SELECT series_id, t, round((value - avg(value) OVER p) / (stddev_pop(value) OVER p + 1e-8), 6) AS z FROM grid WINDOW p AS (PARTITION BY series_id)",
    "histogram35": f"""WITH {_PANEL}, e AS (SELECT min(value) AS lo, max(value) AS hi FROM panel)
        SELECT CAST(CASE WHEN hi > lo THEN least(34, floor((value - lo) * 35 / (hi - lo))) ELSE 0 END AS INTEGER) AS bin, count(*) AS n FROM panel, e WHERE value IS NOT NULL GROUP BY 1""",
    "missing_runs": f"""WITH {_GRID}, miss AS (SELECT series_id, t, count(*) OVER (PARTITION BY t) AS s FROM grid WHERE value IS NULL), runs AS (SELECT *, t - row_number() OVER {_W} AS run FROM miss)
        SELECT series_id, min(t) AS start, count(*) AS length, count(*) FILTER (s > 1) AS shared FROM runs GROUP BY series_id, run""",
    "local_trends": f"""WITH {_FILLED}, cut AS (SELECT *, ntile(6) OVER {_W} AS segment FROM filled)
        SELECT c.series_id, CAST(segment AS INTEGER) AS segment, round(regr_slope(value, t), 6) AS slope, round(regr_r2(value, t), 6) AS r2, any_value(round(w, 6)) AS whole_slope
        FROM cut AS c JOIN (SELECT series_id, regr_slope(value, t) AS w FROM filled GROUP BY series_id) AS x USING (series_id) GROUP BY c.series_id, segment""",
    "shape_distribution": f"""WITH {_PANEL}, m AS (SELECT series_id, avg(value) AS mu FROM panel GROUP BY series_id), c AS (SELECT series_id, value, value - mu AS d FROM panel JOIN m USING (series_id))
        SELECT series_id, round(avg(d * d * d) / power(avg(d * d), 1.5), 6) AS skewness, round(avg(d * d * d * d) / power(avg(d * d), 2) - 3, 6) AS kurtosis,
        round(quantile_cont(value, 0.05), 6) AS p05, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95 FROM c GROUP BY series_id""",
    "local_peaks": f"WITH {_FILLED}, n AS (SELECT *, lag(value) OVER {_W} AS b, lead(value) OVER {_W} AS a FROM filled) SELECT series_id, t, round(value, 6) AS value FROM n WHERE value > b AND value > a",
    "outlier_clip": f"""WITH {_FILLED}, b AS (SELECT series_id, quantile_cont(value, 0.02) AS lo, quantile_cont(value, 0.98) AS hi FROM filled GROUP BY series_id)
        SELECT series_id, t, round(least(greatest(value, lo), hi), 6) AS value FROM filled JOIN b USING (series_id)""",
    "leakage_features": f"""WITH {_FILLED} SELECT series_id, t, round(lag(value, 1) OVER w, 6) AS lag1, round(lag(value, 24) OVER w, 6) AS lag24, round(lead(value, 1) OVER w, 6) AS target_t_plus_1,
        round(avg(value) OVER (PARTITION BY series_id ORDER BY t ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING), 6) AS future_window_mean, round(avg(value) OVER (PARTITION BY series_id ORDER BY t ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS mean7,
        round(stddev_pop(value) OVER (PARTITION BY series_id ORDER BY t ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS std7, t % 24 AS hour FROM filled WINDOW w AS {_W}""",
    "covariate_lags": f"""WITH {_FILLED}, p AS (SELECT *, CAST(t % 30 < 4 AS INTEGER) AS promo FROM filled), l AS (SELECT *, lag(promo, 2, 0) OVER {_W} AS lagged FROM p)
        SELECT series_id, lagged, count(*) AS n, round(avg(value), 6) AS mean_value, CAST(sum(promo) AS BIGINT) AS promo_now FROM l GROUP BY series_id, lagged""",
    "breach_runs": f"""WITH {_FILLED}, h AS (SELECT series_id, t, t - row_number() OVER {_W} AS run FROM filled WHERE value > 55)
        SELECT series_id, min(t) AS start, count(*) AS length FROM h GROUP BY series_id, run HAVING count(*) >= 3""",
    "residual_by_group": f"WITH {_RES} SELECT grp, {_RESID} FROM res GROUP BY grp",
    "residual_by_horizon": f"WITH {_RES} SELECT horizon, {_RESID} FROM res GROUP BY horizon",
    "interval_coverage": f"""WITH {_RES}, h AS (SELECT quantile_cont(abs(e), 0.72) AS half FROM res)
        SELECT horizon, grp, count(*) AS n, round(avg(CAST(abs(e) <= half AS INTEGER)), 6) AS coverage, round(avg(2 * half), 4) AS width FROM res, h GROUP BY GROUPING SETS ((), (horizon), (grp))""",
    "drift_psi": """WITH f AS (SELECT o_totalprice AS v, o_orderdate >= TIMESTAMP '1998-06-01' AS late FROM orders WHERE o_totalprice IS NOT NULL), c AS (SELECT quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS cuts FROM f WHERE NOT late),
        b AS (SELECT CAST(len(list_filter(cuts, lambda x: x < v)) AS INTEGER) AS bin, late FROM f, c), n AS (SELECT bin, count(*) FILTER (NOT late) AS before, count(*) FILTER (late) AS after FROM b GROUP BY bin),
        s AS (SELECT *, greatest(before / sum(before) OVER (), 1e-6) AS p, greatest(after / sum(after) OVER (), 1e-6) AS q FROM n) SELECT bin, before, after, round((q - p) * ln(q / p), 6) AS psi_part FROM s""",
    "hierarchy_rollup": """SELECT r_name, n_name, count(*) AS n, round(sum(o_totalprice), 2) AS total, count(DISTINCT c_custkey) AS customers FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)""",
}
