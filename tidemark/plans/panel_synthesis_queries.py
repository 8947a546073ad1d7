"""Queries over synthesized panels whose sizes and patterns come from the tables, with the SQL that checks them."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import factor_panels as fp
from tidemark.plans.panel_queries import _t
from tidemark.shared import written

_PATTERNS = [*fp.KINDS, "multi_period", "covariates"]
_TYPES = ["click", "error", "purchase", "signup", "view"]


def scenarios(s: SparkSession, d: str, until: str = "9999-01-01") -> DataFrame:
    """A user as a scenario: its events give the length, their kinds the width, the commonest kind the pattern."""
    events = _t(s, d, "events").where(F.col("ts") < F.lit(until).cast("timestamp_ntz")).groupBy("user_id", "event_type").agg(F.count("*").alias("c"))
    users = events.groupBy("user_id").agg(F.sum("c").alias("all"), F.count("*").alias("kinds"), F.min(F.struct(-F.col("c"), F.col("event_type"))).alias("e"))
    at = 2 * (F.array_position(F.array(*map(F.lit, _TYPES)), F.col("e.event_type")) - 1) + F.col("all") % 2
    n, k = F.greatest(F.lit(60), F.col("all")).cast("int"), (F.col("kinds") + 1).cast("int")
    return users.select(
        F.concat(F.lit("u"), "user_id").alias("scenario"), F.element_at(F.array(*map(F.lit, _PATTERNS)), (at + 1).cast("int")).alias("pattern"), n.alias("n"), k.alias("k"),
        F.greatest(F.lit(6.0), n / 8).alias("period"), (n % k).alias("odd"),
    )


def factor_panels(s: SparkSession, d: str) -> DataFrame:
    panel = written(fp.synthesize(fp.relation_profile(scenarios(s, d)).withColumn("attempt", F.lit(0))), "panels")
    values = fp.points(panel).groupBy("scenario", "series").agg(F.round(F.avg("value"), 4).alias("mean_value"), F.round(F.stddev_pop("value"), 4).alias("sd_value"), F.round(F.max_by("value", "t"), 4).alias("last_value"))
    r4 = lambda c: F.round(c, 4).alias(c)
    return panel.select("scenario", "series", "kind", r4("target"), "grp", "lag", r4("wc"), r4("wg"), r4("wi")).join(values, ["scenario", "series"])


def panel_gate(s: SparkSession, d: str) -> DataFrame:
    """The relations that the first panel of each scenario has, and what its kind lacks."""
    judged = fp.panel_metrics(written(fp.synthesize(fp.relation_profile(scenarios(s, d)).withColumn("attempt", F.lit(0))), "panels"))
    r4 = lambda c: F.round(c, 4).alias(c)
    return judged.select("scenario", "pattern", *map(r4, ("mean_r", "within_r", "between_r", "normal_r", "odd_r", "distance", "motif_r")), F.array_join(fp.relation_reasons(), ",").alias("reasons"))


def gated_panels(s: SparkSession, d: str) -> DataFrame:
    """Attempts (six at most) and lasting reasons of each scenario, and how many series its panel has."""
    panels, verdicts = fp.gated_panels(scenarios(s, d), attempts=6)
    return verdicts.join(panels.groupBy("scenario").agg(F.count("*").cast("int").alias("series")), "scenario", "left").select("scenario", "pattern", "attempts", "reasons", F.coalesce("series", F.lit(0)).alias("series"))


QUERIES = {"factor_panels": factor_panels, "panel_gate": panel_gate, "gated_panels": gated_panels}


def _u(*parts: str) -> str:
    key = " || ':' || ".join(p if p.startswith("(") else f"CAST({p} AS VARCHAR)" for p in parts)
    return f"(CAST('0x' || substr(sha256('\"panel:' || {key} || '\"'), 1, 12) AS BIGINT) / power(16, 12))"


def _b(low: float, high: float, *parts: str) -> str:
    return f"({low} + ({high - low}) * {_u(*parts)})"


def _normal(*parts: str) -> str:
    return f"(sqrt(-2 * ln(greatest({_u(*parts, "'a'")}, 1e-12))) * cos({2 * math.pi} * {_u(*parts, "'b'")}))"


_F = ("scenario", "0", "name")
_S = ("scenario", "0", "name")
_KIND = lambda i: "CASE pattern " + " ".join(f"WHEN '{p}' THEN {v[i]!r}" for p, v in fp.KINDS.items()) + f" ELSE {fp.OTHER[i]!r} END"
_BAND = lambda i: "CASE tier " + " ".join(f"WHEN '{b}' THEN {v[i]}" for b, v in fp.BANDS.items()) + f" ELSE {_KIND(i + 1)} END"

_BASE = f"""WITH counts AS (
      SELECT user_id, event_type, count(*) AS c FROM events GROUP BY ALL
    ), users AS (
      SELECT user_id, sum(c) AS n_all, count(*) AS kinds, arg_min(event_type, {{'c': -c, 'e': event_type}}) AS e FROM counts GROUP BY user_id
    ), sc AS (
      SELECT 'u' || user_id AS scenario, ({_PATTERNS!r})[2 * (list_position({_TYPES!r}, e) - 1) + CAST(n_all % 2 AS BIGINT) + 1] AS pattern, CAST(greatest(60, n_all) AS INTEGER) AS n, CAST(kinds + 1 AS INTEGER) AS k,
             greatest(6.0, CAST(greatest(60, n_all) AS DOUBLE) / 8) AS period, CAST(greatest(60, n_all) AS INTEGER) % CAST(kinds + 1 AS INTEGER) AS odd FROM users
    ), tiers AS (
      SELECT *, CASE WHEN pattern IN {tuple(fp.GENERAL)} THEN CASE WHEN {_u('scenario', "'tier'")} < 0.25 THEN 'low' WHEN {_u('scenario', "'tier'")} < 0.75 THEN 'medium' ELSE 'high' END END AS tier, {_KIND(0)} AS kind FROM sc
    ), bands AS (
      SELECT *, {_BAND(0)} AS low, {_BAND(1)} AS high, CASE WHEN pattern = 'phase_groups' THEN 3 ELSE 2 END AS groups FROM tiers
    ), aims AS (
      SELECT *, greatest(0.0, low) + (high - greatest(0.0, low)) * {_u('scenario', "'target'")} AS target, k // groups AS big, k % groups AS more FROM bands
    ), shares AS (
      SELECT *, (more * (big + 1) * big / 2 + (groups - more) * big * (big - 1) / 2) / greatest(1.0, k * (k - 1) / 2) AS share,
             CASE WHEN kind = 'scaled_shape' THEN 0.02 WHEN kind IN ('heterogeneous', 'local_motif') THEN 0.12 WHEN kind IN ('phase_shift', 'distribution_not_shape', 'sequence_anomaly') THEN 0.0 ELSE least(0.18, greatest(0.05, (1 - target) * 0.25)) END AS g0 FROM aims
    ), parts AS (
      SELECT *, CASE WHEN kind = 'hierarchical' THEN greatest(0.18, least(0.60, target)) ELSE greatest(0.02, least(0.92, target - share * g0)) END AS c1,
             CASE WHEN kind = 'hierarchical' THEN least(0.45, 0.85 - greatest(0.18, least(0.60, target))) ELSE g0 END AS g1 FROM shares
    ), weights AS (
      SELECT *, CASE WHEN kind = 'hierarchical' THEN 1 - c1 - g1 ELSE greatest(0.04, 1 - c1 - g1) END AS i1 FROM parts
    ), names AS (
      SELECT *, 'common' AS name FROM weights UNION ALL SELECT w.*, 'g' || g FROM weights AS w, range(0, 3) AS r(g) WHERE g < groups UNION ALL SELECT w.*, 's' || i FROM weights AS w, range(0, 6) AS r(i) WHERE i < k
    ), specs AS (
      SELECT scenario, name, n, pattern = 'phase_groups' AND name = 'common' AS plain, CASE WHEN name = 'common' THEN period ELSE greatest(6.0, n / (4 + floor(8 * {_u(*_F, "'period'")}))) END AS p,
             {_b(-1.2, 1.2, *_F, "'rise'")} AS rise, {_u(*_F, "'phase'")} AS phase, CAST(floor({_u(*_F, "'trend'")} * 5) AS INTEGER) AS trend, CAST(floor({_u(*_F, "'wave'")} * 3) AS INTEGER) AS wave FROM names
    ), raw AS (
      SELECT scenario, name, t, plain, t / (n - 1.0) AS x, sin({2 * math.pi} * (t / p + phase)) AS s, rise, trend, wave, {_normal(*_F, 't')} AS e FROM specs, LATERAL (SELECT unnest(range(0, n)) AS t) AS r
    ), signal AS (
      SELECT scenario, name, t, CASE wave WHEN 1 THEN {2 / math.pi} * asin(s) WHEN 2 THEN tanh(3 * s) ELSE s END + CASE WHEN plain THEN 0 ELSE
             rise * CASE trend WHEN 1 THEN x WHEN 2 THEN x * x WHEN 3 THEN tanh(3 * x) WHEN 4 THEN CASE WHEN x < 0.5 THEN x * 0.4 ELSE 0.2 + (x - 0.5) * 1.6 END ELSE 0 END + 0.35 * e END AS v FROM raw
    ), z AS MATERIALIZED (
      SELECT scenario, name, t, (v - avg(v) OVER w) / (stddev_pop(v) OVER w + 1e-8) AS z FROM signal WINDOW w AS (PARTITION BY scenario, name)
    ), series AS (
      SELECT w.*, CAST(i AS INTEGER) AS series, 's' || i AS name, CAST(i % groups AS INTEGER) AS grp, pattern = 'sequence_anomaly' AND i = odd AS is_odd FROM weights AS w, range(0, 6) AS r(i) WHERE i < k
    ), made AS (
      SELECT *, CASE WHEN pattern = 'phase_groups' THEN CAST(round(grp / groups * period) AS INTEGER) ELSE 0 END AS lag,
             CASE WHEN is_odd THEN 0.04 WHEN pattern = 'phase_groups' THEN 0.88 WHEN pattern = 'distribution_mismatch' THEN 0.82 ELSE c1 / (c1 + g1 + i1) END AS wc,
             CASE WHEN is_odd OR pattern IN ('phase_groups', 'distribution_mismatch') THEN 0.0 ELSE g1 / (c1 + g1 + i1) END AS wg,
             CASE WHEN is_odd THEN 0.96 WHEN pattern = 'phase_groups' THEN 0.12 WHEN pattern = 'distribution_mismatch' THEN 0.18 ELSE i1 / (c1 + g1 + i1) END AS wi,
             CASE pattern WHEN 'scaled_groups' THEN 0.60 + 0.28 * series WHEN 'heterogeneous_panel' THEN {_b(.55, 1.75, *_S, "'scale'")} ELSE {_b(.82, 1.22, *_S, "'scale'")} END AS scale,
             CASE pattern WHEN 'scaled_groups' THEN {_b(-2, 2, *_S, "'offset'")} WHEN 'heterogeneous_panel' THEN {_b(-12, 16, *_S, "'offset'")} ELSE {_b(-6, 7, *_S, "'offset'")} END AS off,
             CASE pattern WHEN 'heterogeneous_panel' THEN {_b(8, 19, *_S, "'amplitude'")} ELSE {_b(9, 16, *_S, "'amplitude'")} END AS amp,
             greatest(5, least(16, n // 35)) AS blocks, greatest(12, least(36, n // 12)) AS len, CAST(floor(n * 0.18) AS INTEGER) + 2 * series AS s1, CAST(floor(n * 0.62) AS INTEGER) - series AS s2, {_b(28, 40, *_S, "'motif'")} AS height FROM series
    ), blocks AS (
      SELECT scenario, name, b, b * (n // blocks) + least(b, n % blocks) AS start, n // blocks + (b < n % blocks)::INT AS size, {_u('scenario', '0', 'name', "'block'", 'b')} AS u FROM made, LATERAL (SELECT unnest(range(0, blocks)) AS b) AS r WHERE pattern = 'distribution_mismatch'
    ), shuffled AS (
      SELECT scenario, name, start, size, sum(size) OVER (PARTITION BY scenario, name ORDER BY u, b) - size AS place FROM blocks
    ), places AS (
      SELECT m.scenario, m.name, t, (t - lag + n) % n AS p FROM made AS m, LATERAL (SELECT unnest(range(0, n)) AS t) AS r WHERE pattern <> 'distribution_mismatch'
      UNION ALL SELECT scenario, name, CAST(place + j AS BIGINT), CAST(start + j AS BIGINT) FROM shuffled, LATERAL (SELECT unnest(range(0, size)) AS j) AS r
    ), vals AS MATERIALIZED (
      SELECT m.scenario, m.series, m.pattern, m.grp, m.is_odd, m.n, m.k, m.len, m.s1, p.t, 45 + off + amp * scale * (sqrt(wc) * c.z + sqrt(wg) * g.z + sqrt(wi) * o.z)
             + CASE WHEN pattern = 'motif' THEN list_sum([CASE WHEN p.t >= q AND p.t < q + len AND q + len <= n THEN height * sin({2 * math.pi} * (p.t - q) / (len - 1)) + 0.35 * {_normal('m.scenario', '0', 'm.name', "'motif'", 'p.t')} ELSE 0 END FOR q IN [s1, s2]]) ELSE 0 END
             + CASE WHEN is_odd THEN {_b(5, 12, 'm.scenario', '0', 'm.name', "'wave height'")} * sin({2 * math.pi} * p.t / greatest(4.0, n / {_b(5, 11, 'm.scenario', '0', 'm.name', "'waves'")})) ELSE 0 END
             - CASE WHEN pattern = 'heterogeneous_panel' AND series >= greatest(1, k - 2) THEN {_b(7, 13, 'm.scenario', '0', 'm.name', "'reversal'")} * exp(-0.5 * power((p.t - floor(n * 0.62)) / greatest(8.0, n // 16), 2)) ELSE 0 END AS v
      FROM made AS m JOIN places AS p USING (scenario, name) JOIN z AS c ON c.scenario = m.scenario AND c.name = 'common' AND c.t = p.p JOIN z AS g ON g.scenario = m.scenario AND g.name = 'g' || grp AND g.t = p.t
      JOIN z AS o ON o.scenario = m.scenario AND o.name = m.name AND o.t = p.t
    )"""

ORACLE_SQL = {
    "factor_panels": f"""{_BASE}, summary AS (
      SELECT scenario, series, round(avg(v), 4) AS mean_value, round(stddev_pop(v), 4) AS sd_value, round(arg_max(v, t), 4) AS last_value FROM vals GROUP BY ALL
    )
    SELECT scenario, series, kind, round(target, 4) AS target, grp, lag, round(wc, 4) AS wc, round(wg, 4) AS wg, round(wi, 4) AS wi, mean_value, sd_value, last_value FROM made JOIN summary USING (scenario, series)""",
}
