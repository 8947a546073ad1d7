"""Queries on clusters of series, repeated stretches and generation that goes on, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import clusters as cl
from tidemark.operators import factor_panels as fp
from tidemark.operators import motifs as mo
from tidemark.plans.panel_queries import _FILLED, _filled, _t
from tidemark.plans.panel_synthesis_queries import _PATTERNS, _TYPES, scenarios
from tidemark.shared import numbered, shared_path
from tidemark.sources.resumable import Store, generate

#: r from which nations are linked, points of a window, and when the first of two runs saw the events.
_LINK, _WINDOW, _UNTIL = 0.25, 24, "2024-01-25"


def nation_pairs(s: SparkSession, d: str) -> DataFrame:
    """r of the monthly order totals of each pair of nations, over the months that both have."""
    orders = _t(s, d, "orders").join(_t(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(_t(s, d, "nation").select("n_nationkey", "n_name")), F.col("c_nationkey") == F.col("n_nationkey"))
    months = orders.groupBy("n_name", F.date_format("o_orderdate", "yyyy-MM").alias("m")).agg(F.sum(F.col("o_totalprice").cast("double")).alias("v"))
    a, b = (months.select(F.col("n_name").alias(n), "m", F.col("v").alias(f"v{n}")) for n in "ab")
    r = F.try_divide(F.covar_pop("va", "vb"), F.stddev_pop("va") * F.stddev_pop("vb"))
    return a.join(b, "m").where("a < b").groupBy("a", "b").agg(F.round(r, 6).alias("raw_r"))


def series_clusters(s: SparkSession, d: str) -> DataFrame:
    return cl.series_clusters(nation_pairs(s, d), threshold=_LINK)


def global_or_local(s: SparkSession, d: str) -> DataFrame:
    return cl.global_or_local(series_clusters(s, d))


def motif_windows(s: SparkSession, d: str) -> DataFrame:
    found = mo.motifs_and_discords(mo.matrix_profile(_filled(s, d), _WINDOW))
    return found.select("series_id", "windows", "motif_distance", "discord_distance", "mean_distance")


def resumed_panels(s: SparkSession, d: str) -> DataFrame:
    """Panels made from a part of the events and then again from all: why each was made again, and how many series it has."""
    store = Store(s, shared_path(s, "panels"))

    def make(rows: DataFrame) -> DataFrame:
        panel = fp.synthesize(fp.relation_profile(rows).withColumn("attempt", F.lit(0)))
        return panel.groupBy("scenario").agg(F.count("*").cast("int").alias("series"), F.round(F.sum(F.aggregate("values", F.lit(0.0), lambda a, v: a + v)), 4).alias("total"))

    plan = None
    for until in (_UNTIL, "9999-01-01"):
        specs = numbered(scenarios(s, d, until), "scenario", name="nth")
        plan = generate(specs, make, store, "1", id="scenario", place="nth")
    return plan.join(store.read().select("id", "series"), "id").select(F.col("id").alias("scenario"), "place", F.coalesce("reason", F.lit("kept")).alias("reason"), "series")


QUERIES = {"series_clusters": series_clusters, "global_or_local": global_or_local, "motif_windows": motif_windows, "resumed_panels": resumed_panels}

_CLUSTERS = f"""WITH RECURSIVE months AS (
      SELECT n_name, strftime(o_orderdate, '%Y-%m') AS m, sum(CAST(o_totalprice AS DOUBLE)) AS v FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL
    ), pairs AS (
      SELECT a.n_name AS a, b.n_name AS b, round(CASE WHEN stddev_pop(a.v) * stddev_pop(b.v) > 0 THEN covar_pop(a.v, b.v) / (stddev_pop(a.v) * stddev_pop(b.v)) END, 6) AS r FROM months AS a JOIN months AS b ON a.m = b.m AND a.n_name < b.n_name GROUP BY ALL
    ), sides AS (
      SELECT a, b, r FROM pairs UNION ALL SELECT b, a, r FROM pairs
    ), reach(node, root) AS (
      SELECT DISTINCT a, a FROM sides UNION SELECT s.b, x.root FROM reach AS x JOIN sides AS s ON s.a = x.node WHERE s.r >= {_LINK}
    ), own AS (
      SELECT node, min(root) AS cluster FROM reach GROUP BY node
    ), sums AS (
      SELECT o.node, o.cluster, round(coalesce(sum(1 - coalesce(s.r, 0)) FILTER (p.node IS NOT NULL), 0), 9) AS far FROM own AS o LEFT JOIN sides AS s ON s.a = o.node LEFT JOIN own AS p ON p.node = s.b AND p.cluster = o.cluster GROUP BY ALL
    ), clusters AS (
      SELECT node AS series_id, cluster, CAST(count(*) OVER c AS INTEGER) AS size, first_value(node) OVER (PARTITION BY cluster ORDER BY far, node) AS medoid,
             round(CASE WHEN count(*) OVER c > 1 THEN far / (count(*) OVER c - 1) ELSE 0 END, 6) AS mean_distance FROM sums WINDOW c AS (PARTITION BY cluster)
    )"""


def _specs(name: str, until: str) -> str:
    return f"""{name}_counts AS (
      SELECT user_id, event_type, count(*) AS c FROM events WHERE ts < TIMESTAMP '{until}' GROUP BY ALL
    ), {name}_users AS (
      SELECT user_id, sum(c) AS n_all, count(*) AS kinds, arg_min(event_type, {{'c': -c, 'e': event_type}}) AS e FROM {name}_counts GROUP BY user_id
    ), {name} AS (
      SELECT 'u' || user_id AS scenario, ({_PATTERNS!r})[2 * (list_position({_TYPES!r}, e) - 1) + CAST(n_all % 2 AS BIGINT) + 1] AS pattern, CAST(greatest(60, n_all) AS INTEGER) AS n, CAST(kinds + 1 AS INTEGER) AS k FROM {name}_users
    )"""


ORACLE_SQL = {
    "series_clusters": f"{_CLUSTERS} SELECT * FROM clusters",
    "global_or_local": f"""{_CLUSTERS}, sizes AS (SELECT cluster, count(*) AS n, sum(mean_distance) AS d FROM clusters GROUP BY cluster),
        whole AS (SELECT count(*) AS clusters, CAST(sum(n) AS BIGINT) AS series, max(n) AS largest, coalesce(sum(n) FILTER (n > 1), 0) AS grouped, sum(d) AS d FROM sizes)
        SELECT clusters, series, round(largest / series, 4) AS largest_share, round(d / series, 6) AS mean_distance, CASE WHEN largest >= 0.9 * series THEN 'global' WHEN grouped >= 0.5 * series THEN 'by_cluster' ELSE 'local' END AS advice FROM whole""",
    "motif_windows": f"""WITH {_FILLED}, arrays AS (SELECT series_id, list(value ORDER BY t) AS v FROM filled GROUP BY series_id),
        windows AS (SELECT series_id, i, v[i:i + {_WINDOW - 1}] AS w FROM arrays, LATERAL (SELECT unnest(range(1, len(v) - {_WINDOW - 2})) AS i) AS r),
        z AS MATERIALIZED (SELECT series_id, i, CASE WHEN list_max(w) - list_min(w) >= 1e-8 THEN list_transform(w, lambda x: (x - list_avg(w)) / list_stddev_pop(w)) END AS w FROM windows),
        near AS (SELECT a.series_id, a.i, sqrt(min(CASE WHEN a.w IS NULL AND b.w IS NULL THEN 0 WHEN a.w IS NULL OR b.w IS NULL THEN {_WINDOW} ELSE greatest(0, 2 * ({_WINDOW} - list_inner_product(a.w, b.w))) END)) AS d
          FROM z AS a JOIN z AS b ON a.series_id = b.series_id AND abs(a.i - b.i) >= {_WINDOW // 2} GROUP BY ALL)
        SELECT series_id, count(*) AS windows, round(min(d), 4) AS motif_distance, round(max(d), 4) AS discord_distance, round(avg(d), 4) AS mean_distance FROM near GROUP BY series_id""",
    "resumed_panels": f"""WITH {_specs('old', _UNTIL)}, {_specs('new', '9999-01-01')}
        SELECT scenario, row_number() OVER (ORDER BY scenario) - 1 AS place, CASE WHEN o.scenario IS NULL THEN 'new' WHEN o.pattern = n.pattern AND o.n = n.n AND o.k = n.k THEN 'kept' ELSE 'changed' END AS reason, n.k AS series
        FROM new AS n LEFT JOIN old AS o USING (scenario)""",
}
