"""Registered queries over kernels, generators, record sources and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.stats import r6
from tidemark.operators import generators as gn
from tidemark.operators import kernels as kn
from tidemark.operators.text_similarity import text_classes
from tidemark.plans.panel_queries import _FILLED, _filled, _t
from tidemark.shared import shared_path
from tidemark.sources.records import contiguous_prefix, embedded_pairs, first_series
from tidemark.streaming import incremental as st


def near_questions(s: SparkSession, d: str) -> DataFrame:
    """The first line of each document: the class of those with the same one, and its number of links to nearly equal ones."""
    firsts = _t(s, d, "documents").select("doc_id", F.get(F.split("text", "\n"), F.lit(0)).alias("line")).where(F.length("line") >= 20)
    members, links = text_classes(firsts, "doc_id", "line")
    ends = links.select(F.explode(F.array("class_a", "class_b")).alias("class")).groupBy("class").agg(F.count("*").alias("links"))
    return members.join(ends, "class", "left").select("doc_id", "class", F.coalesce("links", F.lit(0)).alias("links"))


def streaming_windows(s: SparkSession, d: str) -> DataFrame:
    stream = st.daily_counts(st.event_stream(s, d))
    target = shared_path(s, "daily")
    st.run_available(stream, target, shared_path(s, "daily-state"), ["day", "event_type"])
    days = F.datediff(F.col("day").cast("timestamp_ntz").cast("date"), F.lit("2024-01-01").cast("date"))
    return s.read.parquet(target).select(days.alias("day"), "event_type", "n", F.round("total", 4).alias("total"))


def incremental_append(s: SparkSession, d: str) -> DataFrame:
    stream = st.event_stream(s, d).select("event_id", "user_id", "event_type")
    target = shared_path(s, "append")
    st.run_available(stream, target, shared_path(s, "append-state"), ["event_id"], "append")
    return s.read.parquet(target).select("event_id", "user_id", "event_type")


def session_rows(s: SparkSession, d: str) -> DataFrame:
    events = _t(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return events.groupBy(F.session_window("ts", "6 hours"), "user_id").agg(F.count("*").alias("n")).groupBy("user_id").agg(F.count("*").alias("sessions"), F.max("n").alias("longest"))


def parsed_props(s: SparkSession, d: str) -> DataFrame:
    props = F.from_json("props", "struct<k:long>")["k"]
    quoted = F.concat(F.lit('"question": "'), F.col("event_type"), F.lit('", "answer": "['), F.col("event_id"), F.lit(", 2.5, 1e1]\""))
    pair = embedded_pairs(quoted)
    rows = _t(s, d, "events").select("event_id", props.alias("k"), pair.alias("p"))
    return rows.select("event_id", "k", F.col("p.question").alias("question"), F.element_at(first_series(F.col("p.answer")), 1).cast("long").alias("first"))


QUERIES = {
    "fft_power": lambda s, d: kn.power_spectrum(_filled(s, d)).where("k > 0").select("series_id", "k", F.round(F.log1p("power"), 4).alias("log_power")),
    "period_estimate": lambda s, d: kn.estimate_period(_filled(s, d)),
    "stl_components": lambda s, d: kn.decompose(_filled(s, d), 24).select("series_id", "t", *[r6(c).alias(c) for c in ("trend", "season", "rest")]),
    "seasonal_strength": lambda s, d: kn.seasonal_strength(kn.decompose(_filled(s, d), 24)),
    "adf_stat": lambda s, d: kn.unit_root(_filled(s, d)),
    "ar_forecast": lambda s, d: kn.forecast_ar(_filled(s, d)),
    "dtw_pairs": lambda s, d: kn.dtw_pairs(_filled(s, d)),
    "lagged_dependence": lambda s, d: kn.granger_f(_filled(s, d)),
    "synthetic_parts": lambda s, d: gn.deterministic_part(s, 21, 48).select("scenario", "series", "t", "trend_kind", "wave_kind", r6("trend").alias("trend"), r6("season").alias("season")),
    "synthetic_panel": lambda s, d: gn.with_noise(gn.deterministic_part(s, 21, 48)),
    "scenario_quality_gate": lambda s, d: gn.gate_attempts(s, 21),
    "inject_defects": lambda s, d: gn.inject_defects(_filled(s, d)).withColumn("value", F.round("value", 6)),
    "question_near_duplicates": near_questions,
    "streaming_windows": streaming_windows,
    "incremental_append": incremental_append,
    "user_sessions": session_rows,
    "parsed_props": parsed_props,
    "contiguous_prefix": lambda s, d: contiguous_prefix(_t(s, d, "labels").select(F.col("doc_id").alias("doc_id")), "doc_id"),
}

_LENGTH = 48
_PARTS = f"""{_FILLED}, n AS (SELECT series_id, t, value, row_number() OVER (PARTITION BY series_id ORDER BY t) - 1 AS i, count(*) OVER (PARTITION BY series_id) AS n FROM filled),
trends AS (SELECT a.series_id, a.t, a.i, any_value(a.value) AS value, sum(b.value) / 25 AS trend FROM n AS a CROSS JOIN range(-12, 13) AS o(o) JOIN n AS b ON b.series_id = a.series_id AND b.i = greatest(0, least(a.n - 1, a.i + o)) GROUP BY a.series_id, a.t, a.i),
phases AS (SELECT series_id, i % 24 AS p, avg(value - trend) AS m FROM trends GROUP BY ALL), centred AS (SELECT series_id, p, m - avg(m) OVER (PARTITION BY series_id) AS season FROM phases),
parts AS (SELECT x.series_id, t, trend, season, value - trend - season AS rest FROM trends AS x JOIN centred AS c ON c.series_id = x.series_id AND c.p = x.i % 24)"""


def _closed(length: int) -> str:
    """SQL of the closed-form parts of 21 scenarios of ``length`` steps."""
    return f"""r AS (SELECT CAST(i // 5 AS INTEGER) AS scenario, CAST(i % 5 AS INTEGER) AS series FROM range(0, 105) AS x(i)),
        k AS (SELECT *, (['none', 'linear', 'quadratic', 'saturating', 'piecewise', 'local_reversal', 'random_walk'])[scenario % 7 + 1] AS trend_kind, (['sine', 'triangle', 'soft_square'])[(scenario + series) % 3 + 1] AS wave_kind, 12 + scenario % 13 AS period FROM r),
        p AS (SELECT *, t / {length - 1} AS x, sin(2 * pi() * (t / period + 0.1 * series)) AS s FROM k, (SELECT CAST(t AS INTEGER) AS t FROM range(0, {length}) AS y(t)) AS y),
        closed AS (SELECT scenario, series, t, trend_kind, wave_kind, CASE trend_kind WHEN 'linear' THEN x WHEN 'quadratic' THEN x * x WHEN 'saturating' THEN tanh(3 * x) WHEN 'piecewise' THEN CASE WHEN x < 0.5 THEN x * 0.4 ELSE 0.2 + (x - 0.5) * 1.6 END
          WHEN 'local_reversal' THEN x - 0.6 * exp(-power((x - 0.6) / 0.08, 2)) ELSE 0 END AS trend, 0.5 * CASE wave_kind WHEN 'triangle' THEN 2 / pi() * asin(s) WHEN 'soft_square' THEN tanh(3 * s) ELSE s END AS season FROM p)"""


_NOISE = """CAST('0x' || substr(sha256('"noise:' || scenario || ':' || series || ':' || attempt || ':' || t || '"'), 1, 12) AS BIGINT) / power(16, 12)"""

ORACLE_SQL = {
    "stl_components": f"WITH {_PARTS} SELECT series_id, t, round(trend, 6) AS trend, round(season, 6) AS season, round(rest, 6) AS rest FROM parts",
    "seasonal_strength": f"WITH {_PARTS} SELECT series_id, round(greatest(0, 1 - var_pop(rest) / var_pop(season + rest)), 4) AS strength FROM parts GROUP BY series_id",
    "period_estimate": f"""WITH {_FILLED}, n AS (SELECT series_id, value, row_number() OVER (PARTITION BY series_id ORDER BY t) - 1 AS i, count(*) OVER (PARTITION BY series_id) AS n FROM filled),
        fit AS (SELECT series_id, regr_slope(value, i) AS m, regr_intercept(value, i) AS c FROM n GROUP BY series_id), v AS (SELECT series_id, i, n, value - (m * i + c) AS x FROM n JOIN fit USING (series_id)),
        d AS (SELECT series_id, k, any_value(n) AS n, power(sum(x * cos(2 * pi() * k * i / n)), 2) + power(sum(x * sin(2 * pi() * k * i / n)), 2) AS p FROM v JOIN range(1, 4000) AS r(k) ON k <= n // 2 AND k / n >= 1 / greatest(4, n / 2) GROUP BY series_id, k),
        b AS (SELECT series_id, n, round_even(n / k, 0) AS g FROM d QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY p DESC, k) = 1) SELECT series_id, CAST(n AS INTEGER) AS n, CAST(CASE WHEN g BETWEEN 2 AND n // 2 THEN g END AS INTEGER) AS period FROM b""",
    "scenario_quality_gate": f"""WITH {_closed(96)}, v AS (SELECT scenario, series, attempt, t, trend + season + 0.6 * ({_NOISE} - 0.5) AS v FROM closed, range(0, 4) AS a(attempt)),
        pairs AS (SELECT a.scenario, a.attempt, a.series AS s1, b.series AS s2, corr(a.v, b.v) AS r FROM v AS a JOIN v AS b ON a.scenario = b.scenario AND a.attempt = b.attempt AND a.t = b.t AND a.series < b.series GROUP BY ALL),
        m AS (SELECT scenario, attempt, round(avg(r), 4) AS mean_r FROM pairs GROUP BY ALL)
        SELECT scenario, count(*) AS attempts, CAST(min(attempt) FILTER (mean_r >= 0.2) AS INTEGER) AS attempt, (list(mean_r ORDER BY attempt) FILTER (mean_r >= 0.2))[1] AS mean_r FROM m GROUP BY scenario""",
    "synthetic_parts": f"WITH {_closed(_LENGTH)} SELECT scenario, series, t, trend_kind, wave_kind, round(trend, 6) AS trend, round(season, 6) AS season FROM closed",
    "fft_power": f"""WITH {_FILLED}, v AS (SELECT series_id, t - min(t) OVER p AS i, value - avg(value) OVER p AS x, count(*) OVER p AS n FROM filled WINDOW p AS (PARTITION BY series_id)),
        d AS (SELECT series_id, k, sum(x * cos(2 * pi() * k * i / n)) AS re, sum(x * sin(2 * pi() * k * i / n)) AS im FROM v JOIN range(1, 4000) AS r(k) ON k <= n // 2 GROUP BY series_id, k)
        SELECT series_id, CAST(k AS INTEGER) AS k, round(ln(1 + round(re * re + im * im, 3)), 4) AS log_power FROM d""",
    "inject_defects": f"""WITH {_FILLED}, n AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY t) AS n, count(*) OVER (PARTITION BY series_id) AS c FROM filled),
        k AS (SELECT *, CASE WHEN n BETWEEN 20 AND 24 THEN 'gap' WHEN n % 40 = 7 THEN 'spike' WHEN 10 * n > 7 * c THEN 'shift' ELSE 'none' END AS kind FROM n)
        SELECT series_id, t, kind, round(CASE kind WHEN 'gap' THEN NULL WHEN 'spike' THEN value * 3 WHEN 'shift' THEN value + 10 ELSE value END, 6) AS value FROM k""",
    "streaming_windows": "SELECT CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL",
    "incremental_append": "SELECT event_id, user_id, event_type FROM events",
    "user_sessions": """WITH g AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 6 HOURS THEN 0 ELSE 1 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
        n AS (SELECT user_id, sum(s) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g), c AS (SELECT user_id, k, count(*) AS n FROM n GROUP BY ALL) SELECT user_id, count(*) AS sessions, max(n) AS longest FROM c GROUP BY user_id""",
    "parsed_props": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type AS question, event_id AS first FROM events",
    "contiguous_prefix": "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS n FROM labels WHERE doc_id >= 1) AS x WHERE doc_id = n",
}
