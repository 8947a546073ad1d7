"""Factor panels: parts of a series, relations against numpy, the gate, and the same panel at every run."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import factor_panels as fp

PATTERNS = [*fp.KINDS, "multi_period"]


@pytest.fixture(scope="module")
def scenarios(spark):
    rows = [(f"{p}-{k}", p, 120 + 7 * k, 4 + k % 2, 12.0 + k, 1) for p in PATTERNS for k in range(3)]
    return spark.createDataFrame(rows, "scenario string, pattern string, n int, k int, period double, odd int")


@pytest.fixture(scope="module")
def panel(scenarios):
    return fp.synthesize(fp.relation_profile(scenarios).withColumn("attempt", F.lit(0))).cache()


@pytest.fixture(scope="module")
def series(panel):
    return {(r.scenario, r.series): r for r in panel.collect()}


def test_shares_of_variance_and_profiles(series):
    for r in series.values():
        assert r.wc + r.wg + r.wi == pytest.approx(1)
        assert max(r.low, 0) <= r.target <= r.high
        assert len(r["values"]) == r.n and np.isfinite(r["values"]).all()
        assert r.grp == r.series % (3 if r.pattern == "phase_groups" else 2)
    assert {r.tier for r in series.values() if r.pattern == "multi_period"} <= set(fp.BANDS)


def test_a_panel_is_the_same_at_every_run(scenarios, series):
    again = fp.synthesize(fp.relation_profile(scenarios.repartition(5)).withColumn("attempt", F.lit(0)))
    assert {(r.scenario, r.series): r for r in again.collect()} == series
    other = fp.synthesize(fp.relation_profile(scenarios).withColumn("attempt", F.lit(1))).first()
    assert other["values"] != series[other.scenario, other.series]["values"]


def test_phase_groups_roll_the_common_factor(series):
    for k in range(3):
        own = [series[f"phase_groups-{k}", i] for i in range(3)]
        assert [r.lag for r in own] == [round(i / 3 * (12 + k)) for i in range(3)]
        z = [np.array(r["values"]) for r in own]
        assert np.corrcoef(np.roll(z[0], own[1].lag), z[1])[0, 1] > 0.7 > np.corrcoef(z[0], z[1])[0, 1]


def test_blocks_are_reordered_whole(spark):
    rows = spark.createDataFrame([("a", n) for n in (20, 37, 200, 700)], "s string, n int")
    for r in rows.select("n", fp._shuffled_blocks(F.col("n"), F.col("s")).alias("p")).collect():
        assert sorted(r.p) == list(range(r.n))
        blocks = max(5, min(16, r.n // 35))
        assert sum(b != a + 1 for a, b in zip(r.p, r.p[1:], strict=False)) <= blocks - 1
        assert r.p != sorted(r.p)


def test_metrics_equal_numpy(panel, series):
    for m in fp.panel_metrics(panel).collect():
        own = [series[m.scenario, i] for i in range(m.k)]
        v = [np.array(r["values"]) for r in own]
        pairs = [(a, b) for a in range(m.k) for b in range(a + 1, m.k)]
        r = {p: np.corrcoef(v[p[0]], v[p[1]])[0, 1] for p in pairs}
        same = lambda p: own[p[0]].grp == own[p[1]].grp
        assert m.mean_r == pytest.approx(np.mean(list(r.values())))
        assert m.within_r == pytest.approx(np.mean([r[p] for p in pairs if same(p)]))
        assert m.between_r == pytest.approx(np.mean([r[p] for p in pairs if not same(p)]))
        assert m.all_above == (min(r.values()) > 0.9)
        if m.pattern == "phase_groups":
            reach = min(60, max(3, m.n // 6))
            lagged = lambda x, y, g: np.corrcoef(x[g:], y[: len(y) - g])[0, 1] if g >= 0 else np.corrcoef(x[:g], y[-g:])[0, 1]
            assert m.best_lag_r == pytest.approx(np.mean([max(lagged(v[0], v[b], g) for g in range(-reach, reach + 1)) for b in range(1, m.k)]))
        if m.pattern == "distribution_mismatch":
            assert m.distance == pytest.approx(np.mean([np.abs(np.sort(v[0]) - np.sort(w)).mean() / (np.concatenate([v[0], w]).std(ddof=1) + 1e-8) for w in v[1:]]))
        if m.pattern == "motif":
            cut = lambda i, m=m, own=own, v=v: v[i][own[i].motif_starts[0] : own[i].motif_starts[0] + m.motif_length]
            assert m.motif_r == pytest.approx(np.mean([np.corrcoef(cut(0), cut(b))[0, 1] for b in range(1, m.k)]))
        if m.pattern == "sequence_anomaly":
            assert m.odd_r == pytest.approx(np.mean([r[p] for p in pairs if 1 in p]))
            assert m.normal_r == pytest.approx(np.mean([r[p] for p in pairs if 1 not in p]))


def test_the_gate_keeps_panels_that_hold(scenarios):
    panels, verdicts = fp.gated_panels(scenarios, attempts=6)
    told = {v.scenario: v for v in verdicts.collect()}
    assert len(told) == scenarios.count()
    kept = {r.scenario for r in panels.select("scenario").distinct().collect()}
    assert kept == {s for s, v in told.items() if not v.reasons}
    assert len(kept) >= 0.6 * len(told)
    assert all(v.attempts == 6 for v in told.values() if v.reasons)
    judged = fp.panel_metrics(panels).withColumn("reasons", fp.relation_reasons())
    assert judged.where("size(reasons) > 0").count() == 0


def test_no_series_and_one_series(spark):
    rows = spark.createDataFrame([("a", "motif", 60, 0, 9.0, 0), ("b", "motif", 60, 1, 9.0, 0)], "scenario string, pattern string, n int, k int, period double, odd int")
    panels, verdicts = fp.gated_panels(rows)
    assert [(r.scenario, r.series) for r in panels.collect()] == [("b", 0)]
    assert [(v.scenario, v.reasons) for v in verdicts.collect()] == [("b", "")]


def test_query_equals_sql(spark, sf):
    from oracle import connection, same

    from tidemark.plans.panel_synthesis_queries import ORACLE_SQL, QUERIES

    same(QUERIES["factor_panels"](spark, sf), connection(sf), ORACLE_SQL["factor_panels"])


def test_gated_queries_agree(spark, sf):
    from tidemark.plans.panel_synthesis_queries import QUERIES

    first = {r.scenario: r for r in QUERIES["panel_gate"](spark, sf).collect()}
    rows = QUERIES["gated_panels"](spark, sf).collect()
    assert {r.scenario for r in rows} == set(first)
    assert all((r.attempts == 1) == (first[r.scenario].reasons == "") for r in rows)
    assert all((r.series > 0) == (r.reasons == "") for r in rows)
    assert sum(r.reasons == "" for r in rows) >= 0.8 * len(rows)


def test_scenarios_are_dealt_over_tasks(spark):
    """Scenarios that come in one task are made and judged in as many as there are shuffle partitions."""
    rows = [(f"u{i}", "motif", 60, 3, 7.5, 0, 0) for i in range(40)]
    one = fp.relation_profile(spark.createDataFrame(rows, "scenario string, pattern string, n int, k int, period double, odd int, attempt int").coalesce(1))
    where = fp.synthesize(one).select(F.spark_partition_id().alias("p")).distinct().count()
    assert where == int(spark.conf.get("spark.sql.shuffle.partitions"))
