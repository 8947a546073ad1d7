"""Robust decomposition and ARIMA against plain versions and known processes."""

from __future__ import annotations

import numpy as np
import pytest

from tidemark.operators import arima
from tidemark.operators.arima import arima_forecast
from tidemark.operators.stl import loess, robust_components, stl


def plain_loess(y, q, weights, x):
    """One local line, point by point."""
    n = len(y)
    near = sorted(range(n), key=lambda j: abs(j - x))[: min(q, n)]
    reach = max(abs(j - x) for j in near) + max(0, q - n) // 2
    w = np.array([(1 - (abs(j - x) / reach) ** 3) ** 3 if abs(j - x) <= 0.999 * reach else 0.0 for j in near]) * weights[near]
    a = np.vstack([np.ones(len(near)), np.array(near, float)])
    beta = np.linalg.solve(a * w @ a.T, a * w @ y[near])
    return beta[0] + beta[1] * x


def test_local_lines_equal_plain_ones():
    rng = np.random.default_rng(2)
    y, weights = rng.normal(size=60), rng.uniform(0.2, 1, 60)
    for q in (7, 13, 101):
        got = loess(y, q, weights)
        assert got == pytest.approx([plain_loess(y, q, weights, x) for x in range(60)], abs=1e-9)
    line = 3 + 0.5 * np.arange(30)
    assert loess(line, 7, np.ones(30), np.arange(-1, 31)) == pytest.approx(3 + 0.5 * np.arange(-1, 31))


def test_parts_come_back_in_spite_of_outliers():
    rng = np.random.default_rng(5)
    t = np.arange(240)
    trend, season = 0.05 * t + 3 * np.sin(t / 80), 4 * np.sin(2 * np.pi * t / 12)
    v = trend + season + 0.2 * rng.normal(size=240)
    spikes = rng.choice(240, 12, replace=False)
    v[spikes] += 40
    got = {r: stl(v, 12, robust=r) for r in (True, False)}
    for parts in got.values():
        assert sum(parts[:3]) == pytest.approx(v)
    error = {r: np.abs(p[0] + p[1] - trend - season).max() for r, p in got.items()}
    assert error[True] < 1.0 < 3 < error[False]
    assert (got[True][3][spikes] == 0).all() and np.median(got[True][3]) > 0.8
    assert stl(season + trend, 12)[1] == pytest.approx(season, abs=0.25)


def test_components_of_a_table(spark):
    rows = [(s, k, float(np.sin(k) * 3 + k % 6 + (50 if (s, k) == ("a", 31) else 0))) for s in "ab" for k in range(60)] + [("c", k, 1.0) for k in range(5)]
    got = robust_components(spark.createDataFrame(rows, "series_id string, t int, value double"), 6).collect()
    by = {(r.series_id, r.t): r for r in got}
    assert len(by) == len(rows)
    assert all(by[s, t].trend + by[s, t].season + by[s, t].rest == pytest.approx(v) for s, t, v in rows if s != "c")
    assert by["a", 31].weight == 0 and by["c", 2].trend is None
    assert sum(abs(by["a", t].trend - by["b", t].trend) for t in range(60)) / 60 < 1.0


def simulated(rng, ar, ma, n):
    e = rng.normal(size=n + 200)
    y = np.zeros(n + 200)
    for t in range(3, n + 200):
        y[t] = sum(a * y[t - 1 - i] for i, a in enumerate(ar)) + e[t] + sum(m * e[t - 1 - i] for i, m in enumerate(ma))
    return y[200:]


def plain_likelihood(y, ar, ma):
    """-2 log likelihood from the whole covariance matrix, shock variance put in."""
    n, reply = len(y), [1.0]
    for k in range(1, 600):
        reply.append((ma[k - 1] if k <= len(ma) else 0) + sum(a * reply[k - 1 - i] for i, a in enumerate(ar) if k - 1 - i >= 0))
    reply = np.array(reply)
    cov = np.array([reply[: 600 - k] @ reply[k:] for k in range(n)])
    whole = cov[np.abs(np.subtract.outer(np.arange(n), np.arange(n)))]
    squares = y @ np.linalg.solve(whole, y)
    return n * np.log(2 * np.pi * squares / n) + n + np.linalg.slogdet(whole)[1]


@pytest.mark.parametrize(("ar", "ma"), [([0.6], [0.4]), ([0.5, -0.3], []), ([], [0.7, 0.2]), ([0.2], [-0.5])])
def test_the_filter_gives_the_exact_likelihood(ar, ma):
    y = simulated(np.random.default_rng(1), ar, ma, 80)
    assert arima.filtered(y, np.array(ar), np.array(ma))[0] == pytest.approx(plain_likelihood(y, ar, ma), rel=1e-7)


def test_a_fit_finds_the_coefficients_and_no_better_point_is_near():
    y = simulated(np.random.default_rng(3), [0.6], [0.4], 600)
    model = arima.fit(np.cumsum(y), (1, 1, 1))
    assert model.ar[0] == pytest.approx(0.6, abs=0.1) and model.ma[0] == pytest.approx(0.4, abs=0.12) and model.variance == pytest.approx(1, abs=0.15)
    w = np.diff(np.cumsum(y)) - model.mean
    least = arima.filtered(w, model.ar, model.ma)[0]
    assert all(arima.filtered(w, model.ar + a, model.ma + m)[0] >= least - 1e-3 for a in (-0.02, 0, 0.02) for m in (-0.02, 0, 0.02))


def test_forecasts_follow_the_process():
    y = simulated(np.random.default_rng(4), [0.8], [], 300)
    model = arima.Arima((1, 0, 0), np.array([0.8]), np.zeros(0), 0.0, 1.0, 0.0)
    values, errors = arima.forecast(y, model, 3)
    assert values == pytest.approx([y[-1] * 0.8**k for k in (1, 2, 3)])
    assert errors == pytest.approx(np.sqrt([1, 1 + 0.64, 1 + 0.64 + 0.64**2]))
    walk = arima.Arima((0, 1, 0), np.zeros(0), np.zeros(0), 0.5, 4.0, 0.0)
    values, errors = arima.forecast(np.array([1.0, 2.0, 5.0]), walk, 2)
    assert values == pytest.approx([5.5, 6.0]) and errors == pytest.approx([2, 2 * np.sqrt(2)])


def test_a_table_of_series(spark):
    y = simulated(np.random.default_rng(6), [0.7], [], 150)
    rows = [("a", k, float(v)) for k, v in enumerate(y)] + [("b", k, 2.0) for k in range(40)] + [("c", 0, 1.5)]
    got = arima_forecast(spark.createDataFrame(rows, "series_id string, t int, value double"), [(1, 0, 0), (0, 0, 1), (0, 0, 0)], 4).collect()
    by = {(r.series_id, r.step): r for r in got}
    assert len(got) == 12
    assert (by["a", 1].p, by["a", 1].d, by["a", 1].q) == (1, 0, 0)
    assert [by["b", k].value for k in (1, 4)] == [2.0, 2.0] and by["b", 1].p is None and by["c", 2].value == 1.5
    assert by["a", 1].error < by["a", 4].error
