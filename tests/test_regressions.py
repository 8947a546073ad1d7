"""Regressions on series against plain versions by normal equations: unit roots, autoregressions, dependence on another's past."""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pytest

from tidemark.operators import kernels as kn
from tidemark.plans.kernel_queries import QUERIES
from tidemark.plans.panel_queries import _filled


def solved(rows: list[list[float]], y: list[float]) -> tuple[list[float], float, list[list[float]]]:
    """Coefficients, sum of squares and inverse of the normal equations, by elimination in exact fractions."""
    x = [[Fraction(v) for v in r] for r in rows]
    t = [Fraction(v) for v in y]
    k = len(x[0])
    m = [[sum(r[i] * r[j] for r in x) for j in range(k)] + [Fraction(int(i == j)) for j in range(k)] + [sum(r[i] * v for r, v in zip(x, t, strict=True))] for i in range(k)]
    for i in range(k):
        p = next(j for j in range(i, k) if m[j][i])
        m[i], m[p] = m[p], m[i]
        m[i] = [v / m[i][i] for v in m[i]]
        for j in range(k):
            if j != i:
                m[j] = [a - m[j][i] * b for a, b in zip(m[j], m[i], strict=True)]
    beta = [r[-1] for r in m]
    squares = sum((v - sum(b * c for b, c in zip(beta, r, strict=True))) ** 2 for r, v in zip(x, t, strict=True))
    return [float(b) for b in beta], float(squares), [[float(v) for v in r[k:-1]] for r in m]


@pytest.fixture(scope="module")
def panel(spark):
    r = np.random.default_rng(5)
    walk, calm, near = np.cumsum(r.integers(-3, 4, 60)), r.integers(-9, 10, 60), r.integers(-5, 6, 60)
    near[1:] += 2 * calm[:-1]
    series = {"walk": walk, "calm": calm, "near": near, "short": calm[:9], "level": np.full(60, 4)}
    rows = [(k, t, float(v)) for k, s in series.items() for t, v in enumerate(s)]
    return spark.createDataFrame(rows, "series_id string, t int, value double"), {k: [float(v) for v in s] for k, s in series.items()}


def plain_unit_root(v: list[float], lags: int = 2) -> float:
    d = [b - a for a, b in zip(v, v[1:], strict=False)]
    rows = [[1.0, v[i], *[d[i - k] for k in range(1, lags + 1)]] for i in range(lags, len(d))]
    beta, squares, inverse = solved(rows, d[lags:])
    return beta[1] / (inverse[1][1] * squares / (len(rows) - len(rows[0]))) ** 0.5


def test_unit_roots(panel):
    df, series = panel
    got = {r.series_id: r for r in kn.unit_root(df).collect()}
    for name in ("walk", "calm", "near"):
        assert got[name].stat == pytest.approx(plain_unit_root(series[name]), rel=1e-6)
    assert got["calm"].stationary and got["short"].stat is None and got["level"].stat is None


def test_autoregressions(panel):
    df, series = panel
    got = {}
    for r in kn.forecast_ar(df, 3, 5).orderBy("step").collect():
        got.setdefault(r.series_id, []).append(r.value)
    for name in ("walk", "calm", "near"):
        mean = sum(series[name]) / 60
        past = [v - mean for v in series[name]]
        beta, _, _ = solved([[past[i - k] for k in range(1, 4)] for i in range(3, 60)], past[3:])
        for _ in range(5):
            past.append(sum(b * past[-k] for k, b in enumerate(beta, 1)))
        assert got[name] == pytest.approx([v + mean for v in past[-5:]], rel=1e-6, abs=1e-6)
    assert got["level"] == pytest.approx([4.0] * 5)


def test_dependence_on_another_past(panel):
    df, series = panel
    got = {(r.a, r.b): r.f for r in kn.granger_f(df.where("series_id IN ('walk', 'calm', 'near')"), 3).collect()}
    assert len(got) == 6
    for (a, b), f in got.items():
        p, q = series[a], series[b]
        own = [[1.0, *[q[i - k] for k in range(1, 4)]] for i in range(3, 60)]
        both = [r + [p[i - k] for k in range(1, 4)] for i, r in zip(range(3, 60), own, strict=True)]
        _, r0, _ = solved(own, q[3:])
        _, r1, _ = solved(both, q[3:])
        assert f == pytest.approx((r0 - r1) / 3 / (r1 / (57 - 7)), rel=1e-5, abs=1e-5)
    assert got["calm", "near"] == max(got.values())


def test_the_query_on_the_tables(spark, sf):
    series = {}
    for r in _filled(spark, sf).orderBy("series_id", "t").collect():
        series.setdefault(r.series_id, []).append(r.value)
    got = {r.series_id: r.stat for r in QUERIES["adf_stat"](spark, sf).collect()}
    assert set(got) == set(series)
    name = min(series)
    assert got[name] == pytest.approx(plain_unit_root(series[name]), rel=1e-6)
