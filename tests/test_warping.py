"""Warping distances against the plain recursion over all paths."""

from __future__ import annotations

import numpy as np
import pytest

from tidemark.operators import kernels
from tidemark.plans.kernel_queries import QUERIES
from tidemark.plans.panel_queries import _filled


def _plain(a, b, band=None):
    last = [0.0] + [np.inf] * len(b)
    for i, x in enumerate(a, 1):
        now = [np.inf]
        for j, y in enumerate(b, 1):
            ok = band is None or abs(i - j) <= max(band, abs(len(a) - len(b)))
            now.append(abs(x - y) + min(last[j], now[-1], last[j - 1]) if ok else np.inf)
        last = now
    return last[-1]


@pytest.mark.parametrize("band", [None, 0, 1, 5, 24])
def test_band_only_if_asked_for(band):
    r = np.random.default_rng(3)
    for n, m in [(1, 1), (1, 9), (40, 40), (60, 31), (31, 60), (97, 98)]:
        a, b = r.standard_normal(n), r.standard_normal(m)
        assert abs(kernels.dtw(a, b, band) - _plain(a, b, band)) < 1e-9


def test_query_against_the_plain_recursion(spark, sf):
    series = {}
    for x in sorted(_filled(spark, sf).collect(), key=lambda x: x.t):
        series.setdefault(x.series_id, []).append(x.value)
    z = {k: ((np.array(v) - np.mean(v)) / (np.std(v) + 1e-8)).tolist() for k, v in series.items()}
    got = {(x.a, x.b): x.dtw for x in QUERIES["dtw_pairs"](spark, sf).collect()}
    assert set(got) == {(a, b) for a in z for b in z if a < b}
    for a, b in got:
        assert abs(got[a, b] - _plain(z[a], z[b])) < 1e-5
