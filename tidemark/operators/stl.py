"""Seasonal-trend decomposition by local regressions, with robustness weights (Cleveland et al., 1990)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import ship_package

#: Passes with and without robustness weights.
INNER, OUTER, PLAIN_INNER = 2, 15, 5


def loess(y: np.ndarray, q: int, weights: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
    """Local lines over the ``q`` nearest of the points 0, 1, ... at ``at`` (those points by default).

    Weights are tricube in the distance, times ``weights``; with ``q`` above the number of points the reach
    widens by half of what is missing.  A place whose weights vanish takes the nearest value.
    """
    n = len(y)
    x = np.arange(n, dtype=float) if at is None else np.asarray(at, dtype=float)
    width = min(q, n)
    left = np.clip(np.floor(x).astype(int) - (width - 1) // 2, 0, n - width)
    index = left[:, None] + np.arange(width)
    away = np.abs(index - x[:, None])
    reach = np.maximum(x - left, left + width - 1 - x) + max(0, q - n) // 2
    reach = np.maximum(reach, 1e-12)[:, None]
    w = np.where(away <= 0.999 * reach, np.where(away <= 0.001 * reach, 1.0, (1 - np.minimum(away / reach, 1) ** 3) ** 3), 0.0) * weights[index]
    total = w.sum(1, keepdims=True)
    dead = total[:, 0] <= 0
    w = w / np.where(total > 0, total, 1)
    mean = (w * index).sum(1, keepdims=True)
    spread = (w * (index - mean) ** 2).sum(1, keepdims=True)
    lean = np.sqrt(spread) > 0.001 * max(1, n - 1)
    w = np.where(lean, w * (1 + (x[:, None] - mean) * (index - mean) / np.where(lean, spread, 1)), w)
    fitted = (w * y[index]).sum(1)
    return np.where(dead, y[np.clip(np.rint(x).astype(int), 0, n - 1)], fitted)


def _moving(v: np.ndarray, k: int) -> np.ndarray:
    run = np.cumsum(np.concatenate([[0.0], v]))
    return (run[k:] - run[:-k]) / k


def _odd(n: float) -> int:
    k = int(np.ceil(n))
    return k + 1 - k % 2


def stl(v: np.ndarray, period: int, *, seasonal: int = 7, robust: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(trend, season, rest, weights) of a series of two periods or more; trend, season and rest add up to it.

    The inner loop smooths each phase's values over the periods, takes from that what is slower than a period,
    and smooths what is left of the series as its trend.  The outer loop weighs points down by the size of their rest.
    """
    n = len(v)
    low, slow = _odd(period + 1), _odd(1.5 * period / (1 - 1.5 / seasonal))
    weights, trend, season = np.ones(n), np.zeros(n), np.zeros(n)
    for outer in range(OUTER + 1 if robust else 1):
        for _ in range(INNER if robust else PLAIN_INNER):
            flat = v - trend
            wide = np.empty(n + 2 * period)
            for phase in range(period):
                own = flat[phase::period]
                wide[phase::period] = loess(own, seasonal, weights[phase::period], np.arange(-1, len(own) + 1))
            drift = loess(_moving(_moving(_moving(wide, period), period), 3), low, np.ones(n))
            season = wide[period : period + n] - drift
            trend = loess(v - season, slow, weights)
        rest = v - trend - season
        if not robust or outer == OUTER:
            break
        size = np.abs(rest)
        limit = 6 * np.median(size)
        if limit <= 0:
            break
        u = size / limit
        weights = np.where(u <= 0.001, 1.0, np.where(u <= 0.999, (1 - np.minimum(u, 1) ** 2) ** 2, 0.0))
    return trend, season, rest, weights


def robust_components(filled: DataFrame, period: int, *, seasonal: int = 7, robust: bool = True) -> DataFrame:
    """series_id, t, trend, season, rest and weight (0: an outlier to the fit) of regular series without gaps.

    One series is one piece of work, bounded by the time axis.  Series shorter than two periods have null parts.
    """
    ship_package(filled.sparkSession)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("t")
        v = pdf["value"].to_numpy("float64")
        parts = stl(v, period, seasonal=seasonal, robust=robust) if len(v) >= 2 * period else [np.full(len(v), np.nan)] * 4
        return pd.DataFrame({"series_id": pdf.series_id, "t": pdf.t, **dict(zip(("trend", "season", "rest", "weight"), parts, strict=True))})

    made = filled.groupBy("series_id").applyInPandas(run, "series_id string, t int, trend double, season double, rest double, weight double")
    return made.select("series_id", "t", *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in ("trend", "season", "rest", "weight")])
