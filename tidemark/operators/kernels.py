"""Per-series kernels that a relational plan can't express: spectra, decompositions, recursions, alignment.

Each is a grouped map over one series (or pair) of a regular panel, which is as long as the series' time axis.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import ship_package


def _series(pdf: pd.DataFrame) -> np.ndarray:
    return pdf.sort_values("t")["value"].to_numpy("float64")


def _detrended(v: np.ndarray) -> np.ndarray:
    x = np.arange(len(v))
    return v - np.polyval(np.polyfit(x, v, 1), x) if len(v) >= 3 else v - v.mean()


def power_spectrum(filled: DataFrame) -> DataFrame:
    """|FFT|^2 of the centred series at each frequency."""
    ship_package(filled.sparkSession)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        v = _series(pdf)
        p = np.abs(np.fft.rfft(v - v.mean())) ** 2
        return pd.DataFrame({"series_id": pdf.series_id.iloc[0], "k": np.arange(len(p), dtype="int32"), "power": np.round(p, 3)})

    return filled.groupBy("series_id").applyInPandas(run, "series_id string, k int, power double")


def estimate_period(filled: DataFrame) -> DataFrame:
    """The period of the strongest frequency of the detrended series between 1/max(4, n/2) and 1/2.

    Null for fewer than 24 points, a constant series, or a period outside 2 to n/2.
    """
    ship_package(filled.sparkSession)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        v = _series(pdf)
        n, period = len(v), None
        if n >= 24 and v.std() >= 1e-8:
            p = np.abs(np.fft.rfft(_detrended(v))) ** 2
            f = np.fft.rfftfreq(n)
            ok = (f >= 1 / max(4, n / 2)) & (f <= 0.5)
            if ok.any():
                guess = round(1 / f[ok][p[ok].argmax()])
                period = guess if 2 <= guess <= n // 2 else None
        return pd.DataFrame({"series_id": [pdf.series_id.iloc[0]], "n": [n], "period": pd.array([period], dtype="Int32")})

    return filled.groupBy("series_id").applyInPandas(run, "series_id string, n int, period int")


def decompose(filled: DataFrame, period: int) -> DataFrame:
    """Trend (centred moving mean, held at the ends), mean of each phase of the rest, and remainder; they add up."""
    ship_package(filled.sparkSession)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("t")
        v = pdf["value"].to_numpy("float64")
        width = period + 1 - period % 2
        pad = np.pad(v, width // 2, mode="edge")
        trend = np.convolve(pad, np.ones(width) / width, "valid")[: len(v)]
        phase = np.arange(len(v)) % period
        means = np.bincount(phase, v - trend, period) / np.maximum(np.bincount(phase, minlength=period), 1)
        season = (means - means.mean())[phase]
        return pd.DataFrame({"series_id": pdf.series_id.iloc[0], "t": pdf.t, "trend": trend, "season": season, "rest": v - trend - season})

    return filled.groupBy("series_id").applyInPandas(run, "series_id string, t int, trend double, season double, rest double")


def seasonal_strength(parts: DataFrame) -> DataFrame:
    """1 - var(rest) / var(season + rest), not below 0."""
    s = F.try_divide(F.var_pop("rest"), F.var_pop(F.col("season") + F.col("rest")))
    return parts.groupBy("series_id").agg(F.round(F.greatest(F.lit(0.0), 1 - s), 4).alias("strength"))


def unit_root(filled: DataFrame, lags: int = 2) -> DataFrame:
    """The augmented Dickey-Fuller t statistic with a constant; below -2.86 a unit root is rejected at 5 %."""
    ship_package(filled.sparkSession)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        v = _series(pdf)
        d, stat = np.diff(v), None
        if len(d) > 3 * lags + 8 and v.std() > 1e-8:
            y = d[lags:]
            x = np.column_stack([np.ones(len(y)), v[lags:-1], *[d[lags - k : len(d) - k] for k in range(1, lags + 1)]])
            beta, *_ = np.linalg.lstsq(x, y, rcond=None)
            rest = y - x @ beta
            cov = np.linalg.pinv(x.T @ x) * (rest @ rest) / (len(y) - x.shape[1])
            stat = float(beta[1] / np.sqrt(cov[1, 1]))
        return pd.DataFrame({"series_id": [pdf.series_id.iloc[0]], "stat": [stat], "stationary": [None if stat is None else stat < -2.86]})

    return filled.groupBy("series_id").applyInPandas(run, "series_id string, stat double, stationary boolean")


def forecast_ar(filled: DataFrame, order: int = 3, horizon: int = 12) -> DataFrame:
    """Steps ahead of an autoregression fitted by least squares to the centred series."""
    ship_package(filled.sparkSession)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        v = _series(pdf)
        mean, past = v.mean(), list(v - v.mean())
        if len(v) > 3 * order:
            x = np.column_stack([past[order - k : len(past) - k] for k in range(1, order + 1)])
            beta, *_ = np.linalg.lstsq(x, np.array(past[order:]), rcond=None)
        else:
            beta = np.zeros(order)
        for _ in range(horizon):
            past.append(float(np.dot(beta, past[: -order - 1 : -1])) if len(past) >= order else 0.0)
        return pd.DataFrame({"series_id": pdf.series_id.iloc[0], "step": np.arange(1, horizon + 1, dtype="int32"), "value": np.array(past[-horizon:]) + mean})

    return filled.groupBy("series_id").applyInPandas(run, "series_id string, step int, value double")


def dtw(a: np.ndarray, b: np.ndarray, band: int | None = None) -> float:
    """Dynamic time warping cost, two antidiagonals at a time; with ``band``, of paths that close to the diagonal."""
    n, m = len(a), len(b)
    band = max(n, m) if band is None else max(band, abs(n - m))
    # place i of a diagonal d is the cell of the first i points of a and the first d - i of b
    before, last = np.full(n + 1, np.inf), np.full(n + 1, np.inf)
    last[0] = 0
    for d in range(1, n + m + 1):
        now = np.full(n + 1, np.inf)
        low, high = max(1, d - m, -((band - d) // 2)), min(n, d - 1, (d + band) // 2)
        if low <= high:
            cost = np.abs(a[low - 1 : high] - b[d - high - 1 : d - low][::-1])
            now[low : high + 1] = cost + np.minimum(np.minimum(last[low : high + 1], last[low - 1 : high]), before[low - 1 : high])
        before, last = last, now
    return float(last[-1])


def _named_pairs(filled: DataFrame, which: Column) -> DataFrame:
    """Pairs (a, b) of series by name alone; the series themselves are joined to them by equality."""
    names = filled.select(F.col("series_id").alias("a")).distinct()
    return names.join(names.withColumnRenamed("a", "b"), which)


def dtw_pairs(filled: DataFrame, band: int | None = None) -> DataFrame:
    """Warping distance of each pair of standardised series, over all paths unless a ``band`` is asked for."""
    ship_package(filled.sparkSession)
    arrays = filled.groupBy("series_id").agg(F.sort_array(F.collect_list(F.struct("t", "value"))).alias("p")).select("series_id", F.transform("p", lambda x: x["value"]).alias("v"))
    a, b = arrays.select(F.col("series_id").alias("a"), F.col("v").alias("x")), arrays.select(F.col("series_id").alias("b"), F.col("v").alias("y"))

    @F.pandas_udf("double")
    def cost(x: pd.Series, y: pd.Series) -> pd.Series:
        z = lambda v: (np.asarray(v) - np.mean(v)) / (np.std(v) + 1e-8)
        return pd.Series([round(dtw(z(p), z(q), band), 6) for p, q in zip(x, y, strict=True)])

    return _named_pairs(filled, F.col("a") < F.col("b")).join(a, "a").join(b, "b").select("a", "b", cost("x", "y").alias("dtw"))


def granger_f(filled: DataFrame, lags: int = 3) -> DataFrame:
    """F statistic of whether past values of a help to predict b beyond b's own past (no causal claim)."""
    ship_package(filled.sparkSession)
    arrays = filled.groupBy("series_id").agg(F.sort_array(F.collect_list(F.struct("t", "value"))).alias("p")).select("series_id", F.transform("p", lambda x: x["value"]).alias("v"))
    a, b = arrays.select(F.col("series_id").alias("a"), F.col("v").alias("x")), arrays.select(F.col("series_id").alias("b"), F.col("v").alias("y"))

    @F.pandas_udf("double")
    def stat(x: pd.Series, y: pd.Series) -> pd.Series:
        def one(p: np.ndarray, q: np.ndarray) -> float:
            n = min(len(p), len(q))
            p, q = p[:n], q[:n]
            own = np.column_stack([np.ones(n - lags), *[q[lags - k : n - k] for k in range(1, lags + 1)]])
            both = np.column_stack([own, *[p[lags - k : n - k] for k in range(1, lags + 1)]])
            rest = lambda m: np.sum((q[lags:] - m @ np.linalg.lstsq(m, q[lags:], rcond=None)[0]) ** 2)
            r0, r1 = rest(own), rest(both)
            free = n - lags - both.shape[1]
            return float((r0 - r1) / lags / (r1 / free)) if free > 0 and r1 > 0 else float("nan")

        return pd.Series([round(one(np.asarray(p), np.asarray(q)), 6) for p, q in zip(x, y, strict=True)])

    return _named_pairs(filled, F.col("a") != F.col("b")).join(a, "a").join(b, "b").select("a", "b", stat("x", "y").alias("f"))
