"""Autoregressive integrated moving averages, fitted by the exact likelihood of a Kalman filter."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from tidemark.session import ship_package


def partials_to_coefficients(u: np.ndarray) -> np.ndarray:
    """Coefficients of a stationary autoregression from any numbers: by way of partial correlations in (-1, 1)."""
    found = np.zeros(0)
    for r in np.tanh(u):
        found = np.concatenate([found - r * found[::-1], [r]])
    return found


def state_space(ar: np.ndarray, ma: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Transition, shock loading and stationary covariance (for shocks of variance one) of an ARMA process."""
    r = max(len(ar), len(ma) + 1)
    move = np.zeros((r, r))
    move[: len(ar), 0] = ar
    move[:-1, 1:] = np.eye(r - 1)
    load = np.zeros(r)
    load[0], load[1 : len(ma) + 1] = 1, ma
    cover = np.linalg.solve(np.eye(r * r) - np.kron(move, move), np.outer(load, load).ravel()).reshape(r, r)
    return move, load, cover


def filtered(y: np.ndarray, ar: np.ndarray, ma: np.ndarray) -> tuple[float, float, np.ndarray, np.ndarray]:
    """-2 log likelihood (shock variance put in), that variance, and the state's mean and covariance after the last point.

    Once the covariance has settled the gain stays as it is.
    """
    move, load, cover = state_space(ar, ma)
    shocks, state = np.outer(load, load), np.zeros(len(load))
    squares = logs = 0.0
    settled, f, gain = False, 1.0, load
    for value in y:
        if not settled:
            f, gain = cover[0, 0], move @ cover[:, 0] / cover[0, 0]
        error = value - state[0]
        squares += error * error / f
        logs += np.log(f)
        state = move @ state + gain * error
        if not settled:
            after = move @ cover @ move.T + shocks - np.outer(gain, gain) * f
            settled, cover = bool(np.abs(after - cover).max() < 1e-11), after
    n = len(y)
    variance = max(squares / n, 1e-300)
    return n * np.log(2 * np.pi * variance) + n + logs, variance, state, cover


def simplex(target, start: np.ndarray, steps: int = 400, tolerance: float = 1e-7) -> np.ndarray:
    """A minimum near ``start`` by the downhill simplex of Nelder and Mead."""
    k = len(start)
    points = [start, *(start + np.eye(k)[i] * 0.4 for i in range(k))]
    values = [target(p) for p in points]
    for _ in range(steps):
        order = np.argsort(values, kind="stable")
        points, values = [points[i] for i in order], [values[i] for i in order]
        if values[-1] - values[0] < tolerance * (1 + abs(values[0])):
            break
        centre = np.mean(points[:-1], 0)
        tried = centre + (centre - points[-1])
        value = target(tried)
        if value < values[0]:
            far = centre + 2 * (centre - points[-1])
            other = target(far)
            tried, value = (far, other) if other < value else (tried, value)
        elif value >= values[-2]:
            near = centre + 0.5 * ((tried if value < values[-1] else points[-1]) - centre)
            other = target(near)
            if other >= min(value, values[-1]):
                points = [points[0], *((p + points[0]) / 2 for p in points[1:])]
                values = [values[0], *map(target, points[1:])]
                continue
            tried, value = near, other
        points[-1], values[-1] = tried, value
    return points[int(np.argmin(values))]


@dataclass
class Arima:
    """A fitted model: orders (p, d, q), coefficients, mean of the differences and variance of the shocks."""

    order: tuple[int, int, int]
    ar: np.ndarray
    ma: np.ndarray
    mean: float
    variance: float
    aic: float


def fit(v: np.ndarray, order: tuple[int, int, int]) -> Arima | None:
    """The model of greatest likelihood of the d-times differenced series about its mean; None for too few points or a constant."""
    p, d, q = order
    w = np.diff(v, d) if d else np.asarray(v, float)
    if len(w) < 3 * (p + q + 1) + 2 or w.std() < 1e-8:
        return None
    mean = float(w.mean())
    y = w - mean

    def parts(u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # an invertible moving average is minus a stationary autoregression
        return partials_to_coefficients(u[:p]), -partials_to_coefficients(u[p:])

    def loss(u: np.ndarray) -> float:
        return filtered(y, *parts(np.clip(u, -6, 6)))[0] + 1e-6 * float(u @ u)

    best = np.clip(simplex(loss, np.zeros(p + q)) if p + q else np.zeros(0), -6, 6)
    ar, ma = parts(best)
    value, variance, _, _ = filtered(y, ar, ma)
    return Arima(order, ar, ma, mean, float(variance), float(value + 2 * (p + q + 2)))


def forecast(v: np.ndarray, model: Arima, horizon: int) -> tuple[np.ndarray, np.ndarray]:
    """Values and standard errors of the next ``horizon`` points: the filter runs on, differences are summed up again."""
    d = model.order[1]
    w = np.diff(v, d) if d else np.asarray(v, float)
    move, load, _ = state_space(model.ar, model.ma)
    _, _, state, _ = filtered(w - model.mean, model.ar, model.ma)
    ahead, respond, reply = [], [], load.copy()
    for _ in range(horizon):
        ahead.append(state[0] + model.mean)
        state = move @ state
        respond.append(reply[0])
        reply = move @ reply
    values, respond = np.array(ahead), np.array(respond)
    for k in range(d, 0, -1):
        last = np.diff(v, k - 1)[-1] if k > 1 else v[-1]
        values, respond = last + np.cumsum(values), np.cumsum(respond)
    return values, np.sqrt(model.variance * np.cumsum(respond**2))


def choose(v: np.ndarray, orders: list[tuple[int, int, int]]) -> Arima | None:
    """The fitted model with the least AIC among those of the least number of differences that gives any; ties by order."""
    fitted = [m for o in orders if (m := fit(v, o)) is not None]
    return min(fitted, key=lambda m: (round(m.aic, 6), m.order)) if fitted else None


def arima_forecast(filled: DataFrame, orders: list[tuple[int, int, int]] = ((1, 1, 1),), horizon: int = 12) -> DataFrame:
    """series_id, step, value, error, p, d, q and aic: forecasts by the best of ``orders`` for each regular series.

    One series is one piece of work, bounded by the time axis.  A series too short or constant stays at its last value
    with error 0 and null orders.  Orders should share d, as AICs of other differences don't compare.
    """
    ship_package(filled.sparkSession)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        v = pdf.sort_values("t")["value"].to_numpy("float64")
        model = choose(v, list(orders))
        values, errors = forecast(v, model, horizon) if model else (np.full(horizon, v[-1]), np.zeros(horizon))
        p, d, q = model.order if model else (None,) * 3
        out = pd.DataFrame({"series_id": pdf.series_id.iloc[0], "step": np.arange(1, horizon + 1, dtype="int32"), "value": values, "error": errors})
        return out.assign(**{k: pd.array([x] * horizon, dtype="Int32") for k, x in (("p", p), ("d", d), ("q", q))}, aic=model.aic if model else np.nan)

    return filled.groupBy("series_id").applyInPandas(run, "series_id string, step int, value double, error double, p int, d int, q int, aic double")
