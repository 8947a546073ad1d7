"""Repeated and singular stretches of series: the matrix profile, dealt by blocks of diagonals."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import ship_package

#: Diagonals of one task's piece of work.
DIAGONALS = 128


def block_profile(v: np.ndarray, m: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least squared distance of each window of ``m`` points along diagonals low to high - 1, and the other window.

    A diagonal holds the pairs of windows a fixed number of points apart; the products of all of them come from one
    running sum.  Windows are standardised; two constant ones are 0 apart, a constant and another m.
    """
    n = len(v) - m + 1
    v = v - v.mean()
    sums, squares = (np.cumsum(np.concatenate([[0.0], x])) for x in (v, v * v))
    mean = (sums[m:] - sums[:-m]) / m
    sd = np.sqrt(np.maximum((squares[m:] - squares[:-m]) / m - mean * mean, 0))
    windows = np.lib.stride_tricks.sliding_window_view(v, m)
    flat = windows.max(1) - windows.min(1) < 1e-8
    sd = np.where(flat | (sd == 0), 1, sd)
    best, at = np.full(n, np.inf), np.full(n, -1, np.int64)
    for g in range(low, min(high, n)):
        k = n - g
        run = np.cumsum(np.concatenate([[0.0], v[: len(v) - g] * v[g:]]))
        r = ((run[m:] - run[:-m]) / m - mean[:k] * mean[g:]) / (sd[:k] * sd[g:])
        d = np.where(flat[:k] & flat[g:], 0.0, np.where(flat[:k] | flat[g:], m, 2 * m * (1 - np.clip(r, -1, 1))))
        for own, other, first in ((slice(0, k), np.arange(g, n), best[:k]), (slice(g, n), np.arange(k), best[g:])):
            less = d < first
            best[own] = np.where(less, d, first)
            at[own] = np.where(less, other, at[own])
    return best, at


def matrix_profile(filled: DataFrame, length: int = 24, diagonals: int = DIAGONALS) -> DataFrame:
    """(series_id, place, distance, nearest): of each window its distance to the nearest other one and where that starts.

    ``filled`` has series_id, t and value without gaps; places count from 0.  Windows less than half a length apart
    don't count as others.  A piece of work is a block of diagonals of one series, so a long series spreads over
    tasks; pieces are merged by minima.  Series with no two such windows make no rows.
    """
    ship_package(filled.sparkSession)
    apart = max(1, length // 2)
    arrays = filled.groupBy("series_id").agg(F.sort_array(F.collect_list(F.struct("t", "value"))).alias("p")).select("series_id", F.transform("p", lambda x: x["value"]).alias("v"))
    long = arrays.where(F.size("v") >= length + apart)
    blocks = long.select("series_id", "v", F.explode(F.sequence(F.lit(apart), F.size("v") - length, F.lit(diagonals))).alias("low"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                d, at = block_profile(np.asarray(row.v, dtype=float), length, row.low, row.low + diagonals)
                some = np.flatnonzero(at >= 0)
                yield pd.DataFrame({"series_id": row.series_id, "place": some.astype("int32"), "d": d[some], "nearest": at[some].astype("int32")})

    each = blocks.repartition("series_id", "low").mapInPandas(run, "series_id string, place int, d double, nearest int")
    best = each.groupBy("series_id", "place").agg(F.min(F.struct("d", "nearest")).alias("b"))
    return best.select("series_id", "place", F.sqrt("b.d").alias("distance"), F.col("b.nearest").alias("nearest"))


def motifs_and_discords(profile: DataFrame) -> DataFrame:
    """For each series its closest pair of windows (the motif) and its most singular window (the discord)."""
    found = profile.groupBy("series_id").agg(F.min(F.struct("distance", "place", "nearest")).alias("m"), F.max(F.struct("distance", (-F.col("place")).alias("p"))).alias("x"), F.count("*").alias("windows"), F.avg("distance").alias("mean"))
    r4 = lambda c: F.round(c, 4)
    return found.select("series_id", "windows", F.col("m.place").alias("motif"), F.col("m.nearest").alias("motif_again"), r4("m.distance").alias("motif_distance"), (-F.col("x.p")).alias("discord"), r4("x.distance").alias("discord_distance"), r4("mean").alias("mean_distance"))
