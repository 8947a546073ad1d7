"""Controlled synthetic panels behind statistical gates."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.hashing import stable_hash, unit_interval
from tidemark.session import ship_package

TRENDS = ("none", "linear", "quadratic", "saturating", "piecewise", "local_reversal", "random_walk")
NOISES = ("gaussian", "student_t", "ar1", "heteroscedastic", "level_dependent", "mixture")
WAVES = ("sine", "triangle", "soft_square")


def trend_column(kind: Column, x: Column) -> Column:
    """Trend of a kind at x from 0 to 1, about one unit from start to end; a random walk is drawn elsewhere."""
    return (
        F.when(kind == "linear", x)
        .when(kind == "quadratic", x * x)
        .when(kind == "saturating", F.tanh(3 * x))
        .when(kind == "piecewise", F.when(x < 0.5, x * 0.4).otherwise(0.2 + (x - 0.5) * 1.6))
        .when(kind == "local_reversal", x - 0.6 * F.exp(-F.pow((x - 0.6) / 0.08, 2)))
        .otherwise(F.lit(0.0))
    )


def wave_column(kind: Column, phase: Column) -> Column:
    s = F.sin(2 * np.pi * phase)
    return F.when(kind == "triangle", 2 / np.pi * F.asin(s)).when(kind == "soft_square", F.tanh(3 * s)).otherwise(s)


def deterministic_part(spark: SparkSession, scenarios: int, length: int = 96, series: int = 5) -> DataFrame:
    """Trend and season of each scenario's series, in closed form: no randomness but what the numbers give."""
    rows = spark.range(scenarios * series).select((F.col("id") / series).cast("int").alias("scenario"), (F.col("id") % series).cast("int").alias("series"))
    pick = lambda names, c: F.element_at(F.array(*[F.lit(n) for n in names]), (c % len(names) + 1).cast("int"))
    kinds = rows.withColumns({"trend_kind": pick(TRENDS, F.col("scenario")), "wave_kind": pick(WAVES, F.col("scenario") + F.col("series")), "period": F.lit(12) + F.col("scenario") % 13})
    points = kinds.withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(length - 1))))
    x = F.col("t") / (length - 1)
    return points.withColumns({"trend": trend_column(F.col("trend_kind"), x), "season": 0.5 * wave_column(F.col("wave_kind"), F.col("t") / F.col("period") + 0.1 * F.col("series"))})


def with_noise(parts: DataFrame, seed: int = 20260712, scale: float = 0.15) -> DataFrame:
    """Add noise of the scenario's kind and what is observed; the parts sum exactly to it.

    The recursions run within a series; its generator starts from seed, scenario, series and attempt, so
    the same rows come out wherever they are made.
    """
    ship_package(parts.sparkSession)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("t").reset_index(drop=True)
        first = pdf.iloc[0]
        r = np.random.default_rng([seed, int(first.scenario), int(first.series), int(first.get("attempt", 0))])
        n, kind = len(pdf), NOISES[int(first.scenario) % len(NOISES)]
        e = r.standard_normal(n)
        if kind == "student_t":
            e = r.standard_t(4, n)
        elif kind == "ar1":
            for i in range(1, n):
                e[i] = 0.6 * e[i - 1] + 0.8 * e[i]
        elif kind == "heteroscedastic":
            e *= 0.5 + np.arange(n) / n
        elif kind == "level_dependent":
            e *= 0.5 + np.abs((pdf.trend + pdf.season).to_numpy())
        elif kind == "mixture":
            e *= np.where(r.random(n) < 0.05, 4.0, 0.8)
        if first.trend_kind == "random_walk":
            pdf["trend"] = np.cumsum(r.standard_normal(n)) / np.sqrt(n)
        pdf["noise"] = scale * e
        pdf["value"] = pdf.trend + pdf.season + pdf.noise
        return pdf

    schema = parts.schema.simpleString()[7:-1].replace(":", " ")
    return parts.groupBy("scenario", "series").applyInPandas(run, f"{schema}, noise double, value double")


def gate_attempts(spark: SparkSession, scenarios: int, attempts: int = 4, least_r: float = 0.2) -> DataFrame:
    """For each scenario the first attempt whose series' mean pairwise r is at least ``least_r``; null if none is.

    All attempts are made side by side and the first that passes is kept by a partial minimum.
    """
    base = deterministic_part(spark, scenarios).withColumn("attempt", F.explode(F.sequence(F.lit(0), F.lit(attempts - 1))))
    u = unit_interval(stable_hash("noise", *map(F.col, ("scenario", "series", "attempt", "t"))))
    noisy = base.withColumn("value", F.col("trend") + F.col("season") + 0.6 * (u - 0.5))
    a = noisy.select("scenario", "attempt", "t", F.col("series").alias("a"), F.col("value").alias("x"))
    b = noisy.select("scenario", "attempt", "t", F.col("series").alias("b"), F.col("value").alias("y"))
    r = F.try_divide(F.covar_pop("x", "y"), F.stddev_pop("x") * F.stddev_pop("y"))
    pairs = a.join(b, ["scenario", "attempt", "t"]).where("a < b").groupBy("scenario", "attempt", "a", "b").agg(r.alias("r"))
    scored = pairs.groupBy("scenario", "attempt").agg(F.round(F.avg("r"), 4).alias("mean_r"))
    passed = F.when(F.col("mean_r") >= least_r, F.struct("attempt", "mean_r"))
    return scored.groupBy("scenario").agg(F.min(passed).alias("p"), F.count("*").alias("attempts")).select("scenario", "attempts", F.col("p.attempt").alias("attempt"), F.col("p.mean_r").alias("mean_r"))


def inject_defects(panel: DataFrame, every: int = 40) -> DataFrame:
    """Spikes, a level shift and a block gap at fixed places, each with a flag of its kind."""
    order = Window.partitionBy("series_id").orderBy("t")
    n = F.row_number().over(order)
    spike = (n % every == 7)
    shift = 10 * n > 7 * F.count("*").over(Window.partitionBy("series_id"))
    gap = n.between(20, 24)
    kind = F.when(gap, "gap").when(spike, "spike").when(shift, "shift").otherwise("none")
    value = F.when(gap, F.lit(None)).when(spike, F.col("value") * 3).when(shift, F.col("value") + 10).otherwise(F.col("value"))
    return panel.select("series_id", "t", kind.alias("kind"), value.alias("value"))


def training_curves(spark: SparkSession, runs: int, steps: int = 60) -> DataFrame:
    """Loss curves of runs that fit well, overfit from some step on, underfit or oscillate, by run number."""
    rows = spark.range(runs).select(F.col("id").cast("int").alias("run"), F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step"))
    kind = F.element_at(F.array(*[F.lit(k) for k in ("good", "overfit", "underfit", "oscillating")]), F.col("run") % 4 + 1)
    x = F.col("step") / steps
    onset = 0.48 + 0.02 * (F.col("run") % 11)
    base = F.when(kind == "underfit", 0.9 - 0.2 * x).otherwise(0.1 + F.exp(-4 * x))
    extra = F.when(kind == "overfit", F.greatest(F.lit(0.0), x - onset) * 0.8).when(kind == "oscillating", 0.08 * F.sin(12 * x * np.pi)).otherwise(0.02)
    return rows.select("run", "step", kind.alias("kind"), base.alias("train"), (base + extra).alias("validation"))


def intermittent_demand(spark: SparkSession, series: int, length: int = 120, share: float = 0.3) -> DataFrame:
    """Demand that is zero but for about ``share`` of the steps, drawn from a hash so that it never changes."""
    rows = spark.range(series).select(F.concat(F.lit("d"), F.col("id")).alias("series_id"), F.explode(F.sequence(F.lit(0), F.lit(length - 1))).alias("t"))
    u = unit_interval(stable_hash("demand", F.col("series_id"), F.col("t")))
    return rows.select("series_id", "t", F.when(u < share, F.round(1 + 20 * u / share, 6)).otherwise(0.0).alias("value"))


def drift_ramp(panel: DataFrame, start: float = 0.6, rise: float = 8.0) -> DataFrame:
    """A rise from 0 at ``start`` of a series' length to ``rise`` at its end, added to the values."""
    order = Window.partitionBy("series_id").orderBy("t")
    x = (F.row_number().over(order) - 1) / (F.count("*").over(Window.partitionBy("series_id")) - 1)
    return panel.select("series_id", "t", (F.col("value") + rise * F.greatest(F.lit(0.0), (x - start) / (1 - start))).alias("value"))
