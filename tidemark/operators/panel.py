"""Panels: regular grids of series, wide and long forms that keep duplicate points, and column summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Series that a wide panel may have: its columns are named on the driver.
MAX_SERIES = 1000


def hour_of(ts: str, origin: str = "2024-01-01 00:00:00") -> Column:
    """Whole hours since ``origin`` of a timestamp without time zone."""
    return F.expr(f"timestampdiff(HOUR, TIMESTAMP_NTZ'{origin}', {ts})").cast("int")


def hourly_panel(events: DataFrame) -> DataFrame:
    """series_id, t and the hour's mean value."""
    return events.groupBy(F.col("event_type").alias("series_id"), hour_of("ts").alias("t")).agg(F.avg("value").alias("value"))


def full_grid(panel: DataFrame) -> DataFrame:
    """``panel`` with a row for each series and each t from the first to the last; absent values are null."""
    ends = panel.agg(F.min("t").alias("first"), F.max("t").alias("last")).where("first IS NOT NULL")
    series = panel.select("series_id").distinct()
    # one row of margins goes to every series; each makes its own times
    slots = series.join(F.broadcast(ends)).select("series_id", F.explode(F.sequence("first", "last")).alias("t"))
    return slots.join(panel, ["series_id", "t"], "left")


def summary(grid: DataFrame) -> DataFrame:
    """Count, mean, sample deviation, extremes and missing and zero shares by series; infinite values are missing."""
    v = F.when(~F.isnan("value") & (F.abs("value") != float("inf")), F.col("value"))
    r4 = lambda c: F.round(c, 4)
    return grid.groupBy("series_id").agg(
        F.count(v).alias("n"),
        r4(F.avg(v)).alias("mean"),
        r4(F.stddev_samp(v)).alias("std"),
        r4(F.min(v)).alias("min"),
        r4(F.max(v)).alias("max"),
        r4(F.avg(v.isNull().cast("int"))).alias("missing_ratio"),
        r4(F.coalesce(F.try_divide(F.count_if(v == 0), F.count(v)), F.lit(0.0))).alias("zero_ratio"),
    )


def series_aliases(long: DataFrame, order: list[str]) -> DataFrame:
    """series_id and its alias s01, s02 ... by first appearance in ``order``."""
    first = long.groupBy("series_id").agg(F.min(F.struct(*order)).alias("first"))
    return first.select("series_id", F.concat(F.lit("s"), F.lpad(F.row_number().over(Window.orderBy("first", "series_id")).cast("string"), 2, "0")).alias("alias"))


def to_wide(long: DataFrame, order: list[str], value: str = "value") -> DataFrame:
    """A row for each t and occurrence, a column for each series; repeated points are rows of their own.

    The nth point of a series at a time has occurrence n - 1; so no point is lost and none is averaged.
    """
    names = series_aliases(long, order)
    aliases = [r.alias for r in names.select("alias").orderBy("alias").limit(MAX_SERIES + 1).collect()]
    if len(aliases) > MAX_SERIES:
        raise ValueError(f"a wide panel has at most {MAX_SERIES} series")
    nth = Window.partitionBy("t", "series_id").orderBy(*order)
    counted = long.withColumn("occ", F.row_number().over(nth) - 1).join(F.broadcast(names), "series_id")
    return counted.groupBy("t", "occ").pivot("alias", aliases).agg(F.first(value))


def to_long(wide: DataFrame) -> DataFrame:
    """t, occ, alias and value: every series at occurrence 0, of later ones only the points there are."""
    series = sorted(c for c in wide.columns if c not in ("t", "occ"))
    return wide.unpivot(["t", "occ"], series, "alias", "value").where("occ = 0 OR value IS NOT NULL")


def interpolated(grid: DataFrame) -> DataFrame:
    """Missing values by a line between the neighbours that are there, level beyond the first and last."""
    back = Window.partitionBy("series_id").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy("series_id").orderBy("t").rowsBetween(0, Window.unboundedFollowing)
    at = F.when(F.col("value").isNotNull(), F.col("t"))
    sides = grid.withColumns(
        {
            "v0": F.last("value", ignorenulls=True).over(back),
            "t0": F.last(at, ignorenulls=True).over(back),
            "v1": F.first("value", ignorenulls=True).over(ahead),
            "t1": F.first(at, ignorenulls=True).over(ahead),
        }
    )
    line = F.col("v0") + (F.col("v1") - F.col("v0")) * (F.col("t") - F.col("t0")) / F.nullif(F.col("t1") - F.col("t0"), F.lit(0))
    filled = F.coalesce(F.col("value"), line, F.col("v0"), F.col("v1"))
    return sides.select("series_id", "t", F.col("value").isNull().alias("was_missing"), filled.alias("value"))


def index_quality(events: DataFrame, series: str, time: str) -> DataFrame:
    """Points, distinct times, duplicates, and how many steps differ from the commonest one, by series."""
    times = events.groupBy(series, time).agg(F.count("*").alias("n"))
    step = F.col(time) - F.lag(time).over(Window.partitionBy(series).orderBy(time))
    steps = times.withColumn("step", step).groupBy(series, "step").agg(F.sum("n").alias("n"), F.count("*").alias("times"))
    return steps.groupBy(series).agg(
        F.sum("n").alias("points"),
        F.sum("times").alias("distinct_times"),
        (F.sum("n") - F.sum("times")).alias("duplicates"),
        F.max(F.when(F.col("step").isNotNull(), F.struct(F.col("times"), -F.col("step"))))["times"].alias("regular_steps"),
        F.sum(F.when(F.col("step").isNotNull(), F.col("times"))).alias("steps"),
    )
