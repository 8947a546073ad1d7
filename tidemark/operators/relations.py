"""Relations between series: correlations, lags, distributions and distances."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.stats import r6, safe_corr


def _pairs(panel: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of two series a < b at the same t; the equi-join on t keeps it a shuffle by time."""
    a = panel.select("t", F.col("series_id").alias("a"), *[F.col(c).alias(f"{c}_a") for c in columns])
    b = panel.select("t", F.col("series_id").alias("b"), *[F.col(c).alias(f"{c}_b") for c in columns])
    return a.join(b, (a["t"] == b["t"]) & (F.col("a") < F.col("b"))).drop(b["t"])


def views(grid: DataFrame) -> DataFrame:
    """value, its difference to the step before, and what a line through the series leaves."""
    order = Window.partitionBy("series_id").orderBy("t")
    whole = Window.partitionBy("series_id")
    slope, level, n = (f(c).over(whole) for f, c in ((lambda y: F.regr_slope(y, "t"), F.col("value")), (lambda y: F.regr_intercept(y, "t"), F.col("value")), (F.count, F.col("value"))))
    return grid.withColumns(
        {"diff": F.col("value") - F.lag("value").over(order), "flat": F.when(n >= 3, F.col("value") - (slope * F.col("t") + level))}
    )


def correlations(grid: DataFrame) -> DataFrame:
    """Raw, differenced and detrended r of each pair over the times both have, null under max(8, times/10)."""
    times = grid.select("t").distinct().agg(F.count("*").alias("times"))
    found = _pairs(views(grid), ["value", "diff", "flat"]).groupBy("a", "b").agg(
        F.count_if(F.col("value_a").isNotNull() & F.col("value_b").isNotNull()).alias("overlap"),
        safe_corr("value_a", "value_b").alias("raw_r"),
        safe_corr("diff_a", "diff_b").alias("diff_r"),
        safe_corr("flat_a", "flat_b").alias("detrended_r"),
    )
    enough = F.col("overlap") >= F.greatest(F.lit(8), F.floor(F.col("times") / 10))
    return found.join(F.broadcast(times)).select("a", "b", "overlap", *[r6(F.when(enough, F.col(c))).alias(c) for c in ("raw_r", "diff_r", "detrended_r")])


def best_lags(grid: DataFrame) -> DataFrame:
    """The lag of -L..L, L = min(60, max(3, times/6)), at which b follows a best, and r there."""
    points = grid.where("value IS NOT NULL")
    reach = grid.agg(F.least(F.lit(60), F.greatest(F.lit(3), F.floor(F.count_distinct("t") / 6))).cast("int").alias("reach"))
    shifted = (
        points.join(F.broadcast(reach))
        .select(F.col("series_id").alias("a"), F.col("value").alias("x"), F.explode(F.sequence(-F.col("reach"), F.col("reach"))).alias("lag"), "t")
        .withColumn("t", F.col("t") + F.col("lag"))
    )
    other = points.select(F.col("series_id").alias("b"), "t", F.col("value").alias("y"))
    met = shifted.join(other, "t").where("a < b").groupBy("a", "b", "lag").agg(safe_corr("x", "y").alias("r"), F.count("*").alias("n"))
    r = F.round("r", 6)
    best = met.where(r.isNotNull() & (F.col("n") >= 8)).groupBy("a", "b").agg(F.max(F.struct(r.alias("r"), -F.abs("lag"), -F.col("lag"), F.col("n"))).alias("m"))
    return best.select("a", "b", (-F.col("m.col3")).alias("lag"), F.col("m.r").alias("r"), F.col("m.n").alias("n"))


def wasserstein(panel: DataFrame) -> DataFrame:
    """First Wasserstein distance of each pair's values, over the pooled sample deviation plus 1e-8.

    The integral of the difference of the two distribution functions over the merged values.
    """
    names = panel.select(F.col("series_id").alias("s")).distinct()
    pair = names.alias("l").join(names.alias("r"), F.col("l.s") < F.col("r.s")).select(F.col("l.s").alias("a"), F.col("r.s").alias("b"))
    pair = pair.select("a", "b", F.explode(F.array("a", "b")).alias("series_id"))
    points = panel.where("value IS NOT NULL").select("series_id", "value")
    both = pair.join(points, "series_id").select("a", "b", (F.col("series_id") == F.col("a")).cast("int").alias("is_a"), "value")
    steps = both.groupBy("a", "b", "value").agg(F.sum("is_a").alias("na"), F.sum(1 - F.col("is_a")).alias("nb"))
    order = Window.partitionBy("a", "b").orderBy("value")
    whole = Window.partitionBy("a", "b")
    gaps = steps.withColumns(
        {
            "fa": F.sum("na").over(order) / F.sum("na").over(whole),
            "fb": F.sum("nb").over(order) / F.sum("nb").over(whole),
            "gap": F.lead("value").over(order) - F.col("value"),
        }
    )
    distance = gaps.groupBy("a", "b").agg(F.sum(F.abs(F.col("fa") - F.col("fb")) * F.coalesce("gap", F.lit(0.0))).alias("w"))
    spread = both.groupBy("a", "b").agg(F.stddev_samp("value").alias("sd"))
    return distance.join(spread, ["a", "b"]).select("a", "b", r6("w").alias("w1"), r6(F.col("w") / (F.col("sd") + 1e-8)).alias("w1_scaled"))


def spearman(grid: DataFrame) -> DataFrame:
    """Rank correlation of each pair over the times both have; tied values share their mean rank."""
    both = _pairs(grid, ["value"]).where("value_a IS NOT NULL AND value_b IS NOT NULL")
    rank = lambda c: F.rank().over(Window.partitionBy("a", "b").orderBy(c)) + (F.count("*").over(Window.partitionBy("a", "b", c)) - 1) / 2
    ranked = both.withColumns({"ra": rank("value_a"), "rb": rank("value_b")})
    return ranked.groupBy("a", "b").agg(r6(safe_corr("ra", "rb")).alias("rho"), F.count("*").alias("n"))


def group_separation(pairs: DataFrame, r: str = "raw_r") -> DataFrame:
    """Mean r of pairs whose series share their group (the letter before the first underscore) and of others."""
    group = lambda c: F.substring_index(F.col(c), "_", 1)
    same = group("a") == group("b")
    return pairs.agg(
        r6(F.avg(F.when(same, F.col(r)))).alias("within_r"), r6(F.avg(F.when(~same, F.col(r)))).alias("between_r"), F.count(r).alias("pairs"),
        F.coalesce(F.min(F.col(r)) > 0.9, F.lit(False)).alias("all_above_090"),
    )


def components_at(pairs: DataFrame, threshold: float, r: str = "raw_r") -> DataFrame:
    """Each series with its mean r to others, its most similar series, and its links at ``threshold`` or more."""
    both = pairs.select("a", "b", r).unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), r))
    best = F.max(F.when(F.col(r).isNotNull(), F.struct(F.col(r), F.col("b"))))
    return both.groupBy(F.col("a").alias("series_id")).agg(r6(F.avg(r)).alias("mean_r"), best["b"].alias("closest"), F.count_if(F.col(r) >= threshold).alias("links"))


def relation_gate(pairs: DataFrame, *, least_r: float = 0.35, least_overlap: int = 48) -> DataFrame:
    """For each pair the reasons that keep it from counting as related; none means it passes."""
    reasons = [
        ("few_points", F.col("overlap") < least_overlap),
        ("undefined", F.col("raw_r").isNull()),
        ("weak", F.abs("raw_r") < least_r),
        ("only_trend", (F.abs("raw_r") >= least_r) & (F.abs("detrended_r") < least_r / 2)),
        ("opposite_steps", F.signum("raw_r") * F.signum("diff_r") < 0),
    ]
    return pairs.select("a", "b", F.array_join(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in reasons])), ",").alias("reasons"))


def series_separation(pairs: DataFrame, odd: str, r: str = "raw_r") -> DataFrame:
    """Mean r among the other series, and between them and the series ``odd``."""
    touches = (F.col("a") == odd) | (F.col("b") == odd)
    return pairs.agg(r6(F.avg(F.when(~touches, F.col(r)))).alias("among"), r6(F.avg(F.when(touches, F.col(r)))).alias("between"), F.count_if(touches).alias("n_between"))


def segment_correlation(filled: DataFrame, reference: str, length: int = 24) -> DataFrame:
    """r of each series with ``reference`` in each segment of ``length`` steps."""
    ref = filled.where(F.col("series_id") == reference).select("t", F.col("value").alias("ref"))
    return filled.where(F.col("series_id") != reference).join(ref, "t").groupBy("series_id", F.floor(F.col("t") / length).cast("int").alias("segment")).agg(r6(safe_corr("value", "ref")).alias("r"))
