"""Diagnostics of single series and of predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.stats import r6
from tidemark.operators.quantiles import exact_quantiles
from tidemark.shared import written


def _series() -> WindowSpec:
    return Window.partitionBy("series_id")


def _order() -> WindowSpec:
    return _series().orderBy("t")


def autocorrelation(filled: DataFrame, lags: int = 24) -> DataFrame:
    """Biased autocorrelation at lags 1 to ``lags``, or to a third of the series' length."""
    centred = filled.withColumns({"x": F.col("value") - F.avg("value").over(_series()), "n": F.count("*").over(_series())})
    lagged = centred.withColumn("before", F.array(*[F.lag("x", k).over(_order()) for k in range(1, lags + 1)]))
    terms = lagged.select("series_id", "n", "x", F.posexplode("before").alias("k", "y"))
    power = centred.groupBy("series_id").agg(F.sum(F.col("x") * F.col("x")).alias("power"))
    summed = terms.groupBy("series_id", "n", (F.col("k") + 1).alias("lag")).agg(F.sum(F.col("x") * F.col("y")).alias("s"))
    return summed.join(power, "series_id").where(F.col("lag") <= F.floor(F.col("n") / 3)).select("series_id", "lag", "n", r6(F.try_divide("s", "power")).alias("acf"))


def ljung_box(acf: DataFrame, lags: int = 10) -> DataFrame:
    """The portmanteau statistic over the first ``lags`` autocorrelations."""
    return acf.where(F.col("lag") <= lags).groupBy("series_id", "n").agg(F.count("*").alias("lags"), F.sum(F.col("acf") * F.col("acf") / (F.col("n") - F.col("lag"))).alias("s")).select(
        "series_id", "n", "lags", F.round(F.col("n") * (F.col("n") + 2) * F.col("s"), 4).alias("q")
    )


def rolling_median_width(n: int) -> int:
    return max(5, min(31, n // 15))


def robust_anomalies(filled: DataFrame, width: int = 31, limit: float = 4.5) -> DataFrame:
    """Points whose distance from the rolling median is beyond ``limit`` robust deviations.

    The window of ``width`` is centred; an even one reaches one further back.  The first
    max(3, min(12, n/50)) points of a series are kept.
    """
    near = _order().rowsBetween(-(width // 2), (width - 1) // 2)
    rest = filled.withColumn("resid", F.col("value") - F.percentile("value", F.lit(0.5)).over(near))
    middle = rest.groupBy("series_id").agg(F.percentile("resid", F.lit(0.5)).alias("med"), F.count("*").alias("n"))
    spread = rest.join(middle, "series_id").groupBy("series_id").agg(F.percentile(F.abs(F.col("resid") - F.col("med")), F.lit(0.5)).alias("mad"))
    z = 0.6745 * (F.col("resid") - F.col("med")) / (F.col("mad") + 1e-8)
    scored = rest.join(middle, "series_id").join(spread, "series_id").withColumn("z", z).where(F.abs("z") > limit)
    keep = F.greatest(F.lit(3), F.least(F.lit(12), F.floor(F.col("n") / 50)))
    return scored.withColumn("nth", F.row_number().over(_order())).where(F.col("nth") <= keep).select("series_id", "t", F.round("z", 4).alias("z"))


def change_point(filled: DataFrame, least: float = 0.35) -> DataFrame:
    """The split with the largest difference of means over the population deviation, where above ``least``.

    Splits from max(4, .18 n) up to min(n - 4, .82 n); running sums make each split one row's work.
    """
    run = _order().rowsBetween(Window.unboundedPreceding, -1)
    s = filled.withColumns(
        {"i": F.row_number().over(_order()) - 1, "n": F.count("*").over(_series()), "left": F.sum("value").over(run), "all": F.sum("value").over(_series()), "sd": F.stddev_pop("value").over(_series())}
    )
    low = F.greatest(F.lit(4), F.floor(F.col("n") * 0.18))
    high = F.least(F.col("n") - 4, F.floor(F.col("n") * 0.82))
    score = F.abs(F.col("left") / F.col("i") - (F.col("all") - F.col("left")) / (F.col("n") - F.col("i"))) / (F.col("sd") + 1e-8)
    splits = s.where((F.col("i") >= low) & (F.col("i") < high)).withColumn("score", r6(score))
    best = splits.groupBy("series_id").agg(F.max(F.struct("score", -F.col("i"), "t")).alias("m"))
    return best.where(F.col("m.score") > least).select("series_id", F.col("m.t").alias("t"), F.col("m.score").alias("score"))


def zscores(grid: DataFrame) -> DataFrame:
    """Distance from the mean over the population deviation plus 1e-8; gaps stay."""
    return grid.select("series_id", "t", r6((F.col("value") - F.avg("value").over(_series())) / (F.stddev_pop("value").over(_series()) + 1e-8)).alias("z"))


def histogram(panel: DataFrame, bins: int = 35) -> DataFrame:
    """Values in ``bins`` equal bins from the smallest to the largest; the last one is closed."""
    values = panel.where("value IS NOT NULL").select("value")
    ends = values.agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    at = F.when(F.col("hi") > F.col("lo"), F.least(F.lit(bins - 1), F.floor((F.col("value") - F.col("lo")) * bins / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0))))).otherwise(0)
    return values.join(F.broadcast(ends)).groupBy(at.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def missing_runs(grid: DataFrame) -> DataFrame:
    """Each run of missing values: where it starts, its length, and how many of its times others miss too."""
    miss = grid.where("value IS NULL").select("series_id", "t")
    shared = miss.withColumn("series", F.count("*").over(Window.partitionBy("t")))
    runs = shared.withColumn("run", F.col("t") - F.row_number().over(_order()))
    return runs.groupBy("series_id", "run").agg(F.min("t").alias("start"), F.count("*").alias("length"), F.count_if(F.col("series") > 1).alias("shared")).drop("run")


def local_trends(filled: DataFrame, segments: int = 6) -> DataFrame:
    """Slope of the whole series and of equal segments, with their fit."""
    cut = filled.withColumn("segment", F.ntile(segments).over(_order()))
    part = cut.groupBy("series_id", "segment").agg(F.regr_slope("value", "t").alias("slope"), F.regr_r2("value", "t").alias("r2"))
    whole = filled.groupBy("series_id").agg(F.regr_slope("value", "t").alias("whole_slope"))
    return part.join(whole, "series_id").select("series_id", "segment", r6("slope").alias("slope"), r6("r2").alias("r2"), r6("whole_slope").alias("whole_slope"))


def shape(panel: DataFrame) -> DataFrame:
    """Population skewness and excess kurtosis, quantiles and the share of zeros."""
    q = lambda p: r6(F.percentile("value", F.lit(p)))
    return panel.groupBy("series_id").agg(
        r6(F.skewness("value")).alias("skewness"), r6(F.kurtosis("value")).alias("kurtosis"), q(0.05).alias("p05"), q(0.5).alias("p50"), q(0.95).alias("p95")
    )


def peaks(filled: DataFrame) -> DataFrame:
    """Points above both neighbours."""
    return filled.withColumns({"before": F.lag("value").over(_order()), "after": F.lead("value").over(_order())}).where("value > before AND value > after").select("series_id", "t", r6("value").alias("value"))


def clipped(filled: DataFrame, low: float = 0.02, high: float = 0.98) -> DataFrame:
    """Values held within two quantiles of their series."""
    bounds = filled.groupBy("series_id").agg(F.percentile("value", F.lit(low)).alias("lo"), F.percentile("value", F.lit(high)).alias("hi"))
    return filled.join(bounds, "series_id").select("series_id", "t", r6(F.least(F.greatest("value", "lo"), "hi")).alias("value"))


def lag_features(filled: DataFrame) -> DataFrame:
    """Lags, the lead (a leak), mean of this and the next three (a leak), rolling means and the hour of the day."""
    return filled.select(
        "series_id", "t",
        r6(F.lag("value", 1).over(_order())).alias("lag1"), r6(F.lag("value", 24).over(_order())).alias("lag24"),
        r6(F.lead("value", 1).over(_order())).alias("target_t_plus_1"),
        r6(F.avg("value").over(_order().rowsBetween(0, 3))).alias("future_window_mean"),
        r6(F.avg("value").over(_order().rowsBetween(-6, 0))).alias("mean7"),
        r6(F.stddev_pop("value").over(_order().rowsBetween(-6, 0))).alias("std7"),
        (F.col("t") % 24).alias("hour"),
    )


def covariate_effects(filled: DataFrame, lag: int = 2) -> DataFrame:
    """A promotion on four of thirty steps, its lag with 0 at the start, and mean values with and without it."""
    promo = (F.col("t") % 30 < 4).cast("int")
    lagged = filled.withColumn("promo", promo).withColumn("lagged", F.lag("promo", lag, 0).over(_order()))
    return lagged.groupBy("series_id", "lagged").agg(F.count("*").alias("n"), r6(F.avg("value")).alias("mean_value"), F.sum("promo").alias("promo_now"))


def residual_summary(rows: DataFrame, by: list[str], actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Bias, absolute and squared error, tails and count of predictions by group."""
    e = F.col(actual) - F.col(predicted)
    means = rows.groupBy(*by).agg(F.count("*").alias("n"), F.round(F.avg(e), 4).alias("bias"), F.round(F.avg(F.abs(e)), 4).alias("mae"), F.round(F.sqrt(F.avg(e * e)), 4).alias("rmse"))
    tails = exact_quantiles(rows, by, F.abs(e), [0.9, 0.99]).alias("t")
    met = means.alias("m").join(tails, [F.col(f"m.{c}").eqNullSafe(F.col(f"t.{c}")) for c in by], "left")
    return met.select("m.*", F.round("q0", 4).alias("p90"), F.round("q1", 4).alias("p99"))


def interval_coverage(rows: DataFrame, groups: list[str], level: float = 0.72) -> DataFrame:
    """Share of actuals within the interval (absent bounds count as misses) and its mean width: in all and by each group.

    The half width is the ``level`` quantile of absolute residuals over all rows, a single number.
    """
    kept = written(rows.select(*groups, F.abs(F.col("actual") - F.col("predicted")).alias("off")), "residuals")
    half = exact_quantiles(kept, [], F.col("off"), [level]).select(F.col("q0").alias("half"))
    inside = F.coalesce((F.col("off") <= F.col("half")).cast("int"), F.lit(0))
    counted = kept.join(F.broadcast(half)).groupBy(*groups, "half").agg(F.count("*").alias("rows"), F.sum(inside).alias("inside"))
    sets = [[], *[[g] for g in groups]]
    agg = [F.sum("rows").alias("n"), r6(F.sum("inside") / F.sum("rows")).alias("coverage"), F.round(2 * F.max("half"), 4).alias("width")]
    return counted.groupingSets([[F.col(g) for g in s] for s in sets], *[F.col(g) for g in groups]).agg(*agg)


def drift_index(rows: DataFrame, value: str, late: Column, bins: int = 10) -> DataFrame:
    """Population stability index of ``value`` between rows before and after, over quantile bins of those before."""
    flagged = rows.select(F.col(value).alias("v"), late.alias("late")).where("v IS NOT NULL AND late IS NOT NULL")
    cuts = exact_quantiles(flagged.where("NOT late"), [], F.col("v"), [k / bins for k in range(1, bins)]).select(F.array(*[f"q{k}" for k in range(bins - 1)]).alias("cuts"))
    binned = flagged.join(F.broadcast(cuts)).withColumn("bin", F.size(F.filter("cuts", lambda c: c < F.col("v"))))
    counts = binned.groupBy("bin").agg(F.count_if(~F.col("late")).alias("before"), F.count_if(F.col("late")).alias("after"))
    total = counts.agg(F.sum("before").alias("tb"), F.sum("after").alias("ta"))
    p, q = (F.greatest(F.col(c) / F.col(t), F.lit(1e-6)) for c, t in (("before", "tb"), ("after", "ta")))
    return counts.join(F.broadcast(total)).select("bin", "before", "after", r6((q - p) * F.log(q / p)).alias("psi_part"))


def breach_runs(series: DataFrame, limit: Column, least: int = 3) -> DataFrame:
    """Runs of at least ``least`` consecutive steps beyond ``limit``: start, length."""
    hit = series.where(limit).withColumn("run", F.col("t") - F.row_number().over(_order()))
    return hit.groupBy("series_id", "run").agg(F.min("t").alias("start"), F.count("*").alias("length")).where(F.col("length") >= least).drop("run")


def model_tradeoff(filled: DataFrame, window: int = 72) -> DataFrame:
    """Errors of two simple forecasts (the step before, the day before) by window: their means and variances, and the better one."""
    lagged = filled.withColumns({"a": F.lag("value", 1).over(_order()), "b": F.lag("value", 24).over(_order())}).where("b IS NOT NULL")
    by = lagged.groupBy("series_id", F.floor(F.col("t") / window).cast("int").alias("w")).agg(F.avg(F.abs(F.col("value") - F.col("a"))).alias("ea"), F.avg(F.abs(F.col("value") - F.col("b"))).alias("eb"))
    return by.groupBy("series_id").agg(
        F.count("*").alias("windows"), r6(F.avg("ea")).alias("mae_last"), r6(F.avg("eb")).alias("mae_day"), r6(F.var_pop("ea")).alias("var_last"), r6(F.var_pop("eb")).alias("var_day"),
        F.count_if(F.col("ea") < F.col("eb")).alias("last_wins"),
    )


def residual_spread(rows: DataFrame, bins: int = 8) -> DataFrame:
    """Variance of residuals by bins of the predicted value, cut at its quantiles."""
    cuts = exact_quantiles(rows, [], F.col("predicted"), [k / bins for k in range(1, bins)]).select(F.array(*[f"q{k}" for k in range(bins - 1)]).alias("cuts"))
    binned = rows.join(F.broadcast(cuts)).withColumn("bin", F.size(F.filter("cuts", lambda c: c < F.col("predicted"))))
    e = F.col("actual") - F.col("predicted")
    return binned.groupBy("bin").agg(F.count("*").alias("n"), F.round(F.avg(e), 4).alias("bias"), F.round(F.stddev_pop(e), 4).alias("spread"))


def intermittency(points: DataFrame) -> DataFrame:
    """Points, share of small values and mean steps between the others, by series (for demand that comes and goes)."""
    order = Window.partitionBy("series_id").orderBy("t")
    on = points.where("NOT small").withColumn("gap", F.col("t") - F.lag("t").over(order)).groupBy("series_id").agg(r6(F.avg("gap")).alias("mean_gap"), F.max("gap").alias("max_gap"))
    return points.groupBy("series_id").agg(F.count("*").alias("n"), r6(F.avg(F.col("small").cast("int"))).alias("small_share")).join(on, "series_id", "left")


def circular_lag(filled: DataFrame, lag: int) -> DataFrame:
    """Values ``lag`` steps earlier, the start taken from the end of the series."""
    at = filled.withColumns({"i": F.row_number().over(_order()) - 1, "n": F.count("*").over(_series())})
    moved = at.select("series_id", F.pmod(F.col("i") + lag, F.col("n")).alias("i"), F.col("value").alias("lagged"))
    return at.join(moved, ["series_id", "i"]).select("series_id", "t", r6("lagged").alias("lagged"))


def training_review(curves: DataFrame) -> DataFrame:
    """For each run the step of the least validation loss, the gap at the end and how often validation turned."""
    order = Window.partitionBy("run").orderBy("step")
    d = F.col("validation") - F.lag("validation").over(order)
    turned = curves.withColumn("d", d).withColumn("turn", F.signum("d") != F.signum(F.lag("d").over(order)))
    last = F.max(F.struct("step", "train", "validation"))
    return turned.groupBy("run").agg(
        F.min(F.struct(r6("validation").alias("v"), "step"))["step"].alias("best_step"), r6(last["validation"] - last["train"]).alias("final_gap"),
        F.count_if(F.col("turn")).alias("turns"), F.max("step").alias("last_step"),
    )
