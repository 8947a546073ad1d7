"""Further column work on panels: five-number profiles, variance splits, ways to fill gaps, defects of the time index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def _series() -> WindowSpec:
    return Window.partitionBy("series_id")


def _order() -> WindowSpec:
    return _series().orderBy("t")


def channel_profile(grid: DataFrame) -> DataFrame:
    """First and last time, quartiles, whiskers and how many values lie beyond them, by series; missing values play no part."""
    seen = grid.where(F.col("value").isNotNull() & ~F.isnan("value"))
    q = lambda p: F.percentile("value", F.lit(p))
    five = seen.groupBy("series_id").agg(
        F.count("*").alias("n"), F.min("t").alias("first_t"), F.max("t").alias("last_t"),
        F.min("value").alias("min"), q(0.25).alias("q1"), q(0.5).alias("median"), q(0.75).alias("q3"), F.max("value").alias("max"),
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    held = seen.join(five, "series_id").withColumn("inside", (F.col("value") >= F.col("q1") - reach) & (F.col("value") <= F.col("q3") + reach))
    keys = ["series_id", "n", "first_t", "last_t", "min", "q1", "median", "q3", "max"]
    box = held.groupBy(*keys).agg(F.min(F.when(F.col("inside"), F.col("value"))).alias("low"), F.max(F.when(F.col("inside"), F.col("value"))).alias("high"), F.count_if(~F.col("inside")).alias("beyond"))
    return box.select("series_id", "n", "first_t", "last_t", *[F.round(c, 6).alias(c) for c in ("min", "q1", "median", "q3", "max", "low", "high")], "beyond")


def variance_change(filled: DataFrame) -> DataFrame:
    """The split with the largest log ratio of the variances before and after it, by running sums of squares.

    Splits leave at least 18 % of the points and four on either side; a side without variance is no split.
    """
    run = _order().rowsBetween(Window.unboundedPreceding, -1)
    x = filled.withColumn("x", F.col("value") - F.avg("value").over(_series()))
    sums = x.withColumns(
        {
            "i": F.row_number().over(_order()) - 1, "n": F.count("*").over(_series()),
            "s": F.sum("x").over(run), "q": F.sum(F.col("x") * F.col("x")).over(run),
            "s_all": F.sum("x").over(_series()), "q_all": F.sum(F.col("x") * F.col("x")).over(_series()),
        }
    )
    low, high = F.greatest(F.lit(4), F.floor(F.col("n") * 0.18)), F.least(F.col("n") - 4, F.floor(F.col("n") * 0.82))
    splits = sums.where((F.col("i") >= low) & (F.col("i") < high))
    spread = lambda q, s, n: q / n - (s / n) * (s / n)
    before = spread(F.col("q"), F.col("s"), F.col("i"))
    after = spread(F.col("q_all") - F.col("q"), F.col("s_all") - F.col("s"), F.col("n") - F.col("i"))
    scored = splits.withColumns({"before": before, "after": after}).where("before > 0 AND after > 0").withColumn("score", F.round(F.abs(F.log(F.col("after") / F.col("before"))), 6))
    best = scored.groupBy("series_id").agg(F.max(F.struct("score", -F.col("i"), "t")).alias("m"))
    return best.select("series_id", F.col("m.t").alias("t"), F.col("m.score").alias("score"))


def gap_fills(grid: DataFrame, period: int = 24) -> DataFrame:
    """Each missing point with the values that four ways give it: the last one, a line, the same phase's mean, the series' mean.

    A way that has nothing to go by gives null; a line is level beyond the ends.
    """
    from tidemark.operators.panel import interpolated

    back = _order().rowsBetween(Window.unboundedPreceding, 0)
    phase = Window.partitionBy("series_id", F.pmod("t", F.lit(period)))
    ways = grid.withColumns({"forward": F.last("value", ignorenulls=True).over(back), "seasonal": F.avg("value").over(phase), "mean": F.avg("value").over(_series())})
    line = interpolated(grid).select("series_id", "t", F.col("value").alias("linear"))
    return ways.where("value IS NULL").join(line, ["series_id", "t"]).select("series_id", "t", *[F.round(c, 6).alias(c) for c in ("forward", "linear", "seasonal", "mean")])


def portmanteau_p(q: Column, lags: int = 10) -> Column:
    """Chance of a chi-square of an even number of degrees beyond ``q``, in closed form."""
    if lags % 2:
        raise ValueError("the closed form needs an even number of lags")
    half, term, total = q / 2, F.lit(1.0), F.lit(1.0)
    for k in range(1, lags // 2):
        term = term * half / k
        total = total + term
    return F.exp(-half) * total


def white_noise(acf: DataFrame, lags: int = 10, level: float = 0.05) -> DataFrame:
    """The portmanteau statistic with its p-value, and whether the series looks like white noise at ``level``."""
    from tidemark.operators.diagnostics import ljung_box

    p = F.round(portmanteau_p(F.col("q"), lags), 6)
    return ljung_box(acf, lags).where(F.col("lags") == lags).select("series_id", "n", "q", p.alias("p_value"), (p > level).alias("white"))


def index_defects(grid: DataFrame, *, every: int = 50, gap: int = 70, swap: int = 90) -> DataFrame:
    """The panel with a spoilt time index: position, series_id, t, value and which defect a row is of.

    Every ``every``-th time stands twice, three times in each ``gap`` are left out, and at each ``swap``-th
    two neighbours change places.  The place is that of the row in the spoilt order; copies share it.
    """
    kept = grid.where(F.pmod("t", F.lit(gap)) >= 3)
    twice = kept.where(F.pmod("t", F.lit(every)) == 0).withColumn("defect", F.lit("duplicate"))
    at = F.pmod("t", F.lit(swap))
    moved = F.when(at == 10, F.col("t") + 1).when(at == 11, F.col("t") - 1).otherwise(F.col("t"))
    all_rows = kept.withColumn("defect", F.when((at == 10) | (at == 11), "unsorted").otherwise("none")).unionByName(twice)
    return all_rows.select(moved.alias("position"), "series_id", "t", "value", "defect")


def missingness(grid: DataFrame, *, share: float = 0.05, top: float = 0.9) -> DataFrame:
    """Points that each of four mechanisms takes away: a block, scattered points, large values, and one stretch of all series."""
    n = F.count("*").over(_series())
    i = F.row_number().over(_order()) - 1
    cut = grid.groupBy("series_id").agg(F.percentile("value", F.lit(top)).alias("cut"))
    rows = grid.withColumns({"i": i, "n": n}).join(F.broadcast(cut), "series_id")
    block = (F.col("i") >= F.floor(F.col("n") * 0.4)) & (F.col("i") < F.floor(F.col("n") * (0.4 + share)))
    scattered = F.pmod(F.col("t") * 7919 + F.length("series_id") * 104729, F.lit(1000)) < int(1000 * share)
    bounds = grid.agg(F.min("t").alias("t0"), F.max("t").alias("t1"))
    joined = rows.join(F.broadcast(bounds))
    together = (F.col("t") >= F.col("t0") + F.floor((F.col("t1") - F.col("t0")) * 0.7)) & (F.col("t") < F.col("t0") + F.floor((F.col("t1") - F.col("t0")) * (0.7 + share)))
    flags = {"block": block, "random": scattered, "value_dependent": F.coalesce(F.col("value") > F.col("cut"), F.lit(False)), "synchronous": together}
    kinds = F.filter(F.array(*[F.when(c, F.lit(k)) for k, c in flags.items()]), lambda k: k.isNotNull())
    return joined.select("series_id", "t", F.explode(kinds).alias("mechanism"))
