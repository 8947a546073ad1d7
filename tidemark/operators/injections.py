"""Events put into series at places and of sizes drawn from each series' name: changes, spikes, clusters, points odd for their context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.hashing import stable_hash, unit_interval

# Ranges of the places (shares of the length) and sizes, and the degrees that have more than a shift and spikes.
CHANGE_AT, SHIFT, SPREAD = (0.50, 0.70), (7.0, 16.0), (1.35, 2.4)
SPIKE_AT, SPIKE, SPIKES = (0.12, 0.88), (16.0, 30.0), 2
CLUSTER_AT, CLUSTER, CONTEXT_BEFORE, CONTEXT = (0.24, 0.78), (6.0, 12.0), 0.8, (0.35, 0.65)
WITH_SPREAD, WITHOUT_CLUSTER, WITH_CONTEXT = ("compositional", "confounded"), ("controlled",), ("confounded",)
#: Series with fewer points are left as they are.
LEAST = 12


def _draw(name: str, seed: str) -> Column:
    return unit_interval(stable_hash(seed, name, F.col("series_id")))


def _between(bounds: tuple[float, float], u: Column) -> Column:
    return bounds[0] + (bounds[1] - bounds[0]) * u


def _sized(bounds: tuple[float, float], name: str, seed: str) -> Column:
    """A size within the bounds, up or down."""
    return F.when(_draw(f"{name} sign", seed) < 0.5, -1.0).otherwise(1.0) * _between(bounds, _draw(name, seed))


def event_plan(series: DataFrame, seed: str = "events") -> DataFrame:
    """What happens to each series: ``series`` has series_id, n (its points) and complexity.

    Adds change (place), shift, spread (null if the spread stays), spike_1, spike_2 (two places), size_1, size_2,
    cluster (start, null if none), cluster_end, cluster_size and context (a factor, null if none).  All are null for a
    series shorter than LEAST; an unknown complexity has a cluster, as only a controlled one has none.
    """
    n = F.col("n")
    low, high = F.greatest(F.lit(2), F.floor(n * SPIKE_AT[0])), F.least(n - 2, F.floor(n * SPIKE_AT[1]))
    wide = high - low
    first = low + F.floor(_draw("spike 1", seed) * wide)
    start = F.floor(n * _between(CLUSTER_AT, _draw("cluster at", seed)))
    kind = F.coalesce("complexity", F.lit(""))
    plan = {
        "change": F.floor(n * _between(CHANGE_AT, _draw("change", seed))), "shift": _sized(SHIFT, "shift", seed), "spread": F.when(kind.isin(*WITH_SPREAD), _between(SPREAD, _draw("spread", seed))),
        "spike_1": first, "spike_2": low + (first - low + 1 + F.floor(_draw("spike 2", seed) * (wide - 1))) % wide,
        "size_1": _sized(SPIKE, "size 1", seed), "size_2": _sized(SPIKE, "size 2", seed),
        "cluster": F.when(~kind.isin(*WITHOUT_CLUSTER), start), "cluster_end": F.when(~kind.isin(*WITHOUT_CLUSTER), F.least(n, start + F.greatest(F.lit(3), F.floor(n / 80)))),
        "cluster_size": F.when(~kind.isin(*WITHOUT_CLUSTER), _sized(CLUSTER, "cluster", seed)), "context": F.when(kind.isin(*WITH_CONTEXT), _between(CONTEXT, _draw("context", seed))),
    }
    return series.select("series_id", "n", "complexity", *[F.when(n >= LEAST, c).alias(name) for name, c in plan.items()])


def inject_events(panel: DataFrame, complexity: DataFrame, seed: str = "events") -> tuple[DataFrame, DataFrame]:
    """The panel (series_id, t, value) with events and the kinds that touched each point, and the hidden truth of each series.

    ``complexity`` has series_id and complexity, a row a series.  In this order: the values from the change on shift, and
    there spread about their mean; two points spike; a run of points is off; the highest of the first four fifths shrinks.
    Points of a series stand by t (equal ones by value); null values stay null and can't be the highest.  A series is
    worked on by windows, so one of them is bounded by its time axis.
    """
    sizes = panel.groupBy("series_id").agg(F.count("*").alias("n"))
    plan = event_plan(sizes.join(complexity.select("series_id", "complexity"), "series_id", "left"), seed)
    by = Window.partitionBy("series_id")
    i = F.col("i")
    put = panel.withColumn("i", F.row_number().over(by.orderBy("t", "value")) - 1).join(plan, "series_id")
    after = F.coalesce(i >= F.col("change"), F.lit(False))
    shifted = put.withColumn("v", F.when(after, F.col("value") + F.col("shift")).otherwise(F.col("value")))
    mean = F.avg(F.when(after, F.col("v"))).over(by)
    spread = shifted.withColumn("m", mean).withColumn("v", F.when(after & F.col("spread").isNotNull(), F.col("m") + F.col("spread") * (F.col("v") - F.col("m"))).otherwise(F.col("v")))
    is_1, is_2 = F.coalesce(i == F.col("spike_1"), F.lit(False)), F.coalesce(i == F.col("spike_2"), F.lit(False))
    in_run = F.coalesce((i >= F.col("cluster")) & (i < F.col("cluster_end")), F.lit(False))
    off = F.when(is_1, F.col("size_1")).when(is_2, F.col("size_2")).otherwise(0.0) + F.when(in_run, F.col("cluster_size")).otherwise(0.0)
    raised = spread.withColumn("v", F.col("v") + off)
    early = F.col("context").isNotNull() & (i < F.greatest(F.lit(3), F.floor(F.col("n") * CONTEXT_BEFORE))) & F.col("v").isNotNull()
    ranked = raised.withColumn("top", F.max(F.when(early, F.struct("v", -i))).over(by))
    at = -F.col("top.col2")
    is_top = F.coalesce(i == at, F.lit(False))
    kinds = F.array_compact(F.array(F.when(after, "change"), F.when(is_1 | is_2, "spike"), F.when(in_run, "cluster"), F.when(is_top, "contextual")))
    out = ranked.select("series_id", "t", F.when(is_top, F.col("v") * F.col("context")).otherwise(F.col("v")).alias("value"), kinds.alias("kinds"))
    context = ranked.groupBy("series_id").agg(F.max(at).alias("contextual"))
    return out, plan.join(context, "series_id")
