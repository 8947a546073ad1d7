"""Deterministic planning: hash-ordered picks, integer quotas, schedules, and ordered assignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.hashing import bucket, stable_hash, unit_interval
from tidemark.operators.matching import assign
from tidemark.shared import numbered


def stratified_sample(rows: DataFrame, strata: list[str], key: str, k: int, seed: str) -> DataFrame:
    """The ``k`` rows of each stratum with the least hash of seed and key; all rows if ``k`` is not positive.

    A rank limited to ``k`` keeps only that many rows of a stratum in each task before the shuffle.
    """
    if k <= 0:
        return rows
    order = Window.partitionBy(*strata).orderBy("__h", key)
    picked = rows.withColumn("__h", stable_hash(seed, F.col(key))).withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= k)
    return picked.drop("__h", "__n")


def quotas(weights: DataFrame, total: Column | int, name: str = "level", weight: str = "weight") -> DataFrame:
    """Whole quotas that sum to ``total`` in proportion to the weights, by largest remainders (ties by name)."""
    whole = Window.partitionBy()
    exact = F.col(weight) / F.sum(weight).over(whole) * total
    parts = weights.withColumn("exact", exact).withColumn("base", F.floor("exact").cast("long"))
    left = F.lit(total) - F.sum("base").over(whole)
    nth = F.row_number().over(Window.orderBy((F.round(F.col("exact") - F.col("base"), 9)).desc(), name))
    return parts.withColumn("left", left).withColumn("nth", nth).select(name, (F.col("base") + (F.col("nth") <= F.col("left")).cast("long")).alias("quota"))


def spread_levels(rows: DataFrame, key: str, levels: list[tuple[str, float]], seed: str) -> DataFrame:
    """Give each row a level so that the levels meet their quotas, in the order of a hash.

    The ranks of all rows come from a bucket of the hash and the sizes of the buckets before, so no task
    sorts the whole table.
    """
    spark = rows.sparkSession
    total = rows.count()
    digest = stable_hash(seed, F.col(key))
    part = rows.select(key, digest.alias("h")).withColumn("bucket", F.substring("h", 1, 3))
    sizes = part.groupBy("bucket").count()
    first = sizes.select("bucket", F.coalesce(F.sum("count").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    ranked = part.join(F.broadcast(first), "bucket").withColumn("rank", F.col("first") + F.row_number().over(Window.partitionBy("bucket").orderBy("h", key)) - 1)
    plan = quotas(spark.createDataFrame(levels, "level string, weight double"), total)
    edges = plan.select("level", F.coalesce(F.sum("quota").over(Window.orderBy("level").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("lo"), F.sum("quota").over(Window.orderBy("level")).alias("hi"))
    return ranked.join(F.broadcast(edges), (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))).select(key, "level", "rank")


def modality(rows: DataFrame, key: str, group: str, mix: list[tuple[str, float]], seed: str) -> DataFrame:
    """A weighted modality for each row by its hash; the first and last of each group are patched to differ.

    The first row of a group (by key) takes the first modality and the last one the second, so that every
    group has both.
    """
    u = unit_interval(stable_hash(seed, F.col(key)))
    total, cumulative = sum(w for _, w in mix), 0.0
    pick = None
    for name, w in mix[:-1]:
        cumulative += w / total
        pick = (F.when(u < cumulative, name) if pick is None else pick.when(u < cumulative, name))
    ends = rows.groupBy(group).agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
    return rows.join(ends, group).select(key, group, F.when(F.col(key) == F.col("lo"), mix[0][0]).when(F.col(key) == F.col("hi"), mix[1][0]).otherwise(pick.otherwise(mix[-1][0])).alias("modality"))


def expression_profile(rows: DataFrame, key: str, styles: int = 8) -> DataFrame:
    return rows.select(key, bucket(stable_hash("style", F.col(key)), styles).alias("style"))


def tool_pool(needs: DataFrame, tools: DataFrame, size: int, seed: str) -> DataFrame:
    """For each question its preferred tools, filled up in hash order to ``size``.

    ``needs`` has question and preferred (an array); ``tools`` has name, a catalogue of bounded length.
    """
    catalogue = tools.agg(F.array_sort(F.collect_set("name")).alias("names"))
    rest = F.array_sort(F.transform(F.array_except("names", "preferred"), lambda t: F.struct(stable_hash(seed, F.col("question"), t).alias("h"), t.alias("t"))))
    joined = needs.join(F.broadcast(catalogue))
    kept = F.slice(F.array_distinct(F.concat("preferred", F.transform(rest, lambda x: x["t"]))), 1, size)
    return joined.select("question", F.posexplode(kept).alias("place", "tool"))


def interleaved_schedule(counts: DataFrame) -> DataFrame:
    """task and quota to a round-robin order: first of each task, then second ..., with the place in all."""
    rounds = counts.where("quota > 0").select("task", F.explode(F.sequence(F.lit(1), "quota")).alias("round"))
    return numbered(rounds, "round", "task").select("task", "round", (F.col("place") + 1).cast("int").alias("place"))


def assign_in_order(specs: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Each spec, in order, takes the first unused scenario that fits; leftovers go round the fitting specs.

    ``specs`` has task, spec, ord and pattern, ``scenarios`` task, scenario, ord and pattern (a null spec
    pattern fits all); see matching.assign.
    """
    one = F.when(F.col("pattern").isNotNull(), F.array("pattern"))
    return assign(specs.select("task", "spec", "ord", one.alias("patterns")), scenarios)


def split_by_group(rows: DataFrame, group: str, shares: tuple[int, int] = (80, 10)) -> DataFrame:
    """train, valid or test by a hash of the group, so that a group is never split."""
    b = bucket(stable_hash("split", F.col(group)), 100)
    return rows.withColumn("split", F.when(b < shares[0], "train").when(b < shares[0] + shares[1], "valid").otherwise("test"))
