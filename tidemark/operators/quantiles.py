"""Exact quantiles and counts of what came before, without a task that holds a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.shared import written

#: A wanted rank is looked for among one in so many of a group's rows to either side of it.
BUCKETS = 256


def exact_quantiles(rows: DataFrame, by: list[str], value: Column, shares: list[float], buckets: int = BUCKETS) -> DataFrame:
    """``by`` and q0, q1, ...: the quantiles of ``value`` at ``shares`` with linear interpolation, nulls left out.

    A sketch gives two cuts around each wanted rank of a group; the rows between cuts are counted, which tells exactly
    where the rank lies, and only the values there are counted one by one and put in order.  Neither cuts nor counts
    need the rows to be dealt out.  Without ``by`` there is one row; a group without values, or an empty table, makes none.
    """
    keys = by or ["all_rows"]
    keyed = rows.select(*by, value.cast("double").alias("v")) if by else rows.select(F.lit(0).alias("all_rows"), value.cast("double").alias("v"))
    values = written(keyed.where("v IS NOT NULL"), "values")
    around = [min(max(p + side / buckets, 0.0), 1.0) for p in shares for side in (-1, 1)]
    # written, so that Spark knows how few rows they are
    cuts = written(values.groupBy(*keys).agg(F.percentile_approx("v", around, 8 * buckets).alias("cuts"), F.count("*").alias("n")), "cuts")
    same = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys]
    bucket = sum(((F.get("cuts", F.lit(i)) < F.col("v")).cast("int") for i in range(len(around))), F.lit(0))
    placed = values.alias("x").join(cuts.alias("y"), same("x", "y")).select(*[f"x.{k}" for k in keys], "v", "n", bucket.alias("bucket"))
    sums = placed.groupBy(*keys, "bucket").agg(F.count("*").alias("inside"), F.first("n").alias("n"))
    before = F.sum("inside").over(Window.partitionBy(*keys).orderBy("bucket")) - F.col("inside")
    at = [(F.col("n") - 1) * F.lit(float(p)) for p in shares]
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(h), F.ceil(h)) for h in at])))
    wanted = sums.withColumns({"before": before, "ranks": ranks})
    wanted = wanted.withColumn("ranks", F.filter("ranks", lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("inside")))).where(F.size("ranks") > 0)
    wanted = written(wanted, "wanted")
    few = placed.drop("n").alias("x").join(wanted.alias("y"), [*same("x", "y"), F.col("x.bucket") == F.col("y.bucket")]).select(*[f"x.{k}" for k in keys], "x.bucket", "v", "n", "before", "ranks")
    few = few.groupBy(*keys, "bucket", "v").agg(F.count("*").alias("c"), *[F.first(c).alias(c) for c in ("n", "before", "ranks")])
    upto = F.sum("c").over(Window.partitionBy(*keys, "bucket").orderBy("v")) + F.col("before")
    ranked = few.withColumn("upto", upto).select(*keys, "n", "v", F.explode(F.filter("ranks", lambda r: (r >= F.col("upto") - F.col("c")) & (r < F.col("upto")))).alias("rank"))
    ends = [c for i, h in enumerate(at) for c in (F.max(F.when(F.col("rank") == F.floor(h), F.col("v"))).alias(f"low{i}"), F.max(F.when(F.col("rank") == F.ceil(h), F.col("v"))).alias(f"high{i}"))]
    met = ranked.groupBy(*keys, "n").agg(*ends)
    out = [(F.col(f"low{i}") + (F.col(f"high{i}") - F.col(f"low{i}")) * (h - F.floor(h))).alias(f"q{i}") for i, h in enumerate(at)]
    return met.select(*by, *out)


def earlier_rows(rows: DataFrame, key: str, group: str, name: str = "earlier") -> DataFrame:
    """``rows`` with the number of rows of the same ``group`` before each by ``key`` (unique, not null).

    Rows are cut into ranges of the key; counts by group and range are summed along the ranges, and only rows of one
    group within one range are put in order.  Rows with a null group make a group of their own.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(rows.repartitionByRange(parts, key).withColumn("_range", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy(group, "_range").agg(F.count("*").alias("_n"))
    before = counts.select(F.col(group).alias("_g"), F.col("_range").alias("_r"), (F.sum("_n").over(Window.partitionBy(group).orderBy("_range")) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(group, "_range").orderBy(key)) - 1
    met = ranged.withColumn("_inside", inside).join(before, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_range") == F.col("_r")))
    return met.select(*rows.columns, (F.col("_before") + F.col("_inside")).alias(name))
