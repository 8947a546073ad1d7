"""Clusters of series by their links, and the series that stands for each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.shared import written


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, cluster) of each of ``nodes``: the least node that ``edges`` (a, b) connect it with.

    Each round a node takes the least label next to it and then that label's own label, so labels cross a chain
    in a number of rounds that grows with the logarithm of its length.  Labels only fall; the rounds end when none
    does.  Nodes without edges are clusters of their own, edges to unknown nodes are left out.
    """
    known = written(nodes.select("node").where("node IS NOT NULL").distinct(), "nodes")
    inside = edges.select("a", "b").where("a <> b").join(known.withColumnRenamed("node", "a"), "a", "left_semi").join(known.withColumnRenamed("node", "b"), "b", "left_semi")
    both = written(inside.unionByName(inside.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    now = written(known.select("node", F.col("node").alias("cluster")), "labels")
    while True:
        near = both.join(now.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("cluster").alias("near"))
        lower = now.join(near, "node", "left").select("node", F.col("cluster").alias("old"), F.least("cluster", "near").alias("low"))
        # who bears an old label may take what its first bearer came to
        hooks = lower.groupBy(F.col("old").alias("label")).agg(F.min("low").alias("hook"))
        hooked = written(lower.join(hooks, F.col("old") == F.col("label")).select("node", "old", F.least("low", "hook").alias("low")), "hooked")
        jump = hooked.select(F.col("node").alias("label"), F.col("low").alias("jump"))
        after = written(hooked.join(jump, F.col("low") == F.col("label"), "left").select("node", "old", F.least("low", "jump").alias("cluster")), "labels")
        now = after.select("node", "cluster")
        if after.where("old <> cluster").isEmpty():
            return now


def series_clusters(pairs: DataFrame, r: str = "raw_r", threshold: float = 0.5) -> DataFrame:
    """Each series with its cluster (by links of at least ``threshold``), the cluster's size, medoid and own distance.

    ``pairs`` has a, b and r; a distance is 1 - r, and a medoid has the least sum of distances to the others of
    its cluster (ties by name).  Sums are partial sums over pairs, so no cluster is gathered.  An undefined r
    links nothing and counts as a distance of 1.
    """
    names = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    own = written(components(pairs.where(F.col(r) >= threshold), names), "clusters")
    sides = pairs.select("a", "b", (1 - F.coalesce(F.col(r), F.lit(0.0))).alias("d"))
    of = lambda c: own.select(F.col("node").alias(c), F.col("cluster").alias(f"c{c}"))
    inside = sides.join(of("a"), "a").join(of("b"), "b").where("ca = cb")
    each = inside.select(F.explode(F.array("a", "b")).alias("node"), "d").groupBy("node").agg(F.sum("d").alias("far"))
    summed = written(own.join(each, "node", "left").withColumn("far", F.round(F.coalesce("far", F.lit(0.0)), 9)), "sums")
    best = summed.groupBy("cluster").agg(F.min(F.struct("far", "node")).alias("m"), F.count("*").cast("int").alias("size"))
    mean = F.when(F.col("size") > 1, F.col("far") / (F.col("size") - 1)).otherwise(0.0)
    return summed.join(best, "cluster").select(F.col("node").alias("series_id"), "cluster", "size", F.col("m.node").alias("medoid"), F.round(mean, 6).alias("mean_distance"))


def global_or_local(clusters: DataFrame) -> DataFrame:
    """For all series together: clusters, share of series in the largest, mean distance, and what model that suggests.

    One model for all if the largest cluster has nine tenths, one for each cluster if clusters of two and more have
    half of the series, else one for each series.
    """
    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("n"), F.sum("mean_distance").alias("d"))
    whole = sizes.agg(F.count("*").alias("clusters"), F.sum("n").alias("series"), F.max("n").alias("largest"), F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("grouped"), F.sum("d").alias("d"))
    advice = F.when(F.col("largest") >= 0.9 * F.col("series"), "global").when(F.col("grouped") >= 0.5 * F.col("series"), "by_cluster").otherwise("local")
    return whole.where("series > 0").select("clusters", "series", F.round(F.col("largest") / F.col("series"), 4).alias("largest_share"), F.round(F.col("d") / F.col("series"), 6).alias("mean_distance"), advice.alias("advice"))
