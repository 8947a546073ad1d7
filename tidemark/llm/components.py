"""Connected components by alternating star contractions; no step gathers a node's neighbours in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, materialise, release


def _hang(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with the least of u and its neighbours as m."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def _two(edges: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """Rows (u, v) of each of the ``pairs`` of columns; ``edges`` are read once."""
    return edges.select(F.inline(F.array(*[F.struct(F.col(a).alias("u"), F.col(b).alias("v")) for a, b in pairs])))


def _stars(edges: DataFrame) -> bool:
    """Whether each node hangs on one other at most and nothing hangs on it then: nothing is left to contract."""
    ends = edges.select(F.inline(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1 AND up > 0").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the undirected ``edges`` (a, b); the component is its least node.

    Hubs are met by partial minima and a join that Spark can split; each round is written to the shared
    folder, as is the result.  The number of rounds grows with the logarithm of the longest path.  An empty table
    has no components.
    """
    spark = edges.sparkSession
    now = materialise(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    while not _stars(now):
        large = _hang(_two(now, ("u", "v"), ("v", "u"))).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # a node's neighbours are all less than it now, so repeated edges change no minimum
        last, now = now, materialise(_two(_hang(large), ("v", "m"), ("u", "m")).where("u <> v").distinct(), "edges")
        discard(last)
        release(spark)
    roots = now.select(F.col("v").alias("node")).distinct()
    found = materialise(now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component"))), "components")
    discard(now)
    return found
