"""Tables in the folder that the whole cluster shares, and numbers for rows in an order."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@lru_cache(maxsize=1)
def _own_folder() -> str:
    return f"file://{tempfile.mkdtemp(prefix='tidemark-shared-')}"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in ``spark.checkpoint.dir``; only a local session without that setting (tests) gets its own folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = _own_folder()
    return f"{root.rstrip('/')}/tidemark-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: its lineage ends there, and every read sees the same rows."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt over all the session's shuffle partitions by ``keys`` (evenly without any).

    For rows that are small but cost much: by their bytes alone adaptive execution would put them into a few tasks.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


class Appended:
    """A table in the shared folder that grows by whole parts, one folder each; a part written again replaces itself."""

    def __init__(self, spark: SparkSession, schema, name: str):
        self.spark, self.schema, self.parts, self.root = spark, schema, [], shared_path(spark, name)

    def append(self, df: DataFrame) -> DataFrame:
        """Add ``df`` and return what was added."""
        path = f"{self.root}/part={len(self.parts)}"
        df.write.mode("overwrite").parquet(path)
        self.parts.append(path)
        return self.spark.read.schema(self.schema).parquet(path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*self.parts) if self.parts else self.spark.createDataFrame([], self.schema)


def numbered(df: DataFrame, *order: str | Column, name: str = "place") -> DataFrame:
    """``df`` with its place in an order (unique columns), from 0.

    Ranges of the order are numbered on their own; what lies before a range is a sum over the ranges' counts,
    of which there are as many as partitions.
    """
    by = [F.col(c) if isinstance(c, str) else c for c in order]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(df.repartitionByRange(parts, *by).withColumn("_part", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*by))
    return ranged.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + inside - 1).drop("_part", "_before")
