"""Generation that goes on where it stopped: outputs are kept with hashes of what they were made from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.shared import written

MANIFEST = "id string, place long, generator string, component_hash string, semantic_hash string, passed boolean, part string"


def content_hash(df: DataFrame, columns: list[str]) -> Column:
    """SHA-256 of the columns as JSON, in the order of their names; nulls count as values."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"}), 256)


def hashed(specs: DataFrame, id: str, place: str, volatile: list[str] = ()) -> DataFrame:  # noqa: A002
    """``specs`` with component_hash (of all but the id and place) and semantic_hash (without ``volatile`` columns too)."""
    own = [c for c in specs.columns if c not in (id, place)]
    return specs.withColumns({"component_hash": content_hash(specs, own), "semantic_hash": content_hash(specs, [c for c in own if c not in volatile])})


def resume_plan(specs: DataFrame, manifest: DataFrame, generator: str) -> DataFrame:
    """``specs`` (id, place, component_hash, semantic_hash) with ``reason`` and the ``part`` of what can be used again.

    The reason is null if an output can stay: made by this generator, of the same content or meaning, passed, and
    still there.  Else it's new, generator, changed, or failed.
    """
    old = manifest.select("id", F.col("generator").alias("by"), F.col("component_hash").alias("c"), F.col("semantic_hash").alias("s"), F.col("passed").alias("fine"), "part")
    same = (F.col("c") == F.col("component_hash")) | (F.col("s") == F.col("semantic_hash"))
    reason = F.when(F.col("part").isNull(), "new").when(F.col("by") != generator, "generator").when(~F.coalesce(same, F.lit(False)), "changed").when(~F.coalesce("fine", F.lit(False)), "failed")
    return specs.join(old, "id", "left").withColumn("reason", reason).select(*specs.columns, "reason", F.when(reason.isNull(), F.col("part")).alias("part"))


class Store:
    """Parts of output and manifests in a folder.

    Parts are written first and never changed; a manifest, written last, names the part of each output.  The newest
    manifest that was written whole counts, so a run that ends halfway leaves the one before in force.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _exists(self, path: str) -> bool:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where)

    def _version(self) -> int:
        n = 0
        while self._exists(f"{self.root}/manifest/{n + 1}/_SUCCESS"):
            n += 1
        return n

    def manifest(self) -> DataFrame:
        """The newest manifest's rows whose part is still there."""
        n = self._version()
        if not n:
            return self.spark.createDataFrame([], MANIFEST)
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest/{n}")
        gone = [r.part for r in rows.select("part").distinct().collect() if not self._exists(f"{self.root}/{r.part}/_SUCCESS")]
        return rows.where(~F.col("part").isin(gone)) if gone else rows

    def write_part(self, name: str, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/{name}")

    def commit(self, manifest: DataFrame) -> None:
        manifest.select(*[c.split()[0] for c in MANIFEST.split(", ")]).write.mode("overwrite").parquet(f"{self.root}/manifest/{self._version() + 1}")

    def next_run(self) -> str:
        return f"run-{self._version() + 1}"

    def read(self) -> DataFrame | None:
        """The outputs that the newest manifest names; None if there is none."""
        rows = self.manifest()
        parts = [r.part for r in rows.select("part").distinct().collect()]
        if not parts:
            return None
        out = None
        for part in parts:  # as many as blocks were made
            own = self.spark.read.parquet(f"{self.root}/{part}").join(rows.where(F.col("part") == part).select("id"), "id", "left_semi")
            out = own if out is None else out.unionByName(own)
        return out


def gap_free(rows: DataFrame) -> DataFrame:
    """The rows whose places, from 0, follow each other without a gap."""
    present = rows.select("place").distinct()
    missing = present.select((F.col("place") + 1).alias("place")).join(present, "place", "left_anti")
    starts = not present.where("place = 0").isEmpty()
    return rows.join(F.broadcast(missing.agg(F.min("place").alias("end"))), F.col("place") < F.col("end")).drop("end") if starts else rows.limit(0)


def generate(specs: DataFrame, make: Callable[[DataFrame], DataFrame], store: Store, generator: str, *, id: str, place: str, volatile: list[str] = (), block: int = 100_000) -> DataFrame:  # noqa: A002
    """Make the outputs of ``specs`` that aren't there yet; the plan with the reason of each that was made.

    ``make`` takes specs and gives rows with ``id`` and, if it judges them, ``passed``.  Specs go block by block of
    ``place`` (whole numbers from 0, unique); each block's rows are a part of their own.  If ``make`` fails, the
    manifest keeps what is there up to the first gap, the error goes on, and the next run makes only the rest.
    Specs without an output (``make`` gave no row) don't pass and are made again.
    """
    ready = written(hashed(specs, id, place, volatile).withColumnsRenamed({id: "id", place: "place"}), "specs")
    before = store.manifest()
    plan = written(resume_plan(ready, before, generator), "plan")
    run, done = store.next_run(), plan.where("reason IS NULL").select("id", "place", F.lit(generator).alias("generator"), "component_hash", "semantic_hash", F.lit(True).alias("passed"), "part")
    last = plan.agg(F.max("place")).first()[0]
    try:
        for first in range(0, (last if last is not None else -1) + 1, block):
            todo = plan.where(F.col("place").between(first, first + block - 1) & F.col("reason").isNotNull())
            if todo.isEmpty():
                continue
            part = f"{run}-{first}"
            made = make(todo.drop("reason", "part", "component_hash", "semantic_hash").withColumnRenamed("id", id)).withColumnRenamed(id, "id")
            store.write_part(part, made)
            rows = store.spark.read.parquet(f"{store.root}/{part}")
            fine = F.bool_and("passed") if "passed" in rows.columns else F.lit(True)
            judged = rows.groupBy("id").agg(fine.alias("passed"))
            done = done.unionByName(todo.join(judged, "id").select("id", "place", F.lit(generator).alias("generator"), "component_hash", "semantic_hash", "passed", F.lit(part).alias("part")))
    except Exception:
        store.commit(gap_free(done.where("passed")))
        raise
    store.commit(done)
    return plan.select("id", "place", "reason")
