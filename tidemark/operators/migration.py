"""Panels of an older layout brought into the present one: wide rows, what must not change, records and a report."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Parts of a truth's generator that a migration may set; all else is its meaning.
SETTABLE = ("version", "migration")


def _semantic(text: str) -> str:
    truth = json.loads(text)
    generator = truth.get("generator", {}) if isinstance(truth, dict) else None
    if isinstance(generator, dict):
        # a generator that holds nothing else is as good as none
        kept = {k: v for k, v in generator.items() if k not in SETTABLE}
        truth = {k: v for k, v in truth.items() if k != "generator"} | ({"generator": kept} if kept else {})
    return json.dumps(truth, ensure_ascii=False, sort_keys=True)


def semantic_hash(truth: Column) -> Column:
    """SHA-256 of a truth (a JSON text) without what a migration may set, whatever the order of its keys; null where it isn't JSON."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        def one(text):
            try:
                return hashlib.sha256(_semantic(text).encode()).hexdigest()
            except (TypeError, ValueError):
                return None

        return texts.map(one)

    return run(truth)


def marked_truth(truth: Column, version: str, source_version: Column, source_hash: Column) -> Column:
    """The truth with the version and where it came from set in its generator; null where it isn't a JSON object."""

    @F.pandas_udf("string")
    def run(texts: pd.Series, versions: pd.Series, hashes: pd.Series) -> pd.Series:
        def one(text, old, digest):
            try:
                found = json.loads(text)
                generator = dict(found.get("generator") or {}) | {"version": version, "migration": {"source_generator_version": old, "source_scenario_hash": digest}}
                return json.dumps(found | {"generator": generator}, ensure_ascii=False, sort_keys=True)
            except (AttributeError, TypeError, ValueError):
                return None

        return pd.Series([one(*row) for row in zip(texts, versions, hashes, strict=True)])

    return run(truth, source_version, source_hash)


def wide_rows(panels: DataFrame) -> DataFrame:
    """id, time, occurrence and values (alias to value): a row for each time, repeated points in rows of their own.

    ``panels`` has id, time, series_id and value.  A scenario's series are s01, s02 ... by their names; the nth point of a
    series at a time has occurrence n - 1, so none is lost or averaged.  Points without a series or time stay out
    (they are counted as source rows, so the record isn't preserved).
    """
    placed = panels.where("series_id IS NOT NULL AND time IS NOT NULL")
    names = placed.select("id", "series_id").distinct().withColumn("alias", F.format_string("s%02d", F.row_number().over(Window.partitionBy("id").orderBy("series_id"))))
    nth = F.row_number().over(Window.partitionBy("id", "time", "series_id").orderBy("value")) - 1
    named = placed.withColumn("occurrence", nth).join(names, ["id", "series_id"])
    return named.groupBy("id", "time", "occurrence").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("alias", "value")))).alias("values"))


def migrated(scenarios: DataFrame, panels: DataFrame, wide: DataFrame, version: str, previous: DataFrame | None = None) -> DataFrame:
    """A record for each scenario: its counts before and after, the new truth, its hashes and why it failed (flags).

    ``scenarios`` has id, version, scenario_hash and truth; ``wide`` are the ``wide_rows`` of ``panels``.  Scenarios that
    ``previous`` (id, source_scenario_hash, flags) has from the same source without a flag are left out: nothing changed.
    Flags: truth_changed (also one that isn't an object), rows_lost, duplicates_changed, no_rows.
    """
    todo = scenarios
    if previous is not None:
        whole = previous.where(F.size("flags") == 0).select("id", F.col("source_scenario_hash").alias("h"))
        todo = scenarios.join(whole, (scenarios["id"] == whole["id"]) & scenarios["scenario_hash"].eqNullSafe(whole["h"]), "left_anti")
    points = panels.groupBy("id", "series_id", "time").agg(F.count("*").alias("n")).groupBy("id").agg(F.sum("n").alias("source_rows"), F.sum(F.col("n") - 1).alias("source_duplicates"))
    held = F.size("values")
    rows = wide.groupBy("id", "time").agg(F.count("*").alias("rows"), F.sum(held).alias("held"), F.sum(F.when(F.col("occurrence") > 0, held).otherwise(0)).alias("again"))
    counts = rows.groupBy("id").agg(F.sum("rows").alias("wide_rows"), F.sum(F.col("rows") - 1).alias("wide_duplicate_times"), F.sum("held").alias("held"), F.sum("again").alias("again"))
    met = todo.join(points, "id", "left").join(counts, "id", "left")
    # the truth is marked before it is hashed again, so that the check sees what is stored
    marked = met.withColumn("new_truth", marked_truth(F.col("truth"), version, F.col("version"), F.col("scenario_hash")))
    hashed = marked.withColumns({"semantic_sha256": semantic_hash(F.col("truth")), "kept_sha256": semantic_hash(F.col("new_truth"))})
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    same = F.coalesce(F.col("semantic_sha256") == F.col("kept_sha256"), F.lit(False))
    flags = F.array_compact(F.array(F.when(~same, "truth_changed"), F.when(zero("held") != zero("source_rows"), "rows_lost"), F.when(zero("again") != zero("source_duplicates"), "duplicates_changed"), F.when(zero("wide_rows") == 0, "no_rows")))
    return hashed.select(
        "id", F.lit(version).alias("version"), F.col("version").alias("source_version"), F.col("scenario_hash").alias("source_scenario_hash"), zero("source_rows").alias("source_rows"), zero("source_duplicates").alias("source_duplicates"),
        zero("wide_rows").alias("wide_rows"), zero("wide_duplicate_times").alias("wide_duplicate_times"), "semantic_sha256", F.col("new_truth").alias("truth"), flags.alias("flags"),
    )


def migration_report(records: DataFrame) -> DataFrame:
    """One row: records, those that passed, counts of duplicates before and after, and whether each check held for all."""
    without = lambda *names: F.count_if(F.arrays_overlap("flags", F.array(*map(F.lit, names)))) == 0
    return records.agg(
        F.count("*").alias("records"), F.count_if(F.size("flags") == 0).alias("passed"), F.coalesce(F.sum("source_duplicates"), F.lit(0)).alias("source_duplicates"), F.coalesce(F.sum("wide_duplicate_times"), F.lit(0)).alias("wide_duplicate_times"),
        without("truth_changed").alias("semantic_truth_preserved"), without("rows_lost", "duplicates_changed").alias("points_preserved"),
    )
