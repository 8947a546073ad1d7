"""Specifications of questions: which modalities a scenario is asked in, which tools are offered, and what identifies each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.hashing import stable_hash, unit_interval
from tidemark.shared import written

# Modalities in order, and entries outside model selection that may or must look into a model catalogue.
MODES = ["text_only", "image_text"]
CATALOGUE_TASK, CATALOGUE_ENTRIES = "model_selection", ["result_training_dynamics", "result_data_concept_drift", "result_retrain_rollback_review"]


def modality_plan(assigned: DataFrame, policies: dict[str, dict[str, float]], seed: int) -> DataFrame:
    """``assigned`` (scenario, spec, image_policy) with modes (an array) and reason.

    Every entry is asked in both modalities: its first two scenarios, by a hash, see to that (one alone is paired),
    and the others draw from the policy of the entry's level (low, medium or high value of images).  Only the first
    two of an entry are ranked, so an entry with most of the scenarios is no hot group.
    """
    level = F.when(F.col("image_policy") == "low", "low").when(F.col("image_policy") == "high", "high").otherwise("medium")
    keyed = written(assigned.withColumns({"level": level, "h": stable_hash(str(seed), F.col("spec"), F.col("scenario"))}), "assigned")
    nth = F.row_number().over(Window.partitionBy("spec").orderBy("h", "scenario"))
    first = keyed.withColumn("nth", nth).where(F.col("nth") <= 2).select("spec", "scenario", "nth")
    sizes = keyed.groupBy("spec").agg(F.count("*").alias("size"))
    rows = keyed.join(first, ["spec", "scenario"], "left").join(sizes, "spec")
    u = unit_interval(stable_hash(str(seed), F.col("spec"), F.col("scenario"), "modality"))
    drawn = F.lit("paired")
    for name, policy in policies.items():
        inside = F.when(u < policy[MODES[0]], MODES[0]).when(u < policy[MODES[0]] + policy[MODES[1]], MODES[1]).otherwise("paired")
        drawn = F.when(F.col("level") == name, inside).otherwise(drawn)
    text, image, both = F.array(F.lit(MODES[0])), F.array(F.lit(MODES[1])), F.array(*map(F.lit, MODES))
    low, medium = F.col("level") == "low", F.col("level") == "medium"
    anchor, counter = F.when(low, text).otherwise(image), F.when(low, image).otherwise(text)
    pick = lambda one, two, three, four, rest: F.when(F.col("size") == 1, one).when((F.col("nth") == 1) & medium, two).when(F.col("nth") == 1, three).when(F.col("nth") == 2, four).otherwise(rest)
    modes = pick(both, both, anchor, counter, F.when(drawn == "paired", both).otherwise(F.array(drawn)))
    reason = pick("forced_pair_for_subtask_coverage", "medium_value_paired_anchor", "policy_primary_modality", "subtask_counter_modality", F.concat(F.lit("stratified_"), F.col("level"), F.lit("_"), drawn))
    return rows.withColumns({"modes": modes, "reason": reason}).drop("h", "nth", "size")


def offered_tools(question: Column, required: Column, focus: Column, catalogue: Column, excluded: Column, size: int, seed: int) -> Column:
    """Tools of a question: the required ones and the task's own that the catalogue has, filled up by a hash to ``size``.

    If there are too many, required ones stay first; excluded ones are never offered.
    """
    usable = F.array_except(catalogue, excluded)
    needed = F.array_distinct(required)
    wanted = F.filter(F.array_distinct(F.concat(needed, focus)), lambda t: F.array_contains(usable, t))
    ordered = F.when(F.size(wanted) > size, F.concat(F.filter(needed, lambda t: F.array_contains(wanted, t)), F.array_except(wanted, needed))).otherwise(wanted)
    others = F.array_sort(F.transform(F.array_except(usable, wanted), lambda t: F.struct(stable_hash(str(seed), question, t).alias("h"), t.alias("t"))))
    return F.slice(F.concat(ordered, F.transform(others, lambda o: o["t"])), 1, size)


def catalogue_scope(task: Column, spec: Column, goal: Column) -> Column:
    """none, or the kind of model catalogue that a question may look into."""
    relevant = (task == CATALOGUE_TASK) | spec.isin(CATALOGUE_ENTRIES)
    return F.when(~relevant, "none").when(goal.contains("anomaly"), "anomaly_detection").otherwise("forecast")


def question_specs(planned: DataFrame, tools: DataFrame, *, universal: list[str], excluded: list[str], size: int = 20, seed: int = 20260712, previous: DataFrame | None = None) -> DataFrame:
    """A row for each question: id, group, pair, mode, reason, scope, difficulty, decisions, tools and spec_hash.

    ``planned`` has what ``modality_plan`` gives and task, goal, analysis_difficulty, entry_difficulty, preferred and
    focus (arrays of tools); ``tools`` (name) is a catalogue of bounded length.  Both questions of a pair share a
    group.  With ``previous`` (id, spec_hash) ``unchanged`` tells which of them were there before.
    """
    catalogue = tools.agg(F.array_sort(F.collect_set("name")).alias("catalogue"))
    names = lambda v: F.array(*map(F.lit, v)).cast("array<string>")
    each = planned.join(F.broadcast(catalogue)).select("*", F.posexplode("modes").alias("nth", "mode"))
    id = F.concat_ws("_", "scenario", F.format_string("q%02d", F.col("nth") + 1), "mode")  # noqa: A001
    paired = F.size("modes") == 2
    pair = F.when(paired, F.concat_ws("_", F.lit("pair"), "scenario", "spec"))
    hard = (F.col("analysis_difficulty") == "hard") & (F.col("entry_difficulty") == "hard")
    made = each.withColumn("id", id).select(
        "id", F.coalesce(pair, "id").alias("group_id"), pair.alias("pair_id"), F.when(paired, F.col("mode")).otherwise(F.concat(F.lit("standalone_"), F.col("mode"))).alias("role"), "scenario", "task", "spec", "mode", "reason",
        F.col("level").alias("image_value"), catalogue_scope(F.col("task"), F.col("spec"), F.col("goal")).alias("scope"), F.when(hard, "hard").otherwise("medium").alias("difficulty"), F.when(hard, 3).otherwise(2).alias("decisions"),
        offered_tools(F.col("id"), F.concat("preferred", names(universal)), F.col("focus"), F.col("catalogue"), names(excluded), size, seed).alias("tools"),
    )
    hashed = made.withColumn("spec_hash", F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(made.columns)]), {"ignoreNullFields": "false"}), 256))
    if previous is None:
        return hashed
    old = previous.select("id", F.col("spec_hash").alias("old"))
    return hashed.join(old, "id", "left").withColumn("unchanged", F.col("old").eqNullSafe(F.col("spec_hash"))).drop("old")
