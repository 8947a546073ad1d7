"""Task entries and scenarios: who fits whom, first come first served, and leftovers dealt round."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.shared import numbered, written

# The entries of the task pool, in their order, by task.
POOL = {
    "data_profile": [
        "profile_schema_frequency_index", "profile_trend_types", "profile_stationarity_differencing", "profile_seasonality_variants", "profile_missingness_patterns",
        "profile_anomaly_types", "profile_change_variance_drift", "profile_intermittent_longtail", "profile_scale_variance_heterogeneity", "profile_modality_sufficiency",
    ],
    "similarity_analysis": [
        "similarity_raw_trend_alignment", "similarity_normalized_shape", "similarity_pearson_spearman", "similarity_phase_dtw", "similarity_lag_lead", "similarity_distribution_not_shape",
        "similarity_shape_variance_difference", "similarity_clustering_representative", "similarity_anomalous_series", "similarity_motif_local", "similarity_global_local_model",
    ],
    "model_result_analysis": [
        "result_residual_mean_bias", "result_omitted_seasonality", "result_autocorrelation_whiteness", "result_heteroscedasticity", "result_tail_extremes", "result_horizon_degradation",
        "result_group_error", "result_interval_calibration", "result_training_dynamics", "result_data_concept_drift", "result_model_tradeoff", "result_retrain_rollback_review",
    ],
    "model_selection": [
        "selection_history_length", "selection_single_panel", "selection_uni_multivariate", "selection_future_covariates", "selection_periodicity", "selection_nonstationary_change", "selection_intermittent",
        "selection_probabilistic_interval", "selection_anomaly_task", "selection_hierarchy_reconciliation", "selection_foundation_supervised", "selection_operational_constraints", "selection_global_local_grouped",
    ],
    "tool_use": [
        "tool_minimal_sufficient_chain", "tool_profile_only", "tool_plot_required", "tool_stationarity_period_order", "tool_similarity_choice", "tool_missing_imputation",
        "tool_anomaly_change_order", "tool_normalize_before_similarity", "tool_image_needs_statistics", "tool_avoid_unnecessary_plot", "tool_conflicting_results", "tool_hard_negative",
    ],
}
# Patterns of scenarios that an entry takes; one without a line here takes any.
PATTERNS = {
    "profile_missingness_patterns": ["missing_blocks"],
    "profile_anomaly_types": ["anomaly_change"],
    "profile_change_variance_drift": ["anomaly_change"],
    "profile_intermittent_longtail": ["intermittent"],
    "profile_scale_variance_heterogeneity": ["multi_period", "missing_blocks"],
    "similarity_phase_dtw": ["phase_groups"],
    "similarity_lag_lead": ["phase_groups"],
    "similarity_distribution_not_shape": ["distribution_mismatch"],
    "similarity_anomalous_series": ["sequence_anomaly"],
    "similarity_motif_local": ["motif"],
    "result_training_dynamics": ["overfit", "underfit"],
    "result_data_concept_drift": ["drift"],
    "result_retrain_rollback_review": ["drift"],
    "selection_uni_multivariate": ["covariates"],
    "selection_future_covariates": ["covariates"],
    "selection_intermittent": ["intermittent"],
    "selection_probabilistic_interval": ["interval"],
    "selection_anomaly_task": ["sequence_anomaly"],
    "selection_hierarchy_reconciliation": ["hierarchical"],
    "tool_profile_only": ["stationary", "leakage"],
    "tool_plot_required": ["missing_blocks", "anomaly_change"],
    "tool_stationarity_period_order": ["trend_period", "multi_period"],
    "tool_similarity_choice": ["scaled_groups"],
    "tool_missing_imputation": ["missing_blocks"],
    "tool_anomaly_change_order": ["anomaly_change"],
    "tool_normalize_before_similarity": ["scaled_groups"],
    "tool_image_needs_statistics": ["trend_period", "anomaly_change"],
    "tool_avoid_unnecessary_plot": ["stationary", "leakage"],
    "tool_conflicting_results": ["multi_period"],
    "tool_hard_negative": ["leakage"],
}
#: Entries of this task without a line of their own need residuals.
RESIDUAL_TASK, RESIDUAL_PATTERNS = "model_result_analysis", ["residual_period", "residual_hetero"]


def patterns_of(task: str, entry: str) -> list[str] | None:
    """The patterns that an entry takes; None for any."""
    return PATTERNS.get(entry, RESIDUAL_PATTERNS if task == RESIDUAL_TASK else None)


def pool(spark: SparkSession) -> DataFrame:
    """The task pool: task, spec, ord and patterns."""
    rows = [(task, entry, k, patterns_of(task, entry)) for task, entries in POOL.items() for k, entry in enumerate(entries)]
    return spark.createDataFrame(rows, "task string, spec string, ord int, patterns array<string>")


def _kind(patterns: Column) -> Column:
    """Entries of one kind take the same patterns."""
    return F.coalesce(F.array_join(F.array_sort(F.array_distinct(patterns)), "\u0001"), F.lit("\u0002"))


def _candidates(specs: DataFrame, scenarios: DataFrame) -> DataFrame:
    """(task, kind, place, scenario): for each kind of entry the scenarios that it takes, in their order.

    No more than a task has entries can be taken of one pattern, so only so many are looked at.
    """
    sizes = specs.groupBy("task").agg(F.count("*").alias("n"))
    nth = F.row_number().over(Window.partitionBy("task", "pattern").orderBy("ord", "scenario"))
    few = scenarios.withColumn("nth", nth).join(F.broadcast(sizes), "task").where(F.col("nth") <= F.col("n")).select("task", "scenario", "ord", "pattern")
    kinds = specs.select("task", "kind", F.explode_outer("patterns").alias("wanted")).distinct()
    wanted = F.col("k.wanted").isNull() & (F.col("k.kind") == "\u0002") | (F.col("k.wanted") == F.col("s.pattern"))
    met = few.alias("s").join(F.broadcast(kinds.alias("k")), (F.col("s.task") == F.col("k.task")) & wanted).select("s.task", "kind", "scenario", "s.ord")
    return met.distinct().withColumn("place", F.row_number().over(Window.partitionBy("task", "kind").orderBy("ord", "scenario"))).drop("ord")


def first_come(specs: DataFrame, scenarios: DataFrame) -> DataFrame:
    """(task, spec, scenario): each entry, in order, takes the first scenario that fits and that no earlier one took.

    Rounds of proposals instead of a fold: every entry proposes to the scenario at a place in its kind's list
    that it can't come before, the earliest proposer keeps the scenario, and the others go on to the next
    place.  Entries of a kind keep their order, so the i-th begins no earlier than the i-th place.  Places only
    rise, and the rounds end when nobody has to go on: that is the fold's outcome.
    """
    kinds = written(specs.withColumn("kind", _kind(F.col("patterns"))), "specs")
    lists = written(_candidates(kinds, scenarios), "candidates")
    in_kind = Window.partitionBy("task", "kind").orderBy("ord", "spec")
    row = F.row_number().over(in_kind)
    at = written(kinds.select("task", "kind", "spec", "ord", row.cast("long").alias("place")), "places")
    while True:
        met = at.join(lists, ["task", "kind", "place"]).withColumn("first", F.min(F.struct("ord", "spec")).over(Window.partitionBy("task", "scenario")))
        beaten = met.where(F.col("first.spec") != F.col("spec")).select("task", "spec", F.lit(1).alias("more"))
        least = at.join(beaten, ["task", "spec"], "left").withColumn("least", F.col("place") + F.coalesce("more", F.lit(0))).withColumn("row", row)
        # an entry stands behind the earlier ones of its kind
        rise = F.max(F.col("least") - F.col("row")).over(in_kind.rowsBetween(Window.unboundedPreceding, 0))
        after = written(least.withColumn("place", rise + F.col("row")).select("task", "kind", "spec", "ord", "place", "more"), "places")
        at = after.drop("more")
        if after.where("more IS NOT NULL").isEmpty():
            return at.join(lists, ["task", "kind", "place"]).select("task", "spec", "scenario")


def assign(specs: DataFrame, scenarios: DataFrame) -> DataFrame:
    """(task, scenario, spec, turn): what ``first_come`` gives (turn 1), and leftovers dealt round (turn 2).

    ``specs`` has task, spec, ord and patterns (null fits all), ``scenarios`` task, scenario, ord and pattern.  The
    n-th leftover of a task goes to the n-th entry that takes its pattern, counted round; if none does, all do.

    Entries are a plan, so lists of entries are broadcast; scenarios are any number and only joined, ranked by
    ranges and anti-joined.  Ties in ``ord`` go by name; a null pattern fits only entries that take any; scenarios
    of a task without entries are left out; empty tables give an empty result.
    """
    taken = written(first_come(specs, scenarios), "taken")
    own = specs.select("task").distinct()
    rest = scenarios.join(F.broadcast(own), "task", "left_semi").join(taken.select("task", "scenario"), ["task", "scenario"], "left_anti")
    placed = written(numbered(rest.select("task", "scenario", "ord", "pattern"), "task", "ord", "scenario"), "leftovers")
    start = placed.groupBy("task").agg(F.min("place").alias("start"))
    entries = specs.groupBy("task").agg(F.array_sort(F.collect_list(F.struct("ord", "spec", "patterns"))).alias("entries"))
    dealt = placed.join(F.broadcast(start), "task").join(F.broadcast(entries), "task")
    able = F.filter("entries", lambda e: e["patterns"].isNull() | F.coalesce(F.array_contains(e["patterns"], F.col("pattern")), F.lit(False)))
    chosen = F.when(F.size(able) > 0, able).otherwise(F.col("entries"))
    nth = F.pmod(F.col("place") - F.col("start"), F.size("chosen").cast("long")).cast("int")
    second = dealt.withColumn("chosen", chosen).select("task", "scenario", F.get("chosen", nth)["spec"].alias("spec"), F.lit(2).alias("turn"))
    return taken.select("task", "scenario", "spec", F.lit(1).alias("turn")).unionByName(second)
