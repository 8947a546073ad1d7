"""Review of conversations and answers, choice between candidates, coverage and export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.quantiles import earlier_rows


def review_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Flags, score and verdict of each conversation by the grammar system?, user, (assistant, user)*, assistant.

    Each turn is held against the one before by a window; a conversation's flags are partial aggregates.
    """
    order = Window.partitionBy(conv).orderBy(turn)
    seen = turns.withColumns(
        {"before": F.lag("role").over(order), "nth": F.row_number().over(order), "said": F.row_number().over(Window.partitionBy(conv, "role", "text").orderBy(turn))}
    )
    ends = F.max(F.struct(F.col(turn), F.col("role")))["role"]
    counts = seen.groupBy(conv).agg(
        F.count("*").alias("n_turns"),
        F.count_if(F.col("role").isin("user", "assistant", "system") == F.lit(False)).alias("unknown_roles"),
        F.count_if((F.col("role") == "system") & (F.col("nth") > 1)).alias("misplaced_system"),
        F.count_if(F.col("role") == F.col("before")).alias("repeated_roles"),
        F.count_if((F.col("said") > 1)).alias("repeated_turns"),
        F.count_if(F.trim("text") == "").alias("empty_turns"),
        F.count_if(F.col("role") == "assistant").alias("answers"),
        ends.alias("last_role"),
    )
    flags = {
        "unknown_role": F.col("unknown_roles") > 0,
        "misplaced_system": F.col("misplaced_system") > 0,
        "role_order": F.col("repeated_roles") > 0,
        "repeated_turn": F.col("repeated_turns") > 0,
        "empty_turn": F.col("empty_turns") > 0,
        "no_answer": F.col("answers") == 0,
        "open_end": F.col("last_role") != "assistant",
    }
    none = lambda *names: (~F.arrays_overlap("flags", F.array(*[F.lit(n) for n in names]))).cast("double")
    flagged = counts.withColumn("flags", F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in flags.items()])))
    score = 0.3 * none("unknown_role", "misplaced_system", "role_order") + 0.3 * none("no_answer", "open_end") + 0.2 * none("repeated_turn") + 0.2 * none("empty_turn")
    scored = flagged.withColumn("score", F.round(score, 4))
    return scored.select(conv, "n_turns", "answers", F.array_join("flags", ",").alias("flags"), "score", ((F.col("score") >= 0.8) & (none("unknown_role", "no_answer") == 1)).alias("passed"))


def budget_states(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", budget: int = 8) -> DataFrame:
    """Turns left of a budget after each one, and whether it is nearly used up."""
    left = F.lit(budget) - F.row_number().over(Window.partitionBy(conv).orderBy(turn))
    return turns.select(conv, turn, left.alias("remaining"), (left <= 1).alias("warned"))


def choose_candidate(candidates: DataFrame, group: str) -> DataFrame:
    """The passed candidate with the best score; ties by fewest failures, calls, then least index.

    ``candidates`` has index, passed, score, failures and calls.  A group without a passed candidate keeps
    none, with the reason.
    """
    rank = F.struct(-F.col("score"), F.col("failures"), F.col("calls"), F.col("index"))
    best = candidates.groupBy(group).agg(
        F.count("*").alias("n"), F.count_if(F.col("passed")).alias("n_passed"), F.min_by("index", F.when(F.col("passed"), rank)).alias("winner")
    )
    reason = F.when(F.col("n_passed") == 0, "all_failed").when(F.col("n_passed") == 1, "only_passed").otherwise("best_score")
    return best.select(group, "n", "n_passed", F.when(F.col("n_passed") > 0, F.col("winner")).alias("winner"), reason.alias("reason"))


def judge_aggregate(rows: DataFrame, group: str, rule: Column, judge: Column) -> DataFrame:
    """.45 of the rule score and .55 of the mean judge score by group, with a label by thresholds."""
    scored = rows.groupBy(group).agg(F.count("*").alias("n"), F.round(0.45 * F.avg(rule) + 0.55 * F.avg(judge), 4).alias("final"))
    return scored.withColumn("label", F.when(F.col("final") >= 0.8, "accept").when(F.col("final") >= 0.6, "revise").otherwise("reject"))


def axis_counts(rows: DataFrame, axes: list[str]) -> DataFrame:
    """Rows by each value of each axis, in one pass; a null value counts as "missing"."""
    filled = rows.select(*[F.coalesce(F.col(a).cast("string"), F.lit("missing")).alias(a) for a in axes])
    sets = filled.groupingSets([[F.col(a)] for a in axes], *[F.col(a) for a in axes]).agg(F.count("*").alias("n"))
    axis = F.coalesce(*[F.when(F.col(a).isNotNull(), F.lit(a)) for a in axes])
    return sets.select(axis.alias("axis"), F.coalesce(*axes).alias("value"), "n")


def crosstabs(rows: DataFrame, sets: list[list[str]]) -> DataFrame:
    """Rows by the combinations of each set of columns, in one pass; columns outside a set are null."""
    columns = list(dict.fromkeys(c for s in sets for c in s))
    return rows.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns]).agg(F.count("*").alias("n"))


def missing_values(rows: DataFrame, expected: dict[str, list[str]]) -> DataFrame:
    """For each axis the expected values that no row has."""
    parts = [F.struct(F.lit(a).alias("axis"), F.array_join(F.array_sort(F.array_except(F.array(*[F.lit(x) for x in want]), F.collect_set(F.when(F.col(a).isin(want), F.col(a))))), ",").alias("missing")) for a, want in expected.items()]
    return rows.agg(F.array(*parts).alias("x")).select(F.inline("x"))


def exact_duplicates(rows: DataFrame, text: Column, by: list[str]) -> DataFrame:
    """Rows, distinct texts and duplicates by group, from counts by text."""
    digest = rows.select(*by, F.sha2(text.cast("binary"), 256).alias("h")).groupBy(*by, "h").count()
    return digest.groupBy(*by).agg(F.sum("count").alias("n"), F.count("*").alias("n_distinct"), (F.sum("count") - F.count("*")).alias("duplicates"))


def prefix_uses(rows: DataFrame, key: str, prefix: Column, most: int = 2) -> DataFrame:
    """How many earlier rows (by key) open alike, and whether that is still under ``most``."""
    return earlier_rows(rows.select(key, prefix.alias("prefix")), key, "prefix").withColumn("ok", F.col("earlier") < most)


def chat_export(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """One record for each conversation that ends with an assistant turn: its messages in order, blank ones left out."""
    kept = turns.where(F.trim("text") != "")
    records = kept.groupBy(conv).agg(F.sort_array(F.collect_list(F.struct(F.col(turn).alias("turn"), "role", "text"))).alias("m"))
    done = records.where(F.element_at("m", -1)["role"] == "assistant")
    return done.select(conv, F.size("m").alias("n_messages"), F.array_join(F.transform("m", lambda x: F.concat(x["role"], F.lit(": "), x["text"])), "\n").alias("chat"))


def last_record_wins(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key, by a partial maximum."""
    rest = [c for c in rows.columns if c != key and c not in order]
    best = rows.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("b"))
    return best.select(key, *[F.col(f"b.{c}").alias(c) for c in (*order, *rest)])


def pending(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't done yet."""
    return rows.join(done.select(key), key, "left_anti")


def orphans(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys that only one of two tables has, with its side."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("left")).unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("right")))


def catalogue_search(models: DataFrame, *, task: str | None = None, package: str | None = None, name: str | None = None, limit: int = 12) -> DataFrame:
    """The first models, in catalogue order, that meet every given condition; task labels match either way round."""
    found = models
    if task:
        t = task.lower()
        found = found.where(F.exists("tasks", lambda x: F.lower(x).contains(t) | F.lit(t).contains(F.lower(x))))
    if package:
        found = found.where(F.lower("package").contains(package.lower()))
    if name:
        found = found.where(F.lower("name").contains(name.lower()))
    return found.orderBy("ord").limit(limit)


def array_profile(rows: DataFrame, key: str, values: str, slice_to: int = 32) -> DataFrame:
    """Length, mean, extremes and first values of an array column."""
    v = F.col(values)
    total = F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double"))
    return rows.select(
        key, F.size(v).alias("n"), F.size(F.slice(v, 1, slice_to)).alias("n_kept"), F.round(F.try_divide(total, F.size(v)), 5).alias("mean"),
        F.round(F.array_max(v).cast("double"), 5).alias("max"), F.array_position(v, F.array_max(v)).alias("argmax"),
    )


def review_answers(rows: DataFrame, key: str, answer: Column, expected: Column, *, low: int = 200, high: int = 6000) -> DataFrame:
    """.25 schema, .25 expected points, .2 evidence, .15 structure and .15 length of an answer; passed from .75 on.

    ``expected`` is an array of words that the answer must contain.
    """
    hits = F.size(F.filter(expected, lambda w: F.contains(F.lower(answer), F.lower(w))))
    parts = {
        "schema": (F.trim(answer) != "").cast("double"),
        "points": F.coalesce(F.try_divide(hits.cast("double"), F.size(expected)), F.lit(1.0)),
        "evidence": answer.rlike("[0-9]").cast("double"),
        "structure": (F.size(F.split(answer, "\n")) >= 3).cast("double"),
        "length": F.length(answer).between(low, high).cast("double"),
    }
    weights = {"schema": 0.25, "points": 0.25, "evidence": 0.2, "structure": 0.15, "length": 0.15}
    score = F.round(sum((parts[k] * w for k, w in weights.items()), F.lit(0.0)), 4)
    return rows.select(key, score.alias("score"), (score >= 0.75).alias("passed"))


def judged_choice(scores: DataFrame, group: str) -> DataFrame:
    """The candidate with the highest total, or sum of its five marks where that is missing; equal ones by the tie order.

    A group is only decided if both candidates have a score; else the tie order of failures, calls, tokens
    and index decides.
    """
    total = F.coalesce("total", sum((F.col(f"mark{k}") for k in range(1, 6)), F.lit(0)).cast("double"))
    ties = F.struct("failures", "calls", "tokens", "index")
    seen = scores.withColumn("t", total).groupBy(group).agg(
        F.count("*").alias("n"), F.count("t").alias("judged"), F.min_by("index", F.struct(-F.col("t"), ties)).alias("by_score"), F.min_by("index", ties).alias("by_tie")
    )
    decided = F.col("judged") == F.col("n")
    return seen.select(group, F.when(decided, F.col("by_score")).otherwise(F.col("by_tie")).alias("winner"), F.when(decided, "judge").otherwise("tie_break").alias("reason"))
