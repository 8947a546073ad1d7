"""Tool-use trajectories: grammar, alignment with tool events, repeats, budgets, scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def call_metrics(calls: DataFrame, key: str) -> DataFrame:
    """Calls, failures, sorted distinct successful tools, repeated and twice failed signatures by trajectory.

    ``calls`` has ord, name, arguments and ok.  A signature is a name with its arguments; a successful call
    whose signature succeeded before is a repeat, a second failure of one would end the run.
    """
    before = Window.partitionBy(key, "name", "arguments", "ok").orderBy("ord")
    seen = calls.withColumn("nth", F.row_number().over(before))
    return seen.groupBy(key).agg(
        F.count("*").alias("calls"),
        F.count_if(F.col("ok")).alias("succeeded"),
        F.count_if(~F.col("ok")).alias("failed"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("ok"), F.col("name")))), ",").alias("tools"),
        F.count_if(F.col("ok") & (F.col("nth") > 1)).alias("repeats"),
        F.count_if(~F.col("ok") & (F.col("nth") == 2)).alias("stops"),
    )


def review(messages: DataFrame, events: DataFrame, key: str, budget: int = 8) -> DataFrame:
    """Flags, score and verdict of each trajectory: system, user, (assistant with a call, tool)*, assistant.

    ``messages`` has pos, role, call_id (of an assistant's call or a tool's answer) and text; ``events`` has
    ord, call_id, name, arguments and ok.  Each message is held against its neighbour by a window; calls meet
    events by their id, where order counts too.
    """
    order = Window.partitionBy(key).orderBy("pos")
    near = messages.withColumns({"before": F.lag("role").over(order), "asked": F.lag("call_id").over(order), "nth": F.row_number().over(order), "after": F.lead("role").over(order)})
    calls = (F.col("role") == "assistant") & F.col("call_id").isNotNull()
    wrong = (
        ((F.col("role") == "system") != (F.col("nth") == 1))
        | ((F.col("role") == "user") != (F.col("nth") == 2))
        | ((F.col("role") == "tool") & ((F.col("before") != "assistant") | ~F.col("asked").eqNullSafe(F.col("call_id"))))
        | (calls & ~F.col("after").eqNullSafe(F.lit("tool")))
        | ((F.col("role") == "assistant") & (F.col("nth") > 3) & (F.col("before") != "tool"))
        | ~F.col("role").isin("system", "user", "assistant", "tool")
    )
    grammar = near.groupBy(key).agg(
        F.count_if(F.coalesce(wrong, F.lit(False))).alias("wrong"), F.count_if(calls).alias("n_calls"),
        F.max(F.struct("pos", "role", F.col("call_id").isNull().alias("final"), F.length(F.trim("text")).alias("n"))).alias("last"),
    )
    nth = lambda c: F.row_number().over(Window.partitionBy(key).orderBy(c))
    asked = messages.where(calls).select(key, "call_id", nth("pos").alias("n"))
    done = events.select(key, "call_id", nth("ord").alias("m"))
    met = asked.join(done, [key, "call_id"], "full").groupBy(key).agg(F.count_if(~F.col("n").eqNullSafe(F.col("m"))).alias("unmatched"))
    joined = grammar.join(met, key, "left").join(call_metrics(events, key), key, "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    flags = {
        "grammar": F.col("wrong") > 0,
        "unmatched_call": zero("unmatched") > 0,
        "no_final_answer": (F.col("last.role") != "assistant") | ~F.col("last.final"),
        "short_answer": F.col("last.n") < 20,
        "over_budget": F.col("n_calls") > budget,
        "no_evidence": zero("succeeded") == 0,
        "repeated_call": zero("repeats") > 0,
        "repeated_failure": zero("stops") > 0,
    }
    flagged = joined.withColumn("f", F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in flags.items()])))
    free = lambda *names: (~F.arrays_overlap("f", F.array(*[F.lit(n) for n in names]))).cast("double")
    score = 0.3 * free("grammar", "over_budget") + 0.3 * free("unmatched_call", "no_evidence") + 0.2 * free("repeated_call", "repeated_failure") + 0.1 + 0.1 * free("no_final_answer", "short_answer")
    return flagged.select(key, F.array_join("f", ",").alias("flags"), F.round(score, 4).alias("score"), ((F.round(score, 4) >= 0.8) & (free("grammar", "unmatched_call", "no_final_answer") == 1)).alias("passed"))


def chat_messages(messages: DataFrame, key: str) -> DataFrame:
    """Training messages: calls as JSON on the assistant's turn, tool answers with their name; an unknown role is an error."""
    known = F.when(~F.col("role").isin("system", "user", "assistant", "tool"), F.raise_error(F.concat(F.lit("unknown role "), F.col("role")))).otherwise(F.col("role"))
    call = F.when(F.col("role") == "assistant", F.when(F.col("call_id").isNotNull(), F.to_json(F.struct(F.col("name"), F.col("arguments")))))
    text = F.when(F.trim("text") != "", F.regexp_replace("text", r"<image>\s*", ""))
    one = F.struct("pos", known.alias("role"), text.alias("text"), call.alias("call"), F.when(F.col("role") == "tool", F.col("name")).alias("tool"))
    return messages.groupBy(key).agg(F.sort_array(F.collect_list(one)).alias("messages"))
