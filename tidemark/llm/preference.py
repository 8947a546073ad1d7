"""Preference formatting: chosen and rejected conversations share a prompt and end in masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The chat template's marks.
OPEN, CLOSE, END = "<|im_start|>", "<|im_end|>", "\n"


def _render(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit("\n"), turn["text"], F.lit(CLOSE + END))


def _text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _render), "")


def _spans(turns: Column) -> Column:
    """Start and end, in code points of the rendered turns, of what assistant turns say with its end mark."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def add(acc: Column, turn: Column) -> Column:
        first = acc["at"] + len(OPEN) + F.length(turn["role"]) + 1
        last = first + F.length(turn["text"]) + len(CLOSE)
        mine = F.array(F.struct(first.alias("start"), last.alias("end")))
        return F.struct((last + len(END)).alias("at"), F.when(turn["role"] == "assistant", F.concat(acc["spans"], mine)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, start, add, lambda acc: acc["spans"])


def preference_pairs(chosen: DataFrame, rejected: DataFrame, *, pair: str = "pair_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A record for each pair: prompt, chosen, rejected, chosen_spans, rejected_spans, n_prompt_turns.

    Both tables have a row for each turn.  The longest common prefix of equal turns is rendered once as the
    prompt; the rest of either side is its completion, whose spans mark what is trained on (assistant turns
    with their end mark), everything else being masked.

    The first turn that differs is a partial minimum over turns; only then are the turns of a pair gathered
    into its record, which holds the pair's text anyway.  Defined cases: turns are ordered by ``turn`` (equal
    numbers by role and text); a null role or text is an empty one; a pair in one table only has an empty
    prompt and an empty other completion; identical sides have empty completions; repeated rows are repeated
    turns; other columns play no part.
    """
    nth = Window.partitionBy("pair").orderBy("turn", "role", "text")

    def side(df: DataFrame, name: str) -> DataFrame:
        clean = df.select(F.col(pair).alias("pair"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        return clean.select("pair", F.row_number().over(nth).alias("n"), F.struct("role", "text").alias(name))

    c, r = side(chosen, "c"), side(rejected, "r")
    same = (c["pair"].eqNullSafe(r["pair"])) & (c["n"] == r["n"])
    both = c.join(r, same, "full").select(F.coalesce(c["pair"], r["pair"]).alias("pair"), F.coalesce(c["n"], r["n"]).alias("n"), "c", "r")
    grouped = both.groupBy("pair").agg(
        F.min(F.when(~F.col("c").eqNullSafe(F.col("r")), F.col("n"))).alias("differs"),
        F.max("n").alias("last"),
        F.sort_array(F.collect_list(F.struct("n", "c", "r"))).alias("turns"),
    )
    split = grouped.withColumn("shared", (F.coalesce("differs", F.col("last") + 1) - 1))

    def part(name: str, prompt: bool) -> Column:
        inside = (lambda t: t["n"] <= F.col("shared")) if prompt else (lambda t: t["n"] > F.col("shared"))
        return F.transform(F.filter("turns", lambda t: inside(t) & t[name].isNotNull()), lambda t: t[name])

    parts = split.select(F.col("pair").alias(pair), F.col("shared").cast("long").alias("n_prompt_turns"), part("c", True).alias("p"), part("c", False).alias("c"), part("r", False).alias("r"))
    return parts.select(
        pair, "n_prompt_turns", _text(F.col("p")).alias("prompt"), _text(F.col("c")).alias("chosen"), _text(F.col("r")).alias("rejected"),
        _spans(F.col("c")).alias("chosen_spans"), _spans(F.col("r")).alias("rejected_spans"),
    )


def echoed(conversations: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The conversations with their last assistant turn replaced by the text of the turn before it.

    A rejected side for tables that have none: an answer that only repeats what was said.  A conversation
    without an assistant turn is unchanged; an assistant turn without one before it becomes empty.  All
    columns are carried, whatever their names.
    """
    # the row travels as one value, so that no column of it can clash
    turns = conversations.select(F.struct(*[F.col(f"`{c}`") for c in conversations.columns]).alias("row"))
    key, of = F.col("row")[conv], F.col("row")[role]
    order = Window.partitionBy(key).orderBy(F.col("row")[turn], of, F.col("row")[text])
    numbered = turns.select("row", F.row_number().over(order).alias("n"), F.coalesce(F.lag(F.col("row")[text]).over(order), F.lit("")).alias("before"))
    marked = numbered.withColumn("last", F.max(F.when(of == "assistant", F.col("n"))).over(Window.partitionBy(key)))
    said = F.when(F.col("n") == F.col("last"), F.col("before")).otherwise(F.col("row")[text])
    return marked.select(*[(said if c == text else F.col("row")[c]).alias(c) for c in conversations.columns])
