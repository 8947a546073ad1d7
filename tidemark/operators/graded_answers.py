"""Recorded answers: graded by what they hold, and the seeds of those that fell short made new."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fields of an answer, its terms for images and signs of weighing, and the weights of the marks.
FIELDS = ("tool_plan", "answer", "model_or_strategy_recommendation", "risks_and_uncertainties", "quality_checks")
IMAGE_TERMS = ("图", "图像", "可视化", "overview", "seasonal", "heatmap", "residual", "从图")
SIGNALS = ("优先", "不应", "如果", "因为", "验证", "风险", "下一步", "回测", "指标")
WEIGHTS = {"schema": 0.22, "tools": 0.22, "cover": 0.18, "image": 0.14, "length": 0.12, "complexity": 0.12}


@dataclass(frozen=True)
class Rules:
    """What grading looks for; ``long`` are the least and most characters of a full mark, ``short`` the least of a middling one."""

    image_terms: tuple[str, ...] = IMAGE_TERMS
    signals: tuple[str, ...] = SIGNALS
    short: int = 120
    long: tuple[int, int] = (250, 2500)


def answer_record(text: Column) -> Column:
    """An answer that is a JSON object, as compact text; anything else as the ``answer`` of one; null as an empty answer."""
    value = F.try_parse_json(text)
    whole = F.when(F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False)), F.to_json(value))
    return F.coalesce(whole, F.to_json(F.struct(F.coalesce(text, F.lit("")).alias("answer"))))


def _share(hit: Column, of: Column) -> Column:
    return F.coalesce(F.try_divide(F.size(hit).cast("double"), F.size(of)), F.lit(1.0))


def grade_answers(rows: DataFrame, key: list[str], rules: Rules = Rules()) -> DataFrame:
    """Marks (a struct), score, flags and label of each answer.

    ``rows`` has answer (a text), tools and cover (arrays: tools and points that it should name) and mode.  Points with
    underscores may be written with blanks.  Nothing to name is a full mark; images only count where mode is image_text.
    """
    record = answer_record(F.col("answer"))
    none = F.array().cast("array<string>")
    x = rows.select(*key, record.alias("t"), F.coalesce("tools", none).alias("tools"), F.coalesce("cover", none).alias("cover"), "mode")
    t = F.col("t")
    any_of = lambda words: F.lit(False) if not words else F.greatest(*[t.contains(w) for w in words], F.lit(False))
    n = F.length(F.coalesce(F.get_json_object(t, "$.answer"), F.lit("")))
    held = F.array_intersect(F.json_object_keys(t), F.array(*map(F.lit, FIELDS)))
    marks = {
        "schema": F.size(held) / F.lit(len(FIELDS)),
        "tools": _share(F.filter("tools", lambda w: F.contains(t, w)), F.col("tools")),
        "cover": _share(F.filter("cover", lambda w: F.contains(t, w) | F.contains(t, F.replace(w, F.lit("_"), F.lit(" ")))), F.col("cover")),
        "image": F.when((F.col("mode") == "image_text") & ~any_of(rules.image_terms), 0.2).otherwise(1.0),
        "length": F.when(n.between(*rules.long), 1.0).when(n >= rules.short, 0.55).otherwise(0.25),
        "complexity": F.least(F.lit(1.0), sum((t.contains(w).cast("int") for w in rules.signals), F.lit(0)) / F.lit(6)),
    }
    m = {k: F.col(f"marks.{k}") for k in marks}
    flags = {
        "schema_incomplete": m["schema"] < 1, "missing_expected_tools": m["tools"] < 0.6, "missing_required_aspects": m["cover"] < 0.45, "image_evidence_missing": m["image"] < 1,
        "too_short_or_too_long": m["length"] < 0.6, "possibly_too_simple": m["complexity"] < 0.5,
    }
    raw = sum((m[k] * w for k, w in list(WEIGHTS.items())[1:]), m["schema"] * WEIGHTS["schema"])
    marked = x.select(*key, F.struct(*[c.alias(k) for k, c in marks.items()]).alias("marks")).withColumn("raw", raw)
    label = F.when(F.col("raw") < 0.58, "reply_error").when((m["complexity"] < 0.5) | (m["cover"] < 0.65), "question_too_simple_or_answer_shallow").otherwise("pass")
    return marked.select(*key, "marks", F.round("raw", 4).alias("score"), F.array_compact(F.array(*[F.when(c, F.lit(f)) for f, c in flags.items()])).alias("flags"), label.alias("label"))


def critique(label: Column, flags: Column, issues: Column, most: int = 8) -> Column:
    """What was wrong with an answer, in lines: its label, its flags and at most ``most`` issues of its judges."""
    named = F.concat(F.lit("issues: "), F.array_join(F.slice(issues, 1, most), "; "))
    return F.concat_ws("\n", F.concat(F.lit("label: "), label), F.concat(F.lit("flags: "), F.array_join(flags, ", ")), F.when(F.size(issues) > 0, named))


def recycled(seeds: DataFrame, reviews: DataFrame, instructions: DataFrame, most: int = 8) -> DataFrame:
    """New seeds of reviewed ones: an id of their own, where they come from, the question with an instruction, the critique.

    ``seeds`` has id and question, ``reviews`` id, final_label, final_score, flags and issues (arrays), ``instructions``
    label and instruction, a row without label for all others; it is one row a label.  Seeds without a review stay out,
    a review without a label counts as needs_rewrite, a null question is empty.
    """
    label = F.coalesce("final_label", F.lit("needs_rewrite"))
    other = F.broadcast(instructions.where("label IS NULL").agg(F.first("instruction").alias("other")))
    known = F.broadcast(instructions.where("label IS NOT NULL").groupBy("label").agg(F.min("instruction").alias("instruction")))
    none = F.array().cast("array<string>")
    met = seeds.join(reviews.withColumn("label", label), "id").join(known, "label", "left").crossJoin(other)
    question = F.concat(F.coalesce("question", F.lit("")), F.lit("\n\n"), F.coalesce("instruction", "other", F.lit("")))
    return met.select(
        F.concat("id", F.lit("_recycle_v2")).alias("id"), F.col("id").alias("recycled_from"), F.col("label").alias("recycle_label"), F.col("final_score").alias("recycle_score"),
        question.alias("question"), critique(F.col("label"), F.coalesce("flags", none), F.coalesce("issues", none), most).alias("critique"),
    )


def training_seeds(seeds: DataFrame, answers: DataFrame) -> DataFrame:
    """The seeds (id, messages: array of role and content) that have an answer (id, answer), with it as the assistant's turn."""
    turn = F.struct(F.lit("assistant").alias("role"), F.col("answer").alias("content"))
    told = answers.where(F.trim("answer") != "").groupBy("id").agg(F.min("answer").alias("answer"))
    return seeds.join(told, "id").withColumn("messages", F.array_append(F.coalesce("messages", F.array().cast("array<struct<role: string, content: string>>")), turn)).drop("answer")
