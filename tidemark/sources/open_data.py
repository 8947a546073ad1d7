"""Records of open question sets in one form, and what of a scenario may be shown as evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import arrays
from tidemark.functions import text as tx


def stable_id(prefix: str, *parts: Column) -> Column:
    """The prefix and the first 16 hexadecimal digits of the SHA-1 of the parts, joined by two colons; a null part is empty."""
    joined = F.concat_ws("::", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.sha1(joined.cast("binary")), 1, 16))


def reasoned_rows(lines: DataFrame) -> DataFrame:
    """Lines with a worked answer (path, row_index, problem, answer, extracted_answer, question_type, timeseries) as rows for ``raw_records``.

    The extracted answer counts where there is one; ``extra`` tells whether the answer shows its reasoning.
    """
    filled = F.when(F.col("extracted_answer") != "", F.col("extracted_answer"))
    shows = F.coalesce(F.contains("answer", F.lit("<think>")), F.lit(False))
    return lines.select(
        "path", "row_index", F.col("problem").alias("question"), F.coalesce(filled, "answer", F.lit("")).alias("answer"), F.col("timeseries").alias("series"), F.array().cast("array<string>").alias("choices"),
        F.col("question_type").alias("task_type"), "question_type", F.lit("").alias("domain"), F.struct(shows.alias("has_cot")).alias("extra"),
    )


def raw_records(rows: DataFrame, source: str, wanted: list[str] | None = None) -> DataFrame:
    """One record for each row with a question of a wanted capability: id, question, answer, series within bounds, flags, route.

    ``rows`` has path, row_index, question, answer, series (array of arrays), choices, task_type, question_type, domain and
    any ``extra``.  The capability comes from the task type, then the question; without ``wanted`` any that is known will do.
    Blank questions stay out, null answers are empty, null series none.  Rows that are alike in path, index and
    question have the same id.
    """
    question, answer = F.trim(F.coalesce("question", F.lit(""))), F.trim(F.coalesce("answer", F.lit("")))
    capability = F.coalesce(tx.capability(F.coalesce("task_type", F.lit(""))), tx.capability(question))
    series = arrays.compact_series(F.coalesce("series", F.array().cast("array<array<double>>")))
    flags = tx.quality_flags(question)
    made = rows.where(question != "").select(
        stable_id("openq", F.lit(source), F.col("path"), F.col("row_index"), question).alias("id"), F.lit(source).alias("source"), F.col("path").alias("source_path"), F.col("row_index").alias("source_row_index"),
        F.coalesce("task_type", F.lit("")).alias("original_task_type"), F.coalesce("question_type", F.lit("")).alias("question_type"), capability.alias("normalized_capability"), F.coalesce("domain", F.lit("")).alias("domain"),
        question.alias("question"), answer.alias("answer"), F.coalesce("choices", F.array().cast("array<string>")).alias("choices"), series.alias("timeseries"),
        F.struct(F.size(series).alias("num_series"), arrays.longest(series).alias("max_length")).alias("timeseries_summary"), tx.reuse_route(flags).alias("reuse_strategy"), flags.alias("quality_flags"), F.col("extra").alias("metadata"),
    )
    known = F.col("normalized_capability")
    return made.where(known.isNotNull() if wanted is None else known.isin(wanted))


#: What a packet shows only where a scenario has it.
OPTIONAL = ("known_future_covariates", "unknown_future_covariates", "target_zero_ratio", "hierarchy", "forecast_requirement")


def evidence_packets(contexts: DataFrame, key: str) -> DataFrame:
    """A row for each scenario: its schema, layout, scale, time index, statistics and constraints, as one struct, nothing else of it.

    ``contexts`` has the visible fields as columns: columns, data_layout, wide_column_map, row_count, series_count,
    history_length_per_series, frequency, first_time, last_time, summary, business_constraints, and of OPTIONAL those
    that there are.  Columns that aren't named here, hidden truth above all, don't get in.  The observed range is null
    unless both ends are known.
    """
    ends = F.when(F.col("first_time").isNotNull() & F.col("last_time").isNotNull(), F.struct(F.col("first_time").cast("string").alias("start"), F.col("last_time").cast("string").alias("end")))
    packet = F.struct(
        F.struct("columns").alias("schema"), "data_layout", "wide_column_map", F.struct("row_count", "series_count", "history_length_per_series").alias("data_scale"),
        F.struct("frequency", ends.alias("observed_range")).alias("time_index"), F.col("summary").alias("statistics"), "business_constraints", *[c for c in OPTIONAL if c in contexts.columns],
    )
    return contexts.select(key, packet.alias("evidence"))
