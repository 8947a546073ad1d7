"""A corpus pipeline: toxic documents out, repeated lines out, one document of each near-duplicate group, no
contaminated documents or benchmark passages, and what is left packed into training sequences.

An empty table passes through every stage as an empty table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, line_dedup, near_duplicates, packing, toxicity
from tidemark.llm.common import WORD_TABLE, discard, materialise, release

#: Whether a text has a word, as the later stages see words.
_WORDLESS = "".join(chr(b) for b in range(128) if WORD_TABLE[b] == 32)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model doesn't reject; null and empty texts have no severity and stay."""
    release(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.where(~F.col("rejected")).select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier one; n_chars follows the text.

    Near copies of whole documents keep the lines that they share: taken apart they would no longer look like
    each other to the next stage.  A document all of whose words stood in repeated lines goes.  A null or
    empty text stays as it is.
    """
    release(spark)
    clean = line_dedup.dedup_lines(docs, spare_copies=True)
    changed = F.col("n_exact") + F.col("n_near") > 0
    emptied = changed & (F.translate("text", _WORDLESS, "") == "")
    return _counted(clean.where(~F.coalesce(emptied, F.lit(False))), docs, changed)


def _counted(changed_docs: DataFrame, docs: DataFrame, changed: Column) -> DataFrame:
    """The columns of ``docs``, with n_chars (if there) that of the text where it changed."""
    if "n_chars" in docs.columns:
        n = F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
        changed_docs = changed_docs.withColumn("n_chars", n)
    return changed_docs.select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that with the least id; documents without words all stay.

    Groups are looked for in the texts as they are here and as they were before lines were taken out of them; without
    a folder of tables (an empty name) the texts are as they were.
    """
    release(spark)
    untouched = spark.read.parquet(f"{sf_dir}/documents.parquet") if sf_dir else None
    return near_duplicates.drop_near_duplicates(docs, untouched=untouched)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth occurs in benchmark items, without runs of 13 hit words or more.

    n_chars follows the text.  Null and wordless texts are kept; equal documents fare alike.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    measured = decontamination.decontaminate(docs, items, longest=decontamination.WINDOW).where(~F.col("contaminated"))
    return _counted(decontamination.remove_cut_spans(measured), docs, F.size("cut_spans") > 0)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each piece of each document with its sequence and place there; a null or empty text is its end mark alone."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: The stages rest on fitted weights and hashed sketches, which SQL can't express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
