"""Quality rules whose cutoffs are certified on labelled documents, in DataFrame functions only.

A cutoff is certified in a stratum when the exact binomial test says, after correction for all tests, that it
rejects more than ``alpha`` of the good documents there with a probability of at most ``delta``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 8
#: Highest share of a stratum's good documents that all rules together may reject, and the risk of more.
ALPHA, DELTA = 0.01, 0.05
#: First words of a stratum: documents are grouped by length, so there are as many strata at any size.
STRATA = (0, 100, 400, 1600)
#: Rules and the cutoffs tried for each, from the most lenient; a document is rejected above the cutoff.
RULES: dict[str, list[float]] = {
    "symbols_per_word": [round(3 * 0.8**k, 6) for k in range(20)],
    "capitals_share": [round(0.95 - 0.05 * k, 6) for k in range(16)],
    "dup_line_share": [round(0.9 - 0.05 * k, 6) for k in range(16)],
    "repeat_word_share": [round(0.3 - 0.02 * k, 6) for k in range(14)],
    "word_length": [round(30 * 0.9**k, 6) for k in range(16)],
    "word_shortness": [round(-1 - 0.2 * k, 6) for k in range(12)],
}


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once for each row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _covered(hashes: Column) -> Column:
    """Words that lie in a window whose hash occurs twice or more."""
    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(s: Column) -> Column:
        near = lambda j: F.coalesce(F.get(s, j)["h"], F.lit(None))
        return F.filter(s, lambda x, i: F.coalesce(near(i - 1) == x["h"], F.lit(False)) | F.coalesce(near(i + 1) == x["h"], F.lit(False)))

    places = _let(ordered, lambda s: F.sort_array(F.transform(repeated(s), lambda x: x["i"])))
    width = F.lit(WINDOW)
    added = lambda p: F.transform(p, lambda v, i: F.least(width, F.coalesce(F.get(p, i + 1) - v, width)))
    return _let(places, lambda p: F.aggregate(added(p), F.lit(0).cast("long"), lambda a, x: a + x))


def features(docs: DataFrame, *, text: str = "text", keep: list[str]) -> DataFrame:
    """``keep`` and the measures of each whole text; a null text has none of anything.

    Words are ``[^\\x20\\x09-\\x0D]+``.  Adds n_words, word_chars (code points in words), n_symbols,
    n_capitals (A-Z), n_lines (with a word), n_dup_lines (equal to an earlier one), n_repeat_words (words in
    8-word windows found twice or more).
    """
    gone = lambda chars: F.length("__t") - F.length(F.translate("__t", chars, ""))
    df = docs.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__t"))
    df = df.withColumn("__w", F.filter(F.split("__t", "[\\x20\\x09-\\x0D]+"), lambda w: w != ""))
    df = df.withColumn("__l", F.filter(F.split("__t", "\n"), lambda x: F.translate(x, WHITE, "") != ""))
    many = F.size("__w") >= WINDOW
    starts = F.when(many, F.sequence(F.lit(1), F.size("__w") - WINDOW + 1)).otherwise(F.array().cast("array<int>"))
    df = df.withColumn("__h", F.transform(starts, lambda i: F.xxhash64(F.slice("__w", i, WINDOW))))
    again = F.size(F.array_distinct("__h")) < F.size("__h")
    return df.select(
        *[F.col(f"`{c}`") for c in keep],
        F.size("__w").cast("long").alias("n_words"),
        F.length(F.translate("__t", WHITE, "")).cast("long").alias("word_chars"),
        gone(SYMBOLS).cast("long").alias("n_symbols"),
        gone(CAPITALS).cast("long").alias("n_capitals"),
        F.size("__l").cast("long").alias("n_lines"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.when(again, _covered(F.col("__h"))).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def stratum() -> Column:
    """The number of the length class."""
    return sum(((F.col("n_words") >= n).cast("int") for n in STRATA[1:]), F.lit(0))


def _measures() -> dict[str, Column]:
    per = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return {
        "symbols_per_word": per("n_symbols", "n_words"),
        "capitals_share": per("n_capitals", "word_chars"),
        "dup_line_share": per("n_dup_lines", "n_lines"),
        "repeat_word_share": per("n_repeat_words", "n_words"),
        "word_length": per("word_chars", "n_words"),
        "word_shortness": -per("word_chars", "n_words"),
    }


def _log_gamma(z: Column) -> Column:
    """By Stirling's series eight above; right to 12 digits for z of at least 1."""
    y = z + 8
    below = sum((F.log(z + k) for k in range(1, 8)), F.log(z))
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * F.pow(y, 3)) + 1 / (1260 * F.pow(y, 5)) - below


def binomial_tail(x: Column, n: Column, p: float, terms: int = 400) -> Column:
    """P(X <= x) for n trials of chance p, or 1 where x is above the mean.

    The largest ``terms`` terms are added; what is left out is bounded by their geometric series and added
    too, so the value is never below the exact one.
    """
    x, n = x.cast("double"), n.cast("double")
    peak = _log_gamma(n + 1) - _log_gamma(x + 1) - _log_gamma(n - x + 1) + x * math.log(p) + (n - x) * math.log1p(-p)
    ratio = lambda i: i * (1 - p) / ((n - i + 1) * p)  # noqa: E731  of the term before to that of i
    summed = F.aggregate(
        F.sequence(F.lit(0), F.least(x, F.lit(float(terms))).cast("int")),
        F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("total")),
        lambda acc, k: F.struct((acc["term"] * ratio(x - k)).alias("term"), (acc["total"] + acc["term"]).alias("total")),
        lambda acc: acc["total"] + F.when(x > terms, acc["term"] / (1 - ratio(x - terms))).otherwise(0.0),
    )
    return F.when(x > n * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.exp(peak) * summed))


def certify(measured: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", label: str = "quality", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """A row for each stratum and rule with a certified cutoff.

    Each rule gets an equal share of ``alpha``.  In a stratum its cutoffs are tested from the most lenient
    one on and testing stops at the first that fails (so they need no correction among themselves); rules
    and strata share ``delta`` by Bonferroni's correction.  Of the certified cutoffs the one with the most
    bad minus good documents rejected is taken, the most lenient of equal ones; none if it rejects none.
    All labelled documents that pass the base rules count, conflicting labels of an id as bad.
    """
    marks = labels.where(F.col(label).isNotNull()).groupBy(doc_id).agg(F.min(label).cast("int").alias("__good"))
    known = measured.where(~base_failed()).join(marks, doc_id)
    passed = [
        F.struct(F.lit(name).alias("rule"), sum(((m > c).cast("int") for c in RULES[name]), F.lit(0)).alias("level"))
        for name, m in _measures().items()
    ]
    levels = (
        known.select(stratum().alias("stratum"), "__good", F.inline(F.array(*passed)))
        .groupBy("stratum", "rule", "level")
        .agg(F.sum(F.when(F.col("__good") > 0, 1).otherwise(0)).alias("good"), F.sum(F.when(F.col("__good") > 0, 0).otherwise(1)).alias("bad"))
    )
    spark = measured.sparkSession
    grid = spark.createDataFrame([(s, r, k, c) for s in range(len(STRATA)) for r, cs in RULES.items() for k, c in enumerate(cs, 1)], "stratum int, rule string, nth int, cutoff double")
    # a document of level l is above the first cutoffs up to the number l
    counted = (
        grid.join(levels, ["stratum", "rule"])
        .groupBy("stratum", "rule", "nth", "cutoff")
        .agg(
            F.sum("good").alias("n"),
            F.sum(F.when(F.col("level") >= F.col("nth"), F.col("good")).otherwise(0)).alias("x"),
            F.sum(F.when(F.col("level") >= F.col("nth"), F.col("bad")).otherwise(0)).alias("caught"),
        )
    )
    fine = binomial_tail(F.col("x"), F.col("n"), alpha / len(RULES)) <= delta / (len(RULES) * len(STRATA))
    so_far = Window.partitionBy("stratum", "rule").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    best = Window.partitionBy("stratum", "rule").orderBy((F.col("x") - F.col("caught")), "nth")
    return (
        counted.withColumn("fine", F.min(F.coalesce(fine, F.lit(False)).cast("int")).over(so_far))
        .where("fine = 1 AND caught > x")
        .withColumn("place", F.row_number().over(best))
        .where("place = 1")
        .select("stratum", "rule", "cutoff", "n", "x", "caught")
    )


def judge(measured: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Add base_failed and kept: false for base failures and above a certified cutoff of the stratum.

    ``cutoffs`` has a row for each stratum and rule at most, both fixed in number, so it is broadcast.
    """
    wide = cutoffs.groupBy("stratum").pivot("rule", list(RULES)).agg(F.first("cutoff"))
    above = [F.coalesce(m > F.col(name), F.lit(False)) for name, m in _measures().items()]
    rejected = above[0]
    for a in above[1:]:
        rejected = rejected | a
    return (
        measured.withColumn("stratum", stratum())
        .join(F.broadcast(wide), "stratum", "left")
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & ~rejected)
        .drop("stratum", *RULES)
    )


def apply_rules(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Measure every document once, certify cutoffs on the labelled ones, and judge all.

    Defined cases: a null or empty text fails the base rules; without labels (or too few to certify a
    cutoff) only the base rules reject; repeated documents each get their row, and count as often among
    the labelled ones; other columns play no part.
    """
    measured = materialise(features(docs, text=text, keep=[doc_id]), "quality-measures")
    return judge(measured, certify(measured, labels, doc_id=doc_id, label=label, alpha=alpha, delta=delta))
