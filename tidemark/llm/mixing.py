"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time 0 to 1.  Its integral is the source's weight in the mix;
the targets share the wanted words by these weights, and no target exceeds ``most`` times its source.  A
source's documents stand in an order drawn from their ids, once for each pass over the source, and the words
taken are the first ``target`` ones of that sequence.  The word at place c of it is due when the source's
cumulative demand, target times the schedule's integral so far, reaches c: inverting that gives each copy its
training position, by which the mix is range-sorted.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise

#: A word of a text, and the white space between words.
WORD, WHITE = r"[^\x20\x09-\x0D]+", " \t\n\x0b\x0c\r"
#: Words of the mix, as a share of all words there are, and copies of a document at most.
SHARE, MOST = 1.5, 2
#: Documents of a source that are put in order together.
BUCKET_DOCS = 4096
#: Sources that are broadcast at most; more are joined by a shuffle.
BROADCAST_SOURCES = 10_000


@dataclass(frozen=True)
class Schedule:
    """A weight over training time: (time, weight) knots, linear in between; times rise from 0 to 1."""

    knots: tuple[tuple[float, float], ...]

    def __post_init__(self):
        times, weights = zip(*self.knots, strict=True)
        rising = all(a < b for a, b in zip(times, times[1:], strict=False))
        if not rising or (times[0], times[-1]) != (0, 1) or min(weights) < 0 or not max(weights) > 0:
            raise ValueError(f"not a schedule from 0 to 1: {self.knots}")

    def pieces(self) -> list[tuple[float, float, float, float, float]]:
        """(start, length, weight at the start, weight at the end, integral up to the start) of each piece."""
        found, total = [], 0.0
        for (t, a), (u, b) in zip(self.knots, self.knots[1:], strict=False):
            found.append((float(t), float(u - t), float(a), float(b), total))
            total += (u - t) * (a + b) / 2
        return found

    @property
    def weight(self) -> float:
        return sum((u - t) * (a + b) / 2 for (t, a), (u, b) in zip(self.knots, self.knots[1:], strict=False))

    def when_due(self, share: Column) -> Column:
        """The time at which that share (0 to below 1) of the schedule's integral has passed."""
        q = share * F.lit(self.weight)
        at = F.lit(1.0)
        for t, h, a, b, before in reversed(self.pieces()):
            if a + b:
                part = q - before
                root = F.sqrt(F.lit(a * a) + part * F.lit(2 * (b - a) / h))
                x = F.when(part > 0, 2 * part / (a + root)).otherwise(0.0)
                at = F.when(q < before + h * (a + b) / 2, F.least(t + x, F.lit(t + h))).otherwise(at)
        return at


#: Sources in code point order take these in turn: weights 5, 2 and 1, falling, even and rising over the training.
SCHEDULES = (Schedule(((0, 7.5), (1, 2.5))), Schedule(((0, 2.0), (1, 2.0))), Schedule(((0, 0.5), (1, 1.5))))


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _numbered(sources: DataFrame) -> DataFrame:
    """The sources with ``no``, their number in code point order from 0, null last.

    Ranges are ordered on their own; what lies before a range is a sum over the ranges' counts, as many as partitions.
    """
    order = [F.col("source").isNull(), F.col("source")]
    ranged = sources.repartitionByRange(_parts(sources), *order)
    ranged = materialise(ranged.withColumn("part", F.spark_partition_id()), "mix-sources")
    before = ranged.groupBy("part").agg(F.count("*").alias("n")).select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return ranged.join(F.broadcast(before), "part").select("source", "source_size", "n_docs", (F.col("before") + inside - 1).alias("no"))


def _level(sources: DataFrame, wanted: float) -> float:
    """Words for each unit of weight, when what exceeds a source's cap goes to the others by weight.

    Each step caps the sources that the last level fills, so levels rise until no further source fills up; the
    driver sees three sums a step.
    """
    level, capped = 0.0, -1
    while True:
        full = F.col("cap") <= F.lit(level) * F.col("weight")
        n, words, weight = sources.agg(F.count(F.when(full, 1)), F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0))).first()
        if n == capped or not weight:
            return level if weight else float("inf")
        level, capped = (wanted - words) / weight, n


def mix(
    docs: DataFrame,
    schedules: Sequence[Schedule] = SCHEDULES,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    share: float = SHARE,
    most: int = MOST,
) -> DataFrame:
    """doc_id, size, source_size, target, taken and draws of each document.

    ``size`` counts its words, ``taken`` those that the mix takes with repeats, ``draws`` are its copies
    (copy from 0, position in training, words).  Only the copy at which a source's target ends is taken in part.

    * A null or empty text has size 0, is never taken and has no draws; a null source is a source of its own.
    * Equal ids stand beside each other in a source's order (by size, then as equals), each row as its own document;
      a null id counts as an empty one.  Texts of any length count whole.
    * Other columns aren't read, so their names can't clash.  An empty table gives an empty result.
    """
    key = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    size = F.coalesce(F.length(F.translate(F.regexp_replace(text, WORD, "x"), WHITE, "")), F.lit(0)).cast("long")
    sized = materialise(docs.select(F.col(doc_id).alias("id"), F.col(source).cast("string").alias("source"), size.alias("size"), key.alias("key")), "mix-sizes")
    sources = _numbered(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs")))
    turn = F.pmod(F.col("no"), F.lit(len(schedules))).cast("int")
    weight = F.element_at(F.array(*[F.lit(float(s.weight)) for s in schedules]), turn + 1)
    sources = materialise(sources.withColumns({"turn": turn, "weight": weight, "cap": (most * F.col("source_size")).cast("double")}), "mix-weights")
    n_sources, words = sources.agg(F.count("*"), F.sum("source_size")).first()
    level = _level(sources, share * (words or 0))
    sources = sources.withColumn("target", F.least("cap", F.lit(level) * F.col("weight")) if level < float("inf") else F.col("cap"))
    if n_sources <= BROADCAST_SOURCES:
        sources = F.broadcast(sources)
    n_buckets = F.ceil(F.col("n_docs") / BUCKET_DOCS)
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    placed = sized.alias("d").join(sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))).select(
        "id", "size", "key", "no", "turn", "source_size", "target", F.floor(place * n_buckets / F.lit(1 << 32)).alias("bucket")
    )
    sums = placed.groupBy("no", "bucket").agg(F.sum("size").alias("words"))
    before = sums.select("no", "bucket", (F.sum("words").over(Window.partitionBy("no").orderBy("bucket")) - F.col("words")).alias("before"))
    inside = F.sum("size").over(Window.partitionBy("no", "bucket").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    at = placed.withColumn("inside", inside).join(before, ["no", "bucket"]).withColumn("at", F.col("before") + F.col("inside"))
    goal = F.floor(F.col("target") + 0.5)

    def draw(copy: int) -> Column:
        start = F.col("at") + copy * F.col("source_size")
        due = reduce(lambda c, k: c.when(F.col("turn") == k, schedules[k].when_due(start / goal)), range(1, len(schedules)), F.when(F.col("turn") == 0, schedules[0].when_due(start / goal)))
        words = F.greatest(F.least(F.col("size"), goal - start), F.lit(0)).cast("long")
        return F.struct(F.lit(copy).alias("copy"), F.when(words > 0, due).alias("position"), words.alias("words"))

    drawn = at.withColumn("draws", F.filter(F.array(*[draw(c) for c in range(most)]), lambda d: d["words"] > 0))
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda n, d: n + d["words"])
    return drawn.select(F.col("id").alias(doc_id), "size", "source_size", "target", taken.alias("taken"), "draws")


def by_position(mixed: DataFrame, *columns: str | Column) -> DataFrame:
    """``mixed`` range-sorted by the training position of each document's first copy; what isn't taken comes last."""
    placed = mixed.select(*(columns or ["*"]), F.get("draws", F.lit(0))["position"].alias("position"))
    order = [F.coalesce("position", F.lit(2.0)), F.col(mixed.columns[0])]
    return placed.repartitionByRange(_parts(mixed), *order).sortWithinPartitions(*order)


def training_order(mixed: DataFrame) -> DataFrame:
    """A row for each copy that the mix takes (the id, copy, position, words), range-sorted by position."""
    copies = mixed.select(mixed.columns[0], F.inline("draws"))
    order = ["position", mixed.columns[0], "copy"]
    return copies.repartitionByRange(_parts(mixed), *order).sortWithinPartitions(*order)
