"""Hard negatives by a full score sort for each anchor.

Anchors are a stated query set against all rows, in blocks: a bounded number of anchors is broadcast and the
rows stream past them.  For each block and anchor the integer scores are sorted by score and id; a binary search
finds each positive's upper limit, and the first entries of another label from there on, down to the lower limit,
are the block's candidates.  The first ones over all blocks are the first ones over all rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import discard, materialise
from tidemark.session import ship_package

#: Factor of components, positives of an anchor and negatives of a positive.
SCALE, POSITIVES, NEGATIVES = 256, 5, 5
#: A negative's score as a share of its positive's, in hundredths: from and up to.
LOWER, UPPER = 80, 100
#: Anchors of one pass over the rows (their vectors are broadcast), and rows sorted together.
PASS_ANCHORS, BLOCK_ROWS = 16_384, 8_192
#: Squared length of a scaled vector from which its scores might not fit a long.
LONGEST = float(1 << 60)


def scaled(rows: DataFrame, vec_id: str, embedding: str, label: str, scale: int = SCALE) -> DataFrame:
    """(id, label, vec) of the rows that take part, vec being floor(scale * x) of each component; one row an id."""
    x = F.col(embedding).cast("array<double>")
    finite = F.forall(x, lambda c: F.coalesce(F.abs(c) < F.lit(float("inf")), F.lit(False)))
    length = F.aggregate(x, F.lit(0.0), lambda s, c: s + c * c * F.lit(float(scale * scale)))
    part = rows.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.coalesce(finite, F.lit(False))).where(length < LONGEST)
    whole = part.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.transform(x, lambda c: F.floor(c * scale)).alias("vec"))
    one = whole.groupBy("id").agg(F.min(F.struct("label", "vec")).alias("r"))
    return one.select("id", "r.label", "r.vec")


class Rows:
    """Vectors of one length, with their ids and labels."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vecs: np.ndarray):
        self.ids, self.labels, self.vecs = ids, labels, vecs
        self.norm = float(np.sqrt((vecs.astype(np.float64) ** 2).sum(1).max(initial=0.0)))

    def scores(self, vecs: np.ndarray, norm: float) -> np.ndarray:
        """Exact inner products of ``vecs`` with each row: in doubles as long as these hold every partial sum."""
        if self.norm * norm < 2**52:
            return (vecs.astype(np.float64) @ self.vecs.astype(np.float64).T).astype(np.int64)
        return vecs @ self.vecs.T


def _by_length(ids: np.ndarray, labels: np.ndarray, vec: pa.ListArray) -> dict[int, Rows]:
    """Rows by the length of their vectors: only those of one length have a score with each other."""
    offsets = vec.offsets.to_numpy()
    sizes, values = np.diff(offsets), vec.values.to_numpy(zero_copy_only=False)
    found = {}
    for n in np.unique(sizes):
        at = np.flatnonzero(sizes == n)
        found[int(n)] = Rows(ids[at], labels[at], values[offsets[at][:, None] + np.arange(n)].astype(np.int64).reshape(len(at), n))
    return found


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[int, Rows]]:
    held: list[pa.RecordBatch] = []

    def one() -> dict[int, Rows]:
        table = pa.Table.from_batches(held).combine_chunks()
        columns = [table.column(c).chunk(0) if table.num_rows else table.column(c) for c in ("id", "label", "vec")]
        return _by_length(columns[0].to_numpy(), columns[1].to_numpy(), columns[2])

    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            held.append(batch.slice(at, BLOCK_ROWS))
            if sum(b.num_rows for b in held) >= BLOCK_ROWS:
                yield one()
                held.clear()
    if held:
        yield one()


def _first(found: list[tuple[int, int]], more: list[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    """The first n of (negated score, id)."""
    return sorted(found + more)[:n] if found else more[:n]


def _rows_of(collected: list) -> dict[int, Rows]:
    groups = defaultdict(list)
    for r in sorted(collected, key=lambda r: r["id"]):
        groups[len(r["vec"])].append(r)
    return {n: Rows(np.array([r["id"] for r in g]), np.array([r["label"] for r in g]), np.array([r["vec"] for r in g], dtype=np.int64).reshape(len(g), n)) for n, g in groups.items()}


def first_positives(block: Rows, anchors: Rows, n: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """For each anchor its first n other rows of the same label in the block, as (negated score, id)."""
    scores = block.scores(anchors.vecs, anchors.norm)
    for a, (anchor, label) in enumerate(zip(anchors.ids, anchors.labels, strict=True)):
        at = np.flatnonzero((block.labels == label) & (block.ids != anchor))
        s, ids = scores[a, at], block.ids[at]
        order = np.lexsort((ids, -s))[:n]
        yield int(anchor), list(zip((-s[order]).tolist(), ids[order].tolist(), strict=True))


def first_negatives(block: Rows, anchors: Rows, positives: dict[int, list[tuple[int, int]]], n: int, lower: int, upper: int) -> Iterator[tuple[int, int, int, list[tuple[int, int]]]]:
    """For each anchor and positive the first n rows of another label within the limits, as (negated score, id)."""
    scores = block.scores(anchors.vecs, anchors.norm)
    for a, (anchor, label) in enumerate(zip(anchors.ids.tolist(), anchors.labels, strict=True)):
        wanted = positives.get(anchor)
        if not wanted:
            continue
        at = np.flatnonzero(block.labels != label)
        s, ids = -scores[a, at], block.ids[at]
        order = np.lexsort((ids, s))
        s, ids = s[order], ids[order]
        for score, positive in wanted:
            most, least = upper * score // 100, -(-lower * score // 100)
            begin = int(np.searchsorted(s, -most))
            end = min(int(np.searchsorted(s, -least, side="right")), begin + n)
            if begin < end:
                yield anchor, positive, score, list(zip(s[begin:end].tolist(), ids[begin:end].tolist(), strict=True))


def _in_order(df: DataFrame, by: list[str], score: str, other: str, n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(score), other))
    return df.withColumn("rank", rank).where(F.col("rank") <= n)


def hard_negatives(
    rows: DataFrame,
    anchors: Callable[[Column], Column] = lambda i: i % 100 == 0,
    *,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lower: int = LOWER,
    upper: int = UPPER,
    pass_anchors: int = PASS_ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score for each row whose id meets ``anchors``.

    An anchor's positives are its first ``positives`` other rows of the same label, a positive's negatives the first
    ``negatives`` rows of another label whose score is from ``lower`` to ``upper`` hundredths of the positive's; ties
    go to the smaller id.  A positive below zero has no negatives.

    * Rows with a null id, label or vector, or a null or non-finite component take no part, nor do vectors so long
      (squared length of 2**60 after scaling) that a score might not fit a long.
    * Vectors of different lengths have no score with each other; empty ones score 0 with each other.
    * Of rows with one id, the one with the least label, then vector, takes part; so repeated rows count once.
    * Other columns aren't read.  An empty table, or none that is an anchor, gives an empty result.
    """
    spark = rows.sparkSession
    ship_package(spark)
    table = materialise(scaled(rows, vec_id, embedding, label), "vectors")
    chosen = table.where(F.coalesce(anchors(F.col("id")), F.lit(False)))
    passes = max(1, -(-chosen.count() // pass_anchors))
    parts = []
    for k in range(passes):
        own = _rows_of(chosen.where(F.pmod(F.xxhash64("id"), F.lit(passes)) == k).collect())
        parts.append(materialise(_one_pass(table, own, positives, negatives, lower, upper), "negatives"))
    discard(table)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def _one_pass(table: DataFrame, own: dict[int, Rows], n_positives: int, n_negatives: int, lower: int, upper: int) -> DataFrame:
    spark = table.sparkSession
    sent = spark.sparkContext.broadcast(own)

    def same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list] = {}
        for block in _blocks(batches):
            for n, part in block.items():
                if n in sent.value:
                    for anchor, found in first_positives(part, sent.value[n], n_positives):
                        if found:
                            best[anchor] = _first(best.get(anchor, []), found, n_positives)
        flat = [(a, i, -s) for a, found in best.items() for s, i in found]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*flat, strict=True)] if flat else [pa.array([], pa.int64())] * 3, ["anchor_id", "positive_id", "positive_score"])

    near = _in_order(table.mapInArrow(same, "anchor_id long, positive_id long, positive_score long"), ["anchor_id"], "positive_score", "positive_id", n_positives)
    wanted: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for r in near.collect():
        wanted[r.anchor_id].append((r.positive_score, r.positive_id))
    limits = spark.sparkContext.broadcast(dict(wanted))

    def other(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, int, int], list] = {}
        for block in _blocks(batches):
            for n, part in block.items():
                if n in sent.value:
                    for anchor, positive, score, found in first_negatives(part, sent.value[n], limits.value, n_negatives, lower, upper):
                        at = (anchor, positive, score)
                        best[at] = _first(best.get(at, []), found, n_negatives)
        flat = [(*at, i, -s) for at, found in best.items() for s, i in found]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*flat, strict=True)] if flat else [pa.array([], pa.int64())] * 5, ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])

    found = table.mapInArrow(other, "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    ranked = _in_order(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", n_negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
