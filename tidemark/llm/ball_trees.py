"""Centroid clustering of integer vectors, filtered by ball trees.

Each partition builds metric trees of a bounded number of its vectors once; a ball stores its radius, count and
integer sum.  In each round the centroids, k of them, go to every task.  A centroid whose distance less the
radius exceeds another's distance plus the radius is nearest to no vector of the ball (triangle inequality), so
it isn't looked at below; a ball with one centroid left is counted whole, and in leaves with several the
distances are computed exactly.  Sums meet by cluster and component, and the centroids move to their exact floors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, materialise
from tidemark.session import ship_package

#: Components, their factor, centroids and rounds.
COMPONENTS, SCALE, CLUSTERS, ROUNDS = 64, 256, 40, 5
#: Vectors of one tree and of a leaf at most.
TREE_ROWS, LEAF_ROWS = 8_192, 32
#: Absolute value of a scaled component up to which squared distances of 64 components fit a long.
LARGEST = float(1 << 27)


def kept_vectors(rows: DataFrame, vec_id: str, embedding: str, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(id, vec) of the rows with that many components, all finite; vec is floor(scale * x) of each."""
    x = F.col(embedding).cast("array<double>")
    fine = F.forall(x, lambda c: F.coalesce(F.abs(c) * F.lit(float(scale)) < LARGEST, F.lit(False)))
    whole = rows.where(F.coalesce((F.size(embedding) == components) & fine, F.lit(False)))
    return whole.select(F.col(vec_id).cast("long").alias("id"), F.transform(x, lambda c: F.floor(c * scale).cast("int")).alias("vec"))


class BallTree:
    """Balls over ``vecs`` (integers), halved along the line between two far vectors down to leaves.

    Ball i covers the vectors lo[i] to hi[i] of the reordered ``vecs``; balls stand in breadth-first order.
    """

    def __init__(self, ids: np.ndarray, valid: np.ndarray, vecs: np.ndarray, leaf: int = LEAF_ROWS):
        order, points = np.arange(len(vecs)), vecs.astype(np.float64)
        lo, hi, parent, level, left = [0], [len(vecs)], [-1], [0], []
        centres, radii = [], []
        at = 0
        while at < len(lo):
            own = order[lo[at] : hi[at]]
            p = points[own]
            centre = p.mean(0)
            away = np.sqrt(((p - centre) ** 2).sum(1))
            centres.append(centre)
            radii.append(float(away.max()))
            if len(own) > leaf and radii[-1] > 0:
                one = p[int(away.argmax())]
                two = p[int(((p - one) ** 2).sum(1).argmax())]
                half = len(own) // 2
                order[lo[at] : hi[at]] = own[np.argpartition(p @ (two - one), half)]
                left.append(len(lo))
                for a, b in ((lo[at], lo[at] + half), (lo[at] + half, hi[at])):
                    lo.append(a), hi.append(b), parent.append(at), level.append(level[at] + 1)
            else:
                left.append(-1)
            at += 1
        self.ids, self.valid, self.vecs = ids[order], valid[order], vecs[order]
        self.lo, self.hi, self.parent, self.level, self.left = (np.array(x, dtype=np.int32) for x in (lo, hi, parent, level, left))
        self.centres, self.radii = np.array(centres), np.array(radii)
        before = np.vstack([np.zeros((1, vecs.shape[1]), np.int64), np.cumsum(self.vecs, 0, dtype=np.int64)])
        self.sums, self.counts = before[self.hi] - before[self.lo], self.hi - self.lo

    FIELDS = [("ids", np.int64), ("valid", np.bool_), ("vecs", np.int32), ("lo", np.int32), ("hi", np.int32), ("parent", np.int32), ("level", np.int32), ("left", np.int32), ("centres", np.float64), ("radii", np.float64), ("sums", np.int64), ("counts", np.int64)]

    def packed(self) -> list[bytes]:
        return [np.ascontiguousarray(getattr(self, name), dtype=kind).tobytes() for name, kind in self.FIELDS]

    @classmethod
    def unpacked(cls, parts: list[bytes], components: int) -> BallTree:
        tree = cls.__new__(cls)
        for (name, kind), raw in zip(cls.FIELDS, parts, strict=True):
            value = np.frombuffer(raw, dtype=kind)
            setattr(tree, name, value.reshape(-1, components) if name in ("vecs", "centres", "sums") else value)
        return tree

    def assign(self, centroids: np.ndarray) -> tuple[np.ndarray, int]:
        """The number of the nearest centroid of each vector (ties: the smaller number); how many distances were computed in leaves."""
        cluster = np.empty(len(self.vecs), np.int32)
        computed = 0
        for ball, candidates in self._undecided(centroids, cluster):
            at = slice(self.lo[ball], self.hi[ball])
            away = squared_distances(self.vecs[at], centroids[candidates])
            cluster[at] = candidates[away.argmin(1)]
            computed += away.size
        return cluster, computed

    def totals(self, centroids: np.ndarray) -> np.ndarray:
        """Count and component sums of the vectors nearest to each centroid; balls that fall to one centroid add what they store."""
        found = np.zeros((len(centroids), self.vecs.shape[1] + 1), np.int64)
        for ball, candidates in self._undecided(centroids, None, found):
            own = self.vecs[self.lo[ball] : self.hi[ball]]
            near = squared_distances(own, centroids[candidates]).argmin(1)
            for k in np.unique(near):
                mine = own[near == k]
                found[candidates[k], 0] += len(mine)
                found[candidates[k], 1:] += mine.sum(0, dtype=np.int64)
        return found

    def _undecided(self, centroids: np.ndarray, cluster: np.ndarray | None, found: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves with several candidates; whole balls with one go to ``cluster`` or ``found`` on the way.

        Distances of centres are rounded, so a margin far above their error keeps a centroid in doubt.
        """
        m = centroids.astype(np.float64)
        squares = (self.centres**2).sum(1)[:, None] - 2 * self.centres @ m.T + (m**2).sum(1)
        away = np.sqrt(np.maximum(squares, 0))
        margin = 1e-6 * (np.sqrt((self.centres**2).sum(1)) + np.sqrt((m**2).sum(1).max())) + 1e-9
        least, most = away - self.radii[:, None] - margin[:, None], away + self.radii[:, None]
        open_balls, candidates = np.array([0]), np.ones((1, len(m)), bool)
        while len(open_balls):
            bound = np.where(candidates, most[open_balls], np.inf).min(1)
            candidates &= least[open_balls] <= bound[:, None]
            one = candidates.sum(1) == 1
            for ball, k in zip(open_balls[one], candidates[one].argmax(1), strict=True):
                if cluster is not None:
                    cluster[self.lo[ball] : self.hi[ball]] = k
                else:
                    found[k, 0] += self.counts[ball]
                    found[k, 1:] += self.sums[ball]
            leaf = ~one & (self.left[open_balls] < 0)
            for ball, own in zip(open_balls[leaf], candidates[leaf], strict=True):
                yield int(ball), np.flatnonzero(own)
            down = ~one & ~leaf
            children = self.left[open_balls[down]]
            open_balls = np.concatenate([children, children + 1])
            candidates = np.concatenate([candidates[down]] * 2)


def squared_distances(vecs: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer vectors: in doubles as long as these hold every partial sum."""
    largest = max(int(np.abs(vecs).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    kind = np.float64 if vecs.shape[1] * (2 * largest) ** 2 < 2**52 else np.int64
    v, m = vecs.astype(kind), centroids.astype(kind)
    return ((v * v).sum(1)[:, None] - 2 * (v @ m.T) + (m * m).sum(1)).astype(np.int64)


def _matrix(column: pa.ListArray, components: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, components)


def grow_trees(vectors: DataFrame, components: int = COMPONENTS, rows: int = TREE_ROWS, leaf: int = LEAF_ROWS) -> DataFrame:
    """A row for each tree: the arrays of a BallTree as bytes.  A tree has ``rows`` vectors of one partition at most."""

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def tree() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            ids, vecs = table.column("id").combine_chunks(), table.column("vec").combine_chunks()
            made = BallTree(ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_valid().to_numpy(zero_copy_only=False), _matrix(vecs, components), leaf)
            return pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in made.packed()], [n for n, _ in BallTree.FIELDS])

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                held.append(batch.slice(at, rows - sum(b.num_rows for b in held)))
                at += held[-1].num_rows
                if sum(b.num_rows for b in held) == rows:
                    yield tree()
                    held.clear()
        if sum(b.num_rows for b in held):
            yield tree()

    return vectors.mapInArrow(grow, ", ".join(f"{n} binary" for n, _ in BallTree.FIELDS))


def _trees_of(batches: Iterator[pa.RecordBatch], components: int) -> Iterator[BallTree]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield BallTree.unpacked([c[i].as_py() for c in batch.columns], components)


def first_centroids(vectors: DataFrame, k: int = CLUSTERS) -> np.ndarray:
    """The vectors with the k smallest sha256 of ``2:<id>``, in that order; null ids last, equal ids by their vectors."""
    digest = F.sha2(F.concat(F.lit("2:"), F.col("id").cast("string")), 256)
    rows = vectors.select(digest.alias("digest"), "vec").orderBy(F.col("digest").asc_nulls_last(), "vec").limit(k).collect()
    return np.array([r.vec for r in rows], dtype=np.int64)


def moved(trees: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: exact floors of their vectors' means; one without vectors stays."""
    components = centroids.shape[1]
    sent = trees.sparkSession.sparkContext.broadcast(centroids)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((len(sent.value), components + 1), np.int64)
        for tree in _trees_of(batches, components):
            found += tree.totals(sent.value)
        used = np.flatnonzero(found[:, 0])
        values = pa.array(found[used].ravel())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1, dtype=np.int32) * (components + 1)), values)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), lists], ["cluster", "totals"])

    each = trees.mapInArrow(totals, "cluster int, totals array<long>").select("cluster", F.posexplode("totals").alias("pos", "n"))
    rows = each.groupBy("cluster", "pos").agg(F.sum(F.col("n").cast("decimal(20,0)")).alias("n")).collect()
    sums = {(r.cluster, r.pos): int(r.n) for r in rows}
    after = centroids.copy()
    for k in {k for k, _ in sums}:
        after[k] = [sums[k, i + 1] // sums[k, 0] for i in range(components)]
    return after


def assigned(trees: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance) of every vector; ``distance`` is squared."""
    components = centroids.shape[1]
    sent = trees.sparkSession.sparkContext.broadcast(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree in _trees_of(batches, components):
            cluster, _ = tree.assign(sent.value)
            gap = tree.vecs.astype(np.int64) - sent.value[cluster]
            ids = pa.array(tree.ids, pa.int64(), mask=~tree.valid)
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster), pa.array((gap * gap).sum(1))], ["id", "cluster", "distance"])

    return trees.mapInArrow(assign, "id long, cluster int, distance long")


def cluster(
    rows: DataFrame,
    *,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    components: int = COMPONENTS,
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of each vector that takes part.

    * Vectors of another length, null ones and those with a null or non-finite component take no part; neither do
      those with a component of 2**19 or more (2**27 scaled), whose squared distances might not fit a long.
    * Every row is a vector of its own, repeated rows included; null ids become centroids only if there are fewer
      than ``k`` others.  With fewer than ``k`` vectors each starts a cluster.
    * Other columns aren't read.  An empty table, or one without such vectors, gives an empty result.
    """
    spark = rows.sparkSession
    ship_package(spark)
    vectors = kept_vectors(rows, vec_id, embedding, components)
    centroids = first_centroids(vectors, k)
    if not len(centroids):
        return spark.createDataFrame([], f"`{vec_id}` long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    trees = materialise(grow_trees(vectors, components), "ball-trees")
    for _ in range(rounds):
        centroids = moved(trees, centroids)
    found = materialise(assigned(trees, centroids), "clusters")
    discard(trees)
    inertia = {r.cluster: r.n for r in found.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}
    total = sum(inertia.values())
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    about = spark.createDataFrame([(c, n, total, digests[c]) for c, n in inertia.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select(F.col("id").alias(vec_id), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
