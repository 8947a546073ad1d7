"""Hard negatives and centroid clustering against plain Python, with the cases of their docstrings."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ball_trees, hard_negatives
from tidemark.llm.ball_trees import BallTree, cluster
from tidemark.llm.hard_negatives import hard_negatives as mine

DDL = "vec_id long, embedding array<float>, label int"


def vectors(seed: int, n: int, size: int, copies: int = 0, spread: float = 0.3):
    r = random.Random(seed)
    made = [(i, [r.gauss((i % 4) * 0.2, spread) for _ in range(size)], r.choice([0, 0, 0, 1, 2, 3])) for i in range(n)]
    return made + [(n + i, made[0][1], made[0][2] + i % 2) for i in range(copies)]


def plain_negatives(rows, anchor, positives=5, negatives=5):
    whole = [(i, [math.floor(256 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows]
    found = []
    for a, va, la in whole:
        if not anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v, strict=True)), i, lab) for i, v, lab in whole if i != a)
        for p, positive, _ in [s for s in scored if s[2] == la][:positives]:
            inside = [(s, i) for s, i, lab in scored if lab != la and 80 * -p <= 100 * -s <= 100 * -p]
            found += [(a, positive, k, i, -p, -s) for k, (s, i) in enumerate(inside[:negatives], 1)]
    return sorted(found)


@pytest.mark.parametrize("seed", range(3))
def test_negatives_equal_a_full_sort(spark, seed, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 37)
    rows = vectors(seed, 300, 8, copies=60)
    got = mine(spark.createDataFrame(rows, DDL).repartition(5), lambda i: i % 10 == 0, pass_anchors=[7, 1000, 20][seed])
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows, lambda i: i % 10 == 0)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    good = vectors(5, 60, 4)
    odd = [(1000, None, 1), (1001, [1.0, None, 1.0, 1.0], 1), (1002, [1.0, nan, 1.0, 1.0], 1), (1003, [inf, 1.0, 1.0, 1.0], 1), (1004, [9.0] * 4, None), (None, [9.0] * 4, 1), (1005, [3e30] * 4, 1)]
    other = [(1100, [], 1), (1101, [], 1), (1102, [], 2), (1200, [5.0] * 3, 1)]
    df = spark.createDataFrame(good + odd + other + good[:9], DDL).withColumns({c: F.lit("clash") for c in ("id", "vec", "rank", "score")})
    got = sorted(map(tuple, mine(df).collect()))
    want = plain_negatives(good, lambda i: i % 100 == 0) + [(1100, 1101, 1, 1102, 0, 0)]
    assert got == want
    assert mine(spark.createDataFrame([], DDL)).collect() == []
    assert mine(spark.createDataFrame(good[1:], DDL)).collect() == []


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(0, [700_000.0] * 4, 0), (1, [700_000.0, 700_000.0, 700_000.0, 699_999.9375], 0), (2, [700_000.0, 700_000.0, 700_000.0, 699_999.875], 1), (3, [-1.0] * 4, 0), (4, [-2.0] * 4, 1)]
    got = sorted(map(tuple, mine(spark.createDataFrame(rows, DDL)).collect()))
    assert got == plain_negatives(rows, lambda i: i % 100 == 0)
    assert any(r[4] > 2**53 for r in got)


def plain_clusters(rows, k, rounds):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, _ in rows]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    now = [v for _, v in first[:k]]

    def nearest():
        return [min((sum((x - y) ** 2 for x, y in zip(v, m, strict=True)), c) for c, m in enumerate(now)) for _, v in kept]

    for _ in range(rounds):
        at = nearest()
        for c in range(len(now)):
            own = [v for (_, v), (_, b) in zip(kept, at, strict=True) if b == c]
            if own:
                now[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    at = nearest()
    inertia = [sum(d for d, b in at if b == c) for c in range(len(now))]
    digest = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in now]
    return sorted((i, c, d, inertia[c], sum(inertia), digest[c]) for (i, _), (d, c) in zip(kept, at, strict=True))


@pytest.mark.parametrize(("seed", "spread", "copies"), [(0, 0.3, 0), (1, 0.01, 80), (2, 0.0, 150)])
def test_clusters_equal_plain_ones(spark, seed, spread, copies, monkeypatch):
    monkeypatch.setattr(ball_trees, "TREE_ROWS", 61)
    rows = vectors(seed, 250, 6, copies, spread)
    got = cluster(spark.createDataFrame(rows, DDL).repartition(3), k=7, rounds=3, components=6)
    assert sorted(map(tuple, got.collect())) == plain_clusters(rows, 7, 3)


def test_balls_hold_their_vectors_and_assign_whole(spark):
    rng = np.random.default_rng(3)
    middle = rng.integers(-500, 500, (12, 64))
    vecs = (middle[rng.integers(0, 12, 2000)] + rng.integers(-8, 9, (2000, 64))).astype(np.int32)
    tree = BallTree(np.arange(2000), np.ones(2000, bool), vecs, 16)
    for b in range(len(tree.lo)):
        own = tree.vecs[tree.lo[b] : tree.hi[b]]
        assert tree.counts[b] == len(own) and (tree.sums[b] == own.sum(0)).all()
        assert np.sqrt(((own - tree.centres[b]) ** 2).sum(1)).max() <= tree.radii[b] + 1e-9
    same = BallTree.unpacked(tree.packed(), 64)
    at, computed = same.assign(middle)
    full = ((tree.vecs[:, None].astype(np.int64) - middle[None]) ** 2).sum(2)
    assert (at == full.argmin(1)).all() and computed < 0.1 * full.size
    totals = same.totals(middle)
    for c in range(12):
        assert totals[c, 0] == (at == c).sum() and (totals[c, 1:] == tree.vecs[at == c].sum(0)).all()


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    good = vectors(9, 30, 4)
    odd = [(1, None, 1), (2, [1.0, None, 1.0, 1.0], 1), (3, [1.0, nan, 1.0, 1.0], 1), (4, [inf, 1.0, 1.0, 1.0], 1), (5, [1.0] * 3, 1), (6, [], 1), (7, [1e30] * 4, 1)]
    df = spark.createDataFrame(good + odd + good[:5], DDL).withColumns({c: F.lit("clash") for c in ("id", "vec", "cluster", "distance")})
    got = cluster(df, k=5, rounds=2, components=4)
    assert sorted(map(tuple, got.collect())) == plain_clusters(good + good[:5], 5, 2)
    assert cluster(spark.createDataFrame([], DDL)).collect() == []
    few = cluster(spark.createDataFrame([(None, [0.5] * 4, None), (8, [0.1] * 4, 1)], DDL), components=4).collect()
    assert sorted((r.vec_id is None, r.cluster, r.distance) for r in few) == [(False, 0, 0), (True, 1, 0)]


def test_distances_beyond_doubles_are_exact():
    vecs = np.array([[2**26 + 1, 3], [-(2**26), 5]], np.int32)
    centroids = np.array([[2**26, 3], [-(2**26) - 1, 4]], np.int64)
    assert ball_trees.squared_distances(vecs, centroids).tolist() == [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, m, strict=True)) for m in centroids] for v in vecs]
