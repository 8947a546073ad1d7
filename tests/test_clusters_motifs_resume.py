"""Clusters and medoids, matrix profiles, and generation that goes on, each against a plain version."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators.clusters import components, global_or_local, series_clusters
from tidemark.operators.motifs import matrix_profile, motifs_and_discords
from tidemark.sources.resumable import Store, gap_free, generate


def least_node(nodes, edges):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a in parent and b in parent:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("kind", ["random", "chain", "star"])
def test_components(spark, kind):
    r = random.Random(2)
    nodes = list(range(90))
    r.shuffle(nodes)
    edges = {"random": [(r.choice(nodes), r.choice(nodes)) for _ in range(50)], "chain": list(zip(nodes[:60], nodes[1:61], strict=True)), "star": [(nodes[0], n) for n in nodes[1:40]]}[kind]
    edges += [(5, 1000), (7, 7)]
    got = components(spark.createDataFrame(edges, "a int, b int"), spark.createDataFrame([(n,) for n in [*nodes, None]], "node int"))
    assert {x.node: x.cluster for x in got.collect()} == least_node(nodes, edges)


def test_clusters_have_medoids(spark):
    r = random.Random(4)
    names = [f"s{k:02d}" for k in range(14)]
    rs = {(a, b): r.choice([None, r.uniform(-1, 1), r.uniform(0.3, 1)]) for i, a in enumerate(names) for b in names[i + 1 :]}
    got = {x.series_id: x for x in series_clusters(spark.createDataFrame([(a, b, v) for (a, b), v in rs.items()], "a string, b string, raw_r double"), threshold=0.8).collect()}
    own = least_node(names, [p for p, v in rs.items() if v is not None and v >= 0.8])
    far = {n: round(sum(1 - (v or 0.0) for p, v in rs.items() if n in p and own[p[0]] == own[p[1]]), 9) for n in names}
    for n in names:
        members = [m for m in names if own[m] == own[n]]
        assert (got[n].cluster, got[n].size, got[n].medoid) == (own[n], len(members), min(members, key=lambda m: (far[m], m)))
        assert got[n].mean_distance == pytest.approx(far[n] / max(1, len(members) - 1), abs=1e-6)
    told = global_or_local(series_clusters(spark.createDataFrame([("a", "b", 0.9), ("a", "c", 0.1), ("b", "c", 0.2)], "a string, b string, raw_r double"))).first()
    assert (told.clusters, told.series, told.advice) == (2, 3, "by_cluster")


def plain_profile(v, m):
    n = len(v) - m + 1
    windows = [v[i : i + m] for i in range(n)]
    z = [(w - w.mean()) / w.std() if w.std() > 1e-8 else None for w in windows]
    out = []
    for i in range(n):
        others = []
        for j in range(n):
            if abs(i - j) >= max(1, m // 2):
                others.append(0.0 if z[i] is None and z[j] is None else np.sqrt(m) if z[i] is None or z[j] is None else np.sqrt(((z[i] - z[j]) ** 2).sum()))
        out.append(min(others) if others else None)
    return out


def test_profiles_equal_all_pairs(spark):
    rng = np.random.default_rng(1)
    base = {"noise": rng.normal(size=90), "wave": np.sin(np.arange(90) / 3) + 0.05 * rng.normal(size=90), "flat": np.concatenate([np.zeros(30), rng.normal(size=30), np.zeros(30)]), "short": np.arange(9.0)}
    base["wave"][40:46] += 3
    rows = [(s, t, float(x)) for s, v in base.items() for t, x in enumerate(v)]
    profile = matrix_profile(spark.createDataFrame(rows, "series_id string, t int, value double"), 8, diagonals=17).cache()
    got = {}
    for r in profile.collect():
        got.setdefault(r.series_id, {})[r.place] = r
    assert set(got) == {"noise", "wave", "flat"}
    for s in got:
        want = plain_profile(base[s], 8)
        assert [got[s][i].distance for i in range(len(want))] == pytest.approx(want, abs=2e-5)
        assert all(abs(r.place - r.nearest) >= 4 for r in got[s].values())
    told = {r.series_id: r for r in motifs_and_discords(profile).collect()}
    assert 33 <= told["wave"].discord <= 46
    profile.unpersist()


def made(rows):
    return rows.select("name", (F.col("size") * 2).alias("double"), (F.col("size") != 13).alias("passed"))


def specs(spark, rows):
    return spark.createDataFrame(rows, "name string, nth long, size int, note string")


def test_only_what_changed_is_made_again(spark, tmp_path):
    store, seen = Store(spark, f"file://{tmp_path}/out"), []

    def make(rows):
        seen.append(sorted(r.name for r in rows.collect()))
        return made(rows)

    run = lambda rows, g="v1": {r.id: r.reason for r in generate(specs(spark, rows), make, store, g, id="name", place="nth", volatile=["note"], block=2).collect()}
    first = [("a", 0, 1, "x"), ("b", 1, 13, "x"), ("c", 2, 3, None)]
    assert run(first) == {"a": "new", "b": "new", "c": "new"}
    assert seen == [["a", "b"], ["c"]]
    seen.clear()
    assert run([("a", 0, 1, "y"), ("b", 1, 13, "x"), ("c", 2, 4, None), ("d", 3, 9, "x")]) == {"a": None, "b": "failed", "c": "changed", "d": "new"}
    assert seen == [["b"], ["c", "d"]]
    assert sorted((r.id, r.double) for r in store.read().collect()) == [("a", 2), ("b", 26), ("c", 8), ("d", 18)]
    assert set(run([("a", 0, 1, "y")], "v2").values()) == {"generator"}
    assert [(r.id, r.double) for r in store.read().collect()] == [("a", 2)]


def test_a_failed_run_keeps_the_prefix_and_the_next_makes_the_rest(spark, tmp_path):
    store, seen = Store(spark, f"file://{tmp_path}/out"), []

    def make(rows, fails=True):
        names = sorted(r.name for r in rows.collect())
        if fails and "c" in names:
            raise RuntimeError("quality")
        seen.append(names)
        return made(rows)

    rows = specs(spark, [(n, k, k, None) for k, n in enumerate("abcdef")])
    with pytest.raises(RuntimeError, match="quality"):
        generate(rows, make, store, "v", id="name", place="nth", block=2)
    assert sorted(r.id for r in store.read().collect()) == ["a", "b"]
    generate(rows, lambda r: make(r, False), store, "v", id="name", place="nth", block=2)
    assert seen == [["a", "b"], ["c", "d"], ["e", "f"]]
    assert sorted(r.id for r in store.read().collect()) == list("abcdef")


def test_gaps_and_empty_specs(spark, tmp_path):
    rows = spark.createDataFrame([(0,), (1,), (3,)], "place long")
    assert sorted(r.place for r in gap_free(rows).collect()) == [0, 1]
    assert gap_free(rows.where("place > 0")).count() == 0
    store = Store(spark, f"file://{tmp_path}/none")
    assert store.read() is None
    assert generate(specs(spark, []), made, store, "v", id="name", place="nth").count() == 0


@pytest.mark.parametrize("name", ["series_clusters", "global_or_local", "motif_windows", "resumed_panels"])
def test_query_equals_sql(spark, name):
    from oracle import connection, same

    from tidemark.plans.structure_queries import ORACLE_SQL, QUERIES

    sf = "/root/testdata/sf0.01"
    df = QUERIES[name](spark, sf)
    assert df.count() > 0
    same(df, connection(sf), ORACLE_SQL[name])
