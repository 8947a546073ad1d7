"""Exact quantiles and counts of earlier rows against numpy and plain loops; classes of equal lines."""

from __future__ import annotations

import random
from difflib import SequenceMatcher

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators.quantiles import earlier_rows, exact_quantiles

SHARES = [0.0, 0.1, 0.5, 0.72, 0.9, 0.99, 1.0]


@pytest.mark.parametrize("buckets", [2, 16, 256])
def test_quantiles_equal_numpy(spark, buckets):
    r = random.Random(7)
    rows = [(r.choice("aaab"), r.choice([1.0, 1.0, 1.0, r.gauss(0, 5), round(r.gauss(0, 2)) * 1.0])) for _ in range(3000)] + [("c", 4.0), ("d", None), (None, 2.0), (None, 3.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {x.g: x for x in exact_quantiles(df, ["g"], F.col("v"), SHARES, buckets).collect()}
    assert set(got) == {"a", "b", "c", None}
    for g in got:
        want = np.quantile([v for k, v in rows if k == g and v is not None], SHARES)
        assert [got[g][f"q{i}"] for i in range(len(SHARES))] == pytest.approx(list(want))
    whole = exact_quantiles(df, [], F.col("v"), SHARES, buckets).collect()
    assert list(whole[0]) == pytest.approx(list(np.quantile([v for _, v in rows if v is not None], SHARES)))
    assert exact_quantiles(df.limit(0), [], F.col("v"), [0.5]).collect() == []


def test_earlier_rows(spark):
    r = random.Random(3)
    rows = [(k, r.choice(["hot", "hot", "x", None])) for k in r.sample(range(10_000), 500)]
    got = {x.k: x.earlier for x in earlier_rows(spark.createDataFrame(rows, "k int, g string"), "k", "g").collect()}
    seen = {}
    for k, g in sorted(rows):
        assert got[k] == seen.get(g, 0)
        seen[g] = seen.get(g, 0) + 1


def test_classes_of_lines_and_their_links(spark, sf):
    from tidemark.plans.kernel_queries import QUERIES

    firsts = {r.doc_id: r.text.split("\n")[0] for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if r.text}
    firsts = {k: t for k, t in firsts.items() if len(t) >= 20}
    least = {}
    for k in sorted(firsts):
        least.setdefault(firsts[k], k)
    links = dict.fromkeys(least.values(), 0)
    for a in least:
        for b in least:
            if least[a] < least[b] and 2 * min(len(a), len(b)) > 0.93 * (len(a) + len(b)):
                m = SequenceMatcher(None, b, a)
                if m.quick_ratio() > 0.93 and m.ratio() > 0.93:
                    links[least[a]] += 1
                    links[least[b]] += 1
    got = {r.doc_id: (r["class"], r.links) for r in QUERIES["question_near_duplicates"](spark, sf).collect()}
    assert got == {k: (least[t], links[least[t]]) for k, t in firsts.items()}
    assert len(least) < len(firsts)


def test_quantiles_write_the_rows_once(spark, monkeypatch):
    """Beside the values themselves only tables of a few rows are written; ties, groups and far ranks are exact."""
    from tidemark.operators import quantiles

    sizes, put = {}, quantiles.written

    def written(df, name):
        table = put(df, name)
        sizes[name] = table.count()
        return table

    monkeypatch.setattr(quantiles, "written", written)
    rows = spark.range(20_000).select((F.col("id") % 3).alias("g"), F.when(F.col("id") % 5 < 3, F.lit(7.25)).otherwise(F.pmod(F.hash("id"), F.lit(1_000_003)) / 64).alias("v"))
    shares = [0.0, 0.1, 0.5, 0.72, 1.0]
    got = {r.g: [r[f"q{k}"] for k in range(5)] for r in quantiles.exact_quantiles(rows, ["g"], F.col("v"), shares).collect()}
    values = rows.toPandas()
    for g, v in values.groupby("g").v:
        assert np.allclose(got[g], np.quantile(v, shares), rtol=0, atol=1e-9)
    assert sizes.pop("values") == 20_000 and all(n <= 3 * 10 for n in sizes.values())
