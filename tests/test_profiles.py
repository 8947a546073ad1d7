"""Gates, merges and tools on small tables: nulls, empty tables, files written."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tidemark.operators import curation, profiles
from tidemark.plans import registry


def test_findings_are_asserted_without_doubt(spark):
    df = spark.createDataFrame([(1, "数据存在缺失。请判断序列是否存在异常，模型过拟合！"), (2, None), (3, ""), (4, "天气很好。")], "k int, text string")
    got = {r.k: r.f for r in df.select("k", curation.finding_assertions(F.col("text")).alias("f")).collect()}
    assert got == {1: ["数据存在缺失", "模型过拟合"], 2: [], 3: [], 4: []}


def test_version_gate(spark):
    rows = spark.createDataFrame([(k, "v2" if k > 4 else "v1" if k else None) for k in range(9)], "id int, version string")
    with pytest.raises(ValueError, match="5 rows aren't of version v2: 0, 1, 2"):
        curation.require_version(rows, "id", "version", "v2")
    assert curation.require_version(rows.where("id > 4"), "id", "version", "v2").count() == 4
    assert curation.stale_rows(rows.limit(0), "id", "version", "v2").first().n_stale == 0


def test_rows_go_to_two_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, 0.9), (2, 0.1), (3, None)], "id int, score double")
    curation.route(rows, F.col("score") > 0.5, str(tmp_path / "out"))
    read = lambda p: sorted(r.id for r in spark.read.parquet(str(tmp_path / "out" / f"passed={p}")).collect())
    assert (read("true"), read("false")) == ([1], [2, 3])


def test_repairs_come_after_the_limit(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1), ("d", 0), ("d", 1), ("e", None)], "g string, ok int")
    got = sorted((r.g, r.repair) for r in curation.limited_with_repairs(rows, "g", F.col("ok") == 0, 2).collect())
    assert got == [("a", False), ("b", False), ("d", True), ("d", True)]


def test_merging_prefers_the_first_source(spark):
    a, b = spark.createDataFrame([("x", 1), ("y", 2)], "name string, p int"), spark.createDataFrame([("y", 9), ("z", 8)], "name string, q int")
    got = sorted((r.name, r.p, r.q) for r in curation.merged_catalogue([a, b], "name").collect())
    assert got == [("x", 1, None), ("y", 2, None), ("z", None, 8)]


def test_chi_square_tail(spark):
    got = spark.range(1).select(profiles.portmanteau_p(F.lit(18.307)).alias("p")).first().p
    assert math.isclose(got, 0.05, rel_tol=1e-3)
    with pytest.raises(ValueError):
        profiles.portmanteau_p(F.lit(1.0), 9)


def test_tools_scan_report_and_register(spark, tmp_path):
    grid = spark.createDataFrame([("s", t, None if t == 3 else float(t % 5)) for t in range(60)], "series_id string, t int, value double")
    assert registry.run_tool("data_scan", grid, limit=7).count() == 7
    rows = {r.name: r for r in registry.run_tool("data_profile", grid).collect()}
    assert (rows["value"].nulls, rows["t"].least, rows["t"].greatest, rows["series_id"].type) == (1, "0", "59", "string")
    one = registry.run_tool("report_export", grid, path=str(tmp_path / "report")).first()
    assert one.rows == 60 and spark.read.json(str(tmp_path / "report")).count() == 60
    for k in range(2):
        registry.run_tool("register_artifact", grid, path=f"p{k}", registry=str(tmp_path / "artifacts"))
    assert sorted(r.path for r in spark.read.parquet(str(tmp_path / "artifacts")).collect()) == ["p0", "p1"]
    assert registry.run_tool("ts_imputation", grid, method="forward").first().forward == 2.0
    assert registry.run_tool("cpt_detector", grid, of="variance").count() == 1
    assert registry.run_tool("summary_stats", grid).first().median == 2.0
