"""Injected events and bundles: queries against their SQL, and small runs."""

from __future__ import annotations

import json

import pytest
from oracle import connection, same
from pyspark.sql import functions as F

from tidemark.operators import injections as ij
from tidemark.plans.injection_queries import ORACLE_SQL, QUERIES
from tidemark.sources import bundles as bu


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    df = QUERIES[name](spark, sf)
    assert not df.isEmpty()
    same(df, connection(sf), ORACLE_SQL[name])


def test_events_are_where_the_truth_says(spark):
    rows = [(k, t, 0.0) for k in ("a", "b", "c") for t in range(100)] + [("short", t, 1.0) for t in range(5)] + [("holes", t, None) for t in range(20)]
    panel = spark.createDataFrame(rows, "series_id string, t int, value double")
    kinds = spark.createDataFrame([("a", "controlled"), ("b", "compositional"), ("c", "confounded"), ("holes", "confounded"), ("none", "controlled")], "series_id string, complexity string")
    points, truth = ij.inject_events(panel, kinds)
    plan = {r.series_id: r for r in truth.collect()}
    got = {}
    for r in points.orderBy("t").collect():
        got.setdefault(r.series_id, []).append(r)
    assert set(plan) == set(got) == {"a", "b", "c", "short", "holes"}
    assert [r.value for r in got["short"]] == [1.0] * 5 and plan["short"].change is None
    assert all(r.value is None for r in got["holes"]) and plan["holes"].contextual is None
    a = plan["a"]
    assert 50 <= a.change < 70 and 7 <= abs(a.shift) <= 16 and a.spread is None and a.cluster is None
    assert a.spike_1 != a.spike_2 and 12 <= min(a.spike_1, a.spike_2) and max(a.spike_1, a.spike_2) < 88
    sizes = {a.spike_1: a.size_1, a.spike_2: a.size_2}
    assert [r.value for r in got["a"]] == [(a.shift if i >= a.change else 0.0) + sizes.get(i, 0.0) for i in range(100)]
    b = plan["b"]
    assert b.spread and b.cluster_end - b.cluster == 3 and [i for i, r in enumerate(got["b"]) if "cluster" in r.kinds] == list(range(b.cluster, b.cluster_end))
    c = plan["c"]
    before = [(c.shift if i >= c.change else 0.0) + {c.spike_1: c.size_1, c.spike_2: c.size_2}.get(i, 0.0) + (c.cluster_size if c.cluster <= i < c.cluster_end else 0.0) for i in range(100)]
    assert before[c.contextual] == pytest.approx(max(before[:80])) and got["c"][c.contextual].value == pytest.approx(before[c.contextual] * c.context)
    assert ij.inject_events(panel.limit(0), kinds)[0].collect() == []


def test_cases_as_rows(spark, tmp_path):
    root = tmp_path / "cases"
    for name, files in {"case_1": {"metadata.json": '{"a": 1}', "generation_config.json": "{}", "basic_statistics.json": "[]", "data_dictionary.md": "long text", "img/x.png": "p"}, "case_2": {"metadata.json": "broken", "data.csv": "d"}, "case_3": {"data.csv": "d"}, "other": {"metadata.json": "{}"}}.items():
        for file, text in files.items():
            (root / name / file).parent.mkdir(parents=True, exist_ok=True)
            (root / name / file).write_text(text)
    got = {r.case: r for r in bu.read_cases(spark, str(root), ["img/x.png", "data.csv"], excerpt=4).collect()}
    assert set(got) == {"case_1", "case_2", "case_3"}
    assert (got["case_1"].metadata, got["case_1"].dictionary_excerpt, got["case_1"].files, got["case_1"].missing) == ('{"a":1}', "long", ["img/x.png"], [])
    assert got["case_2"].missing == list(bu.REQUIRED) == got["case_3"].missing and got["case_3"].files == ["data.csv"]
    assert [r.case for r in bu.read_cases(spark, str(root), most=1).collect()] == ["case_1"]


def test_bundles_both_ways(spark, tmp_path):
    tools = spark.createDataFrame([("t1", "stats", "f1", None, "S", "tells"), (None, None, "f2", "p2", "", None), (None, "x", None, None, None, None)], "tool_name string, category string, factory_function string, permission_name string, schema_name string, description string")
    tools = tools.withColumns({"source_file": F.lit("a.py"), "start_line": F.lit(3), "handler_function": F.lit("h"), "implementation_source": F.lit("def f(): pass")})
    sources = spark.createDataFrame([("m.py", "x = 1")], "path string, source_code string")
    bu.write_bundle(str(tmp_path / "b.jsonl"), "jsonl", tools, sources, sources.limit(0))
    read = {r.name: r for r in bu.read_tools(spark, str(tmp_path / "b.jsonl"), "see", "use {category}").collect()}
    assert {k: (r.type, r.input, r.use_when) for k, r in read.items()} == {"t1": ("stats", "S", "tells"), "f2": ("tool", "see", "use tool")}
    (tmp_path / "one.json").write_text(json.dumps({"tools": [{"name": "n", "category": "c"}, {"name": ""}]}, indent=1))
    assert [(r.name, r.type) for r in bu.read_tools(spark, str(tmp_path / "one.json")).collect()] == [("n", "c")]
    bu.write_bundle(str(tmp_path / "md"), "markdown", tools.where("tool_name = 't1'"), sources, sources)
    text = "\n".join(r.value for r in spark.read.text(str(tmp_path / "md")).collect())
    assert text.count("### `m.py`") == 2 and "- Source: `a.py:3`" in text and "def f(): pass" in text
    with pytest.raises(ValueError, match="xml"):
        bu.write_bundle(str(tmp_path / "x"), "xml", tools, sources, sources)
