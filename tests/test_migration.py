"""Migrated panels: queries against their SQL, and small runs."""

from __future__ import annotations

import json

import pytest
from oracle import connection, same

from tidemark.operators import migration as mg
from tidemark.plans.migration_queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    df = QUERIES[name](spark, sf)
    assert not df.isEmpty()
    same(df, connection(sf), ORACLE_SQL[name])


def test_records_and_report(spark):
    panels = spark.createDataFrame([("a", 0, "x", 1.0), ("a", 0, "x", 1.0), ("a", 0, "y", None), ("a", 1, "y", 2.0), ("b", 0, None, 1.0), ("c", 0, "x", 1.0)], "id string, time int, series_id string, value double")
    wide = mg.wide_rows(panels)
    assert sorted((r.id, r.time, r.occurrence, dict(r["values"])) for r in wide.collect()) == [("a", 0, 0, {"s01": 1.0, "s02": None}), ("a", 0, 1, {"s01": 1.0}), ("a", 1, 0, {"s02": 2.0}), ("c", 0, 0, {"s01": 1.0})]
    truth = '{"b": 1, "a": "ü", "generator": {"version": "1", "seed": 3}}'
    scenarios = spark.createDataFrame([("a", "1", "h", truth), ("b", "1", "h", truth), ("c", "1", None, "[1]"), ("d", None, "h", None)], "id string, version string, scenario_hash string, truth string")
    made = mg.migrated(scenarios, panels, wide, "2")
    got = {r.id: r for r in made.collect()}
    assert (got["a"].source_rows, got["a"].source_duplicates, got["a"].wide_rows, got["a"].wide_duplicate_times, got["a"].flags) == (4, 1, 3, 1, [])
    assert json.loads(got["a"].truth) == {"b": 1, "a": "ü", "generator": {"version": "2", "seed": 3, "migration": {"source_generator_version": "1", "source_scenario_hash": "h"}}}
    assert got["b"].flags == ["rows_lost", "no_rows"] and got["c"].flags == ["truth_changed"] and got["d"].flags == ["truth_changed", "no_rows"]
    report = mg.migration_report(made).first()
    assert (report.records, report.passed, report.semantic_truth_preserved, report.points_preserved) == (4, 1, False, False)
    bare = spark.createDataFrame([("c", "1", "h", '{"a": 1}')], "id string, version string, scenario_hash string, truth string")
    assert mg.migrated(bare, panels, wide, "2").first().flags == []
    again = mg.migrated(scenarios, panels, wide, "2", made)
    assert {r.id for r in again.collect()} == {"b", "c", "d"}
    assert mg.migration_report(made.limit(0)).first().records == 0
