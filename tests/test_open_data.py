"""Open question sets and evidence packets: queries against their SQL, and small runs."""

from __future__ import annotations

import hashlib

import pytest
from oracle import connection, same

from tidemark.plans.open_data_queries import ORACLE_SQL, QUERIES
from tidemark.sources import open_data as od

LINES = "path string, row_index int, problem string, answer string, extracted_answer string, question_type string, timeseries array<array<double>>"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    df = QUERIES[name](spark, sf)
    assert not df.isEmpty()
    same(df, connection(sf), ORACLE_SQL[name])


def test_records_of_a_question_set(spark):
    rows = [
        ("f", 0, " Forecast the load ", "<think>x</think> 5", "", None, [[1.0] * 2000] * 20), ("f", 1, "nothing known", "a", None, "", None), ("f", 2, "is it an outlier?", "long", "short", "Trend", [[1.0], []]),
        ("f", 3, " ", "a", None, "forecast", None), ("f", 4, None, None, None, None, None), ("f", 0, " Forecast the load ", None, None, None, None),
    ]
    made = od.raw_records(od.reasoned_rows(spark.createDataFrame(rows, LINES)), "set")
    got = sorted(made.collect(), key=lambda r: (r.source_row_index, r.answer))
    assert [(r.source_row_index, r.normalized_capability, r.answer) for r in got] == [(0, "forecasting", ""), (0, "forecasting", "<think>x</think> 5"), (2, "trend", "short")]
    assert got[0].id == got[1].id == "openq_" + hashlib.sha1(b"set::f::0::Forecast the load").hexdigest()[:16]
    assert got[1].timeseries_summary.num_series == 12 and got[1].timeseries_summary.max_length == 1024 and got[1].metadata.has_cot and not got[0].metadata.has_cot
    assert got[0].timeseries == [] and got[0].timeseries_summary.max_length == 0 and got[2].reuse_strategy == "discard"
    assert [r.source_row_index for r in od.raw_records(od.reasoned_rows(spark.createDataFrame(rows, LINES)), "set", ["trend"]).collect()] == [2]
    assert od.raw_records(od.reasoned_rows(spark.createDataFrame([], LINES)), "set").collect() == []


def test_a_packet_holds_only_what_is_visible(spark):
    ddl = "id int, columns array<string>, data_layout string, wide_column_map map<string,string>, row_count int, series_count int, history_length_per_series int, frequency string, first_time long, last_time long, summary string, business_constraints string, hierarchy string, truth string"
    made = od.evidence_packets(spark.createDataFrame([(1, ["a"], "wide", None, 3, 1, 3, "D", 1, None, "s", None, "h", "secret")], ddl), "id")
    e = made.first().evidence.asDict(True)
    assert e["schema"] == {"columns": ["a"]} and e["time_index"] == {"frequency": "D", "observed_range": None} and e["hierarchy"] == "h"
    assert "secret" not in str(e) and "target_zero_ratio" not in e
