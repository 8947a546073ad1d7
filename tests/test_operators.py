"""Operators on small literal tables, empty ones included."""

from __future__ import annotations

import math
import random
from difflib import SequenceMatcher

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.hashing import stable_hash
from tidemark.functions.text import capability, compact, numbers, quality_flags
from tidemark.operators import diagnostics, kernels, panel, planning, review
from tidemark.operators.text_similarity import similar_texts
from tidemark.plans.registry import TOOLS, run_tool
from tidemark.sources import records

PANEL = "series_id string, t int, value double"


def grid(spark, rows):
    return spark.createDataFrame(rows, PANEL)


def test_duplicates_survive_the_wide_form(spark):
    rows = [("a", 1, 1.0), ("a", 1, 2.0), ("b", 1, 3.0), ("b", 1, 4.0), ("a", 2, 5.0), ("b", 2, 6.0)]
    wide = panel.to_wide(grid(spark, rows), ["t", "value"])
    assert wide.columns == ["t", "occ", "s01", "s02"]
    assert sorted(map(tuple, wide.collect())) == [(1, 0, 1.0, 3.0), (1, 1, 2.0, 4.0), (2, 0, 5.0, 6.0)]
    assert panel.to_long(wide).count() == len(rows)


def test_interpolation_by_line_and_level(spark):
    rows = [("a", 0, None), ("a", 1, 1.0), ("a", 2, None), ("a", 3, 3.0), ("a", 4, None), ("b", 0, None)]
    got = {(r.series_id, r.t): r.value for r in panel.interpolated(grid(spark, rows)).collect()}
    assert [got["a", k] for k in range(5)] == [1.0, 1.0, 2.0, 3.0, 3.0]
    assert got["b", 0] is None


def test_change_point_at_the_step(spark):
    rows = [("a", k, float(k >= 30)) for k in range(60)]
    found = diagnostics.change_point(grid(spark, rows)).collect()
    assert [(r.series_id, r.t) for r in found] == [("a", 30)]
    assert diagnostics.change_point(grid(spark, [("a", k, 1.0) for k in range(60)])).collect() == []


def test_period_of_a_sine(spark):
    rows = [("a", k, math.sin(2 * math.pi * k / 12)) for k in range(120)] + [("b", k, 1.0) for k in range(120)]
    got = {r.series_id: r.period for r in kernels.estimate_period(grid(spark, rows)).collect()}
    assert got == {"a": 12, "b": None}


def test_parts_of_a_decomposition_add_up(spark):
    r = random.Random(1)
    rows = [("a", k, k / 10 + math.sin(k) + r.random()) for k in range(80)]
    for x in kernels.decompose(grid(spark, rows), 7).collect():
        assert abs(x.trend + x.season + x.rest - rows[x.t][2]) < 1e-9


@settings(max_examples=30, deadline=None)
@given(st.lists(st.floats(-5, 5), min_size=1, max_size=12), st.lists(st.floats(-5, 5), min_size=1, max_size=12))
def test_warping_against_the_plain_recursion(a, b):
    d = np.full((len(a) + 1, len(b) + 1), np.inf)
    d[0, 0] = 0
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            d[i, j] = abs(x - y) + min(d[i - 1, j], d[i, j - 1], d[i - 1, j - 1])
    assert abs(kernels.dtw(np.array(a), np.array(b), 99) - d[-1, -1]) < 1e-9


def test_quotas_are_whole_and_sum(spark):
    levels = [("complex", 0.2), ("medium", 0.6), ("simple", 0.2)]
    rows = spark.range(200).withColumnRenamed("id", "k")
    counts = {r.level: r["count"] for r in planning.spread_levels(rows, "k", levels, "s").groupBy("level").count().collect()}
    assert counts == {"complex": 40, "medium": 120, "simple": 40}
    odd = planning.quotas(spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 1.0)], "level string, weight double"), 10).collect()
    assert sorted((r.level, r.quota) for r in odd) == [("a", 4), ("b", 3), ("c", 3)]


def test_assignment_takes_the_first_that_fits_then_goes_round(spark):
    specs = spark.createDataFrame([("t", "p1", 1, "x"), ("t", "p2", 2, None)], "task string, spec string, ord int, pattern string")
    scenarios = spark.createDataFrame([("t", f"s{k}", k, "x" if k == 2 else "y") for k in range(5)], "task string, scenario string, ord int, pattern string")
    got = {r.scenario: (r.spec, r.turn) for r in planning.assign_in_order(specs, scenarios).collect()}
    assert got["s2"] == ("p1", 1) and got["s0"] == ("p2", 1)
    assert {got[f"s{k}"][0] for k in (1, 3, 4)} == {"p2"}


def test_sample_keeps_k_or_all(spark):
    rows = spark.range(50).select((F.col("id") % 3).alias("g"), F.col("id").alias("k"))
    assert planning.stratified_sample(rows, ["g"], "k", 4, "x").count() == 12
    assert planning.stratified_sample(rows, ["g"], "k", 0, "x").count() == 50


def test_conversation_grammar(spark):
    turns = [
        (1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"),
        (2, 0, "user", "u"), (2, 1, "user", "v"), (2, 2, "system", "s"),
        (3, 0, "user", "u"), (3, 1, "tool", "a"), (3, 2, "assistant", " "),
    ]
    got = {r.conv_id: r for r in review.review_conversations(spark.createDataFrame(turns, "conv_id int, turn int, role string, text string")).collect()}
    assert got[1].flags == "" and got[1].passed
    assert got[2].flags == "misplaced_system,role_order,no_answer,open_end" and not got[2].passed
    assert got[3].flags == "unknown_role,empty_turn" and not got[3].passed


def test_choice_between_candidates(spark):
    rows = [(1, 0, True, 5, 0, 3), (1, 1, True, 5, 0, 2), (2, 0, False, 9, 0, 1), (3, 0, False, 9, 0, 1), (3, 1, True, 1, 4, 1)]
    df = spark.createDataFrame(rows, "g int, index int, passed boolean, score int, failures int, calls int")
    got = {r.g: (r.winner, r.reason) for r in review.choose_candidate(df, "g").collect()}
    assert got == {1: (1, "best_score"), 2: (None, "all_failed"), 3: (1, "only_passed")}


def test_text_rules(spark):
    row = spark.createDataFrame([("In 2024, 3.5% of x12 fell. A) yes", "Detect ANOMALY points", "a  b\n" * 200)], "a string, b string, c string")
    got = row.select(numbers(F.col("a")).alias("n"), capability(F.col("b")).alias("c"), quality_flags(F.col("a")).alias("f"), compact(F.col("c"), 200).alias("s")).first()
    assert got.n == ["2024", "3.5%"]
    assert got.c == "anomaly_detection"
    assert "too_short" in got.f and "has_numbers" in got.f
    assert len(got.s) == 120 + len(" ...[truncated]")


def test_stable_hash_is_that_of_the_json_string(spark):
    import hashlib

    got = spark.range(1).select(stable_hash("a", F.col("id")).alias("h")).first().h
    assert got == hashlib.sha256(b'"a:0"').hexdigest()


def test_similar_texts_against_all_pairs(spark):
    r = random.Random(4)
    base = ["".join(r.choice("abcdefghij ") for _ in range(r.randint(2, 90))) for _ in range(40)]
    texts = base + [t[:k] + r.choice("xyz") + t[k + r.randint(0, 2) :] for t in base for k in [r.randrange(len(t))]]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, x string")
    got = {(r.k_a, r.k_b) for r in similar_texts(df, "k", "x").collect()}
    want = {(i, j) for j in range(len(texts)) for i in range(j) if SequenceMatcher(None, texts[j], texts[i]).ratio() > 0.93}
    assert got == want


def test_record_streams(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('{"id": 1, "v": 1.5}\nnot json\n{"id": 2}\n')
    schema = spark.createDataFrame([], "id long, v double").schema
    good, bad = records.read_lenient(spark, str(path), schema)
    assert [r.id for r in good.collect()] == [1, 2] and bad.count() == 1
    with pytest.raises(Exception):  # noqa: B017
        records.read_strict(spark, str(path), schema).collect()
    records.write_strict(spark.createDataFrame([(1, float("nan")), (2, 1.0)], schema), str(tmp_path / "out"))
    assert sorted((r.id, r.v) for r in spark.read.schema(schema).json(str(tmp_path / "out")).collect()) == [(1, None), (2, 1.0)]
    (tmp_path / "m" / "7").mkdir(parents=True)
    (tmp_path / "m" / "8").mkdir()
    for k, n in (("7", 7), ("8", 9)):
        (tmp_path / "m" / k / "manifest.json").write_text(f'{{"id": "{n}"}}')
    assert [r.id for r in records.read_manifests(spark, str(tmp_path / "m"), "id string", "id").collect()] == ["7"]


def test_contiguous_prefix(spark):
    df = spark.createDataFrame([(1,), (2,), (4,)], "i long")
    assert sorted(r.i for r in records.contiguous_prefix(df, "i").collect()) == [1, 2]


def test_tools_take_an_empty_panel(spark):
    empty = grid(spark, [])
    for name in ("data_profile", "compute_acf", "cpt_detector", "ts_imputation", "pear_cross_correlation", "FFT", "dtw_distance", "find_peaks"):
        assert run_tool(name, empty).count() == 0
    with pytest.raises(KeyError):
        run_tool("nothing", empty)
    assert len(TOOLS) >= 30


def test_csv_with_embedded_json_and_file_hashes(spark, tmp_path):
    import hashlib

    (tmp_path / "qa.csv").write_text('id,qa\n1,"""question"": ""q1"",\n ""answer"": ""[1, 2.5]"""\n2,"{""question"": ""q2"", ""answer"": ""none""}"\n')
    rows = records.read_csv_records(spark, str(tmp_path / "qa.csv"), "id int, qa string")
    pair = records.embedded_pairs(F.col("qa"))
    got = {r.id: (r.q, r.s) for r in rows.select("id", pair["question"].alias("q"), records.first_series(F.concat(pair["answer"], F.lit(" [1, 2, 3, 4]"))).alias("s")).collect()}
    assert got == {1: ("q1", [1.0, 2.5]), 2: ("q2", [1.0, 2.0, 3.0, 4.0])}
    there = tmp_path / "files"
    there.mkdir()
    (there / "a.bin").write_bytes(b"abc")
    (there / "b.bin").write_bytes(b"changed")
    want = spark.createDataFrame([("a.bin", hashlib.sha256(b"abc").hexdigest()), ("b.bin", "0"), ("c.bin", "0")], "name string, sha256 string")
    assert {r.name: (r.exists, r.intact) for r in records.verify_files(want, str(there)).collect()} == {"a.bin": (True, True), "b.bin": (True, False), "c.bin": (False, False)}


def test_judged_choice(spark):
    columns = "g int, index int, total double, mark1 int, mark2 int, mark3 int, mark4 int, mark5 int, failures int, calls int, tokens int"
    rows = [(1, 0, 20.0, None, None, None, None, None, 0, 1, 1), (1, 1, None, 5, 4, 4, 4, 4, 0, 1, 1), (2, 0, None, 5, 5, 5, 5, None, 0, 9, 1), (2, 1, 1.0, 1, 1, 1, 1, 1, 0, 2, 1), (3, 0, 9.0, 1, 1, 1, 1, 1, 1, 2, 1), (3, 1, 9.0, 1, 1, 1, 1, 1, 0, 2, 1)]
    got = {r.g: (r.winner, r.reason) for r in review.judged_choice(spark.createDataFrame(rows, columns), "g").collect()}
    assert got == {1: (1, "judge"), 2: (1, "tie_break"), 3: (1, "judge")}


def test_grid_of_an_empty_panel(spark):
    assert panel.full_grid(grid(spark, [])).count() == 0
    two = panel.full_grid(grid(spark, [("a", 1, 1.0), ("b", 3, 2.0)]))
    assert two.count() == 6 and two.where("value IS NULL").count() == 4


def test_long_keys_do_not_travel_with_grams(spark, monkeypatch):
    """Grams are joined by a text's place: what is exploded carries no key."""
    from tidemark.operators import text_similarity as ts

    df = spark.createDataFrame([("k" * 64 + str(i), "a text of some length, " + "xyz"[i] * 3) for i in range(3)], "k string, x string")
    plan = ts.similar_texts(df, "k", "x", 0.8)._jdf.queryExecution().optimizedPlan().toString()
    made = [line for line in plan.split("\n") if "Generate explode" in line]
    assert made and not any(" k#" in line or "[k#" in line for line in made)
    assert {(r.k_a[-1], r.k_b[-1]) for r in ts.similar_texts(df, "k", "x", 0.8).collect()} == {("0", "1"), ("0", "2"), ("1", "2")}


def test_similar_texts_by_pieces_against_all_pairs(spark):
    """Long, equal, empty and short texts, several ratios, and pairs with a fresh text only."""
    r = random.Random(9)
    base = ["".join(r.choice("abcdefghijklmnop é𝄞") for _ in range(n)) for n in (1, 2, 5, 8, 14, 15, 51, 199, 230, 700, 1400)]

    def changed(t):
        for _ in range(r.randint(1, max(1, len(t) // 12))):
            k = r.randrange(len(t) + 1)
            t = t[:k] + r.choice(["", "x", "yz"]) + t[k + r.randint(0, 2) :]
        return t

    texts = base + [changed(t) for t in base for _ in range(3)] + ["", "", base[7]]
    df = spark.createDataFrame([(i, t, i % 3 == 0) for i, t in enumerate(texts)], "k int, x string, new boolean")
    for ratio in (0.93, 0.6):
        want = {(i, j) for j in range(len(texts)) for i in range(j) if round(SequenceMatcher(None, texts[j], texts[i]).ratio(), 6) > ratio}
        assert {(p.k_a, p.k_b) for p in similar_texts(df, "k", "x", ratio).collect()} == want
        assert {(p.k_a, p.k_b) for p in similar_texts(df, "k", "x", ratio, fresh="new").collect()} == {(i, j) for i, j in want if i % 3 == 0 or j % 3 == 0}


def test_similar_texts_post_few_pieces(spark):
    """A text posts as many pieces as characters can be unmatched, plus one, for two classes of length; it used to post half of its grams."""
    from tidemark.operators import text_similarity as ts

    r = random.Random(2)
    texts = spark.createDataFrame([(k, "".join(r.choice("abcdefgh") for _ in range(1000))) for k in range(5)], "id long, x string")
    assert ts._posted(texts, 0.93, True, "a").count() <= 5 * 2 * 141
    assert ts._posted(texts, 0.93, False, "b").count() <= 5 * 1000
