"""The whole rule of line deduplication against plain Python: edits that grow with the line, exact repeats of short lines."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from test_llm_queries import _edits

from tidemark.llm import line_dedup, queries


def _allowed(a, b):
    return max(2, min(len(a), len(b)) * 5 // 100)


def _near(a, b, ca, cb):
    most = _allowed(a, b)
    return abs(len(a) - len(b)) <= most and (ca - cb).total() <= most and (cb - ca).total() <= most and _edits(a, b, most) <= most


def _expected(docs, short):
    first, counts, want = {}, {}, set()
    for k, i, x in sorted((k, i, x) for k, t in docs.items() for i, x in enumerate((t or "").split("\n"))):
        if len(x) < 32 and not (short and any(c.isascii() and c.isalnum() or ord(c) > 127 for c in x)):
            continue
        if x in first:
            want.add((k, i))
            continue
        if len(x) >= 32:
            counts[x] = Counter(x)
            if any(y != x and _near(x, y, counts[x], c) for y, c in counts.items()):
                want.add((k, i))
        first[x] = (k, i)
    return want


def _planted():
    r = random.Random(5)
    letters = "etaoin shrdlu é漢\U0001f600"
    base = ["".join(r.choice(letters) for _ in range(n)) for n in (33, 57, 59, 60, 61, 62, 79, 80, 99, 119, 120, 250, 400, 401, 700, 1500)]
    lines = []
    for b in base:
        lines.append(b)
        for more in (-1, 0, 1):
            most = max(2, len(b) * 5 // 100) + more
            # evenly spaced edits leave the shortest runs
            x = list(b)
            for e in range(most):
                at = (2 * e + 1) * len(b) // (2 * most)
                x[at] = r.choice(["", "z", x[at] + "z"])
            lines.append("".join(x))
    return {k: "\n".join(lines[k::7]) for k in range(7)}


@pytest.mark.parametrize("copies", [1, 30])
def test_edits_grow_with_the_line(spark, copies):
    docs = _planted()
    r = random.Random(7)
    line = docs[0].split("\n")[-1]
    docs |= {100 + k: "".join(c if r.random() > 0.03 else "q" for c in line) for k in range(copies)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {(x.doc_id, i) for x in line_dedup.line_report(df, percent=5).collect() for i in x.removed}
    want = _expected(docs, short=False)
    assert got == want
    assert got > {(x.doc_id, i) for x in line_dedup.line_report(df).collect() for i in x.removed}


def test_one_word_changed_in_a_long_passage(spark):
    words = [f"word{k}" for k in range(60)]
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join([*words[:30], "another", *words[31:]]))], "doc_id long, text string")
    assert [x.n_near for x in line_dedup.line_report(df, percent=5).orderBy("doc_id").collect()] == [0, 1]


def test_whole_query_against_all_lines(spark):
    sf = "/root/testdata/sf0.001"
    docs = {x.doc_id: x.text for x in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {(x.doc_id, i) for x in queries.op9_line_dedup_whole(spark, sf).collect() for i in x.removed}
    assert got == _expected(docs, short=True)


def test_short_lines_go_if_repeated_exactly(spark):
    df = spark.createDataFrame([(1, "All rights reserved.\n---\n\n漢字漢字\nAll rights deserved."), (2, "---\n漢字漢字\n\nAll rights reserved.\nnew")], "doc_id long, text string")
    got = {x.doc_id: (x.n_exact, x.n_near, x.removed) for x in line_dedup.line_report(df, short=True).collect()}
    assert got == {1: (0, 0, []), 2: (2, 0, [1, 3])}
