"""Each stage of the pipeline against plain Python on its own input."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from test_llm_queries import _edits

import corpus_pipeline
from tidemark.llm import toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output rows of each stage."""
    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, SF).write.parquet(path)
        out = spark.read.parquet(path)
        seen[name] = (docs.collect(), out.collect())
        docs = out
    return seen


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def test_toxicity(spark, stages):
    before, after = stages["toxicity"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    eta = {r.doc_id: sum(model.weights.get(f, 0.0) for f in {f for w in set(words((r.text or "").lower())) for f in toxicity.features_of(w.encode())}) for r in before}
    assert {r.doc_id for r in after} == {k for k, e in eta.items() if model.tail([e])[0, 0] < 0.5}
    assert all(r in before for r in after)


def test_line_dedup(stages):
    before, after = stages["line_dedup"]
    lines = {r.doc_id: r.text.split("\n") for r in before}
    size = {r.doc_id: len(r.text) for r in before}
    taken = lambda x: len(x) >= 32 or bool(words(x))
    first, near = {}, set()
    for k in sorted(lines):
        for i, x in enumerate(lines[k]):
            if taken(x) and x not in first:
                if len(x) >= 32 and any(len(y) >= 32 and abs(len(x) - len(y)) <= 2 and _edits(x, y, 2) <= 2 for y in first):
                    near.add(x)
                first[x] = (k, i)
    bag = lambda k: {tuple(w[i : i + 5]) for w in [words("\n".join(lines[k]))] for i in range(max(1, len(w) - 4))}
    group = {}
    for k in lines:
        owned = Counter()
        for i, x in enumerate(lines[k]):
            if taken(x) and first[x][0] != k:
                owned[first[x][0]] += len(x)
        group[k] = k
        if owned:
            o, n = owned.most_common(1)[0]
            if n >= 0.15 * size[k] and min(size[k], size[o]) >= 0.8 * max(size[k], size[o]):
                a, b = bag(k), bag(o)
                if len(a & b) >= 0.8 * len(a | b):
                    group[k] = o
    assert any(group[k] != k for k in lines)
    out = {}
    for k in lines:
        kept, seen = [], set()
        for x in lines[k]:
            if taken(x):
                o = first[x][0]
                if x in seen or group[o] != group[k] or x in near and group[o] == o:
                    seen.add(x)
                    continue
                seen.add(x)
            kept.append(x)
        text = "\n".join(kept)
        if words(text) or len(kept) == len(lines[k]):
            out[k] = text
    assert {r.doc_id: r.text for r in after} == out
    assert all(r.n_chars == len(r.text) for r in after if r.text != next(x.text for x in before if x.doc_id == r.doc_id))


def firsts(texts):
    """The least id of each group of near-duplicates."""
    bags = {}
    for k, text in texts.items():
        w = words(text)
        bags[k] = Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()
    parent = {k: k for k in bags}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in bags:
        for b in bags:
            common = (bags[a] & bags[b]).total() if a < b else 0
            if common and common >= 0.8 * (bags[a].total() + bags[b].total() - common) - 1e-9:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {k for k in bags if root(k) == k}


def test_near_dedup(spark, stages):
    """One document of each group goes on: of groups in the stage's own input, and in the same documents' untouched texts."""
    before, after = stages["near_dedup"]
    own = {r.doc_id: r.text for r in before}
    untouched = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if r.doc_id in own}
    assert {r.doc_id for r in after} == firsts(own) & firsts(untouched)


def test_decontamination(spark, stages):
    before, after = stages["decontamination"]
    windows: dict[int, set] = {}
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words(r.text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(n, set()).add(tuple(w[i : i + n]))

    def hits(w):
        return {p for n, known in windows.items() for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in known for p in range(i, i + n)}

    kept = {}
    for r in before:
        w = words(r.text)
        hit = hits(w)
        if not hit or 20 * len(hit) < len(w):
            kept[r.doc_id] = (w, hit)
    assert {r.doc_id for r in after} == set(kept) and len(kept) < len(before)
    for r in after:
        w, hit = kept[r.doc_id]
        runs = "".join("x" if p in hit else " " for p in range(len(w)))
        gone = {p for m in re.finditer("x{13,}", runs) for p in range(*m.span())}
        if not gone:
            assert r.text == next(x.text for x in before if x.doc_id == r.doc_id)
        else:
            assert words(r.text) == [x for p, x in enumerate(w) if p not in gone] or len(words(r.text)) < len(w) - len(gone)
            assert r.n_chars == len(r.text)
        if hit:
            left = hits(words(r.text))
            assert "x" * 13 not in "".join("x" if p in left else " " for p in range(len(words(r.text))))


def test_packing(stages):
    before, after = stages["packing"]
    assert {r.doc_id for r in after} == {r.doc_id for r in before}
    used = Counter()
    for r in after:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 2048 and len({(r.sequence_id, r.offset) for r in after}) == len(after)
