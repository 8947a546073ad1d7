"""The registered queries over the small tables: SQL where there is some, brute force and held-out labels elsewhere."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest
from oracle import connection, same

from tidemark.llm import queries
from tidemark.llm.common import words_of

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    same(queries.QUERIES[name](spark, SF), connection(SF), queries.ORACLE_SQL[name])


def test_packing_is_whole_gapless_and_tight(spark, documents):
    from tokenizers import Tokenizer

    from tidemark.llm.packing import CAPACITY, tokenizer_path

    rows = queries.op2_best_fit_packing(spark, SF).collect()
    tokenizer = Tokenizer.from_file(tokenizer_path())
    pieces = defaultdict(dict)
    bins = defaultdict(list)
    for r in rows:
        pieces[r.doc_id][r.piece] = r
        bins[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(documents)
    for doc_id, parts in pieces.items():
        ids = [*tokenizer.encode(documents[doc_id].text or "", add_special_tokens=False).ids, 0]
        assert sorted(parts) == list(range(-(-len(ids) // CAPACITY)))
        for k, r in parts.items():
            part = ids[k * CAPACITY : (k + 1) * CAPACITY]
            raw = b"".join(x.to_bytes(4, "little") for x in part)
            assert (r.start, r.length, r.ids_crc32) == (k * CAPACITY, len(part), zlib.crc32(raw))
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= CAPACITY
    least = -(-sum(r.length for r in rows) // CAPACITY)
    assert len(bins) <= least * 1.01 + 1


def test_extraction_of_the_articles(spark):
    import html
    import re

    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r.page_id: r for r in queries.op3_html_extraction(spark, SF).collect()}
    assert set(got) == set(pages)
    for k, p in pages.items():
        inner = re.search(r"<article>(.*?)(?:</article>|$)", p.html, re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n\n".join(b for b in blocks if b)
        assert (got[k].text, got[k].n_chars, got[k].url) == (want, len(want), p.url)


def test_language_on_held_out_documents(spark, documents):
    rows = queries.op4_language_id(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(documents)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == documents[r.doc_id].lang for r in held) >= 0.98 * len(held)


def test_near_duplicate_groups_against_all_pairs(spark, documents):
    bags, shared, parent = {}, defaultdict(set), {}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, r in documents.items():
        w = words_of((r.text or "").encode())
        bags[k] = Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()
        parent[k] = k
        for s in bags[k]:
            shared[s].add(k)
    seen = set()
    for ids in shared.values():
        for a in ids:
            for b in ids:
                if a < b and (a, b) not in seen:
                    seen.add((a, b))
                    common = (bags[a] & bags[b]).total()
                    if common >= 0.8 * (bags[a].total() + bags[b].total() - common) - 1e-9:
                        x, y = root(a), root(b)
                        parent[max(x, y)] = min(x, y)
    got = {r.doc_id: r for r in queries.op5_minhash_near_dedup(spark, SF).collect()}
    assert {k: r.group_id for k, r in got.items()} == {k: root(k) for k in documents}
    assert {k for k, r in got.items() if r.keep} == {k for k in documents if root(k) == k}


def _auc(pairs):
    good, bad = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))


def test_quality_on_held_out_labels(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries.op7_quality_classifier(spark, SF).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert _auc([(r.score, labels[r.doc_id] == 1) for r in rows if r.held_out and r.doc_id in labels]) > 0.95


def test_toxicity_finds_the_labelled(spark, documents):
    from tidemark.llm import toxicity
    from tidemark.llm.common import held_out

    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.fit(docs, labels.where(~held_out()))
    rows = toxicity.score(docs.where(held_out()), model, keep=["doc_id"]).join(labels, "doc_id").collect()
    assert _auc([(r.severity, r.toxic == 1) for r in rows]) > 0.96
    clean = [r for r in rows if r.toxic == 0]
    assert sum(r.rejected for r in clean) <= 0.01 * len(clean)
    assert all(0 <= r.severity <= 3 and 0 <= r.grade <= 3 for r in rows)


def test_line_dedup_against_all_lines(spark, documents):
    lines = sorted((k, i, x) for k, r in documents.items() for i, x in enumerate((r.text or "").split("\n")) if len(x) >= 32 or words_of(x.encode()))
    first, want = {}, set()
    for k, i, x in lines:
        if x in first:
            want.add((k, i))
        else:
            first[x] = (k, i)
    by_length = defaultdict(list)
    long = [x for x in first if len(x) >= 32]
    for x in long:
        by_length[len(x)].append(x)
    near = set()
    for x in long:
        for n in range(len(x) - 2, len(x) + 3):
            for y in by_length.get(n, ()):
                # two edits leave one of three parts of a line in place, up to two steps away
                if first[y] < first[x] and _edits(x, y, 2) <= 2:
                    near.add(x)
    want |= {(k, i) for k, i, x in lines if x in near}
    got = {(r.doc_id, i) for r in queries.op9_line_dedup(spark, SF).collect() for i in r.removed}
    assert got == want


def _edits(a: str, b: str, most: int) -> int:
    """Edit distance, or more than ``most``, by the furthest points reached on each diagonal."""
    n, m = len(a), len(b)

    def slide(i: int, d: int) -> int:
        while i < n and i + d < m and a[i] == b[i + d]:
            i += 1
        return i

    reach = {0: slide(0, 0)}
    for e in range(most + 1):
        if reach.get(m - n, -1) >= n:
            return e
        new = {}
        for d in range(-e - 1, e + 2):
            i = max(reach.get(d, -2) + 1, reach.get(d - 1, -2), reach.get(d + 1, -2) + 1)
            if i >= 0 and i <= n and i + d <= m:
                new[d] = slide(i, d)
        reach = new
    return most + 1
