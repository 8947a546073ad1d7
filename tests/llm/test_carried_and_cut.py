"""Columns of any name are carried; cuts are the same with any number of automata; pages without an article are empty."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontamination, html_extraction, language_id, near_duplicates, preference
from tidemark.llm.common import words_of
from tidemark.llm.html_extraction import default_model, main_text

NAMES = ("__text", "fed", "fed_", "both", "row", "found", "k1", "k2", "spans", "names", "gone", "__n", "__before", "__last", "n", "before", "last")


def clashing(df):
    return df.withColumns({c: F.concat(F.lit(f"{c} of "), F.col(df.columns[0]).cast("string")) for c in NAMES})


def whole(df, key):
    return {r[key]: tuple(r[c] for c in NAMES) for r in df.collect()}


@pytest.mark.parametrize("shard_words", [20, 200_000])
def test_any_column_is_carried_by_decontaminate(spark, shard_words):
    items = spark.createDataFrame([(k, " ".join(f"i{k}w{j}" for j in range(18))) for k in range(4)], "item_id long, text string")
    docs = clashing(spark.createDataFrame([(1, "a b c"), (2, " ".join(f"i2w{j}" for j in range(18))), (3, None)], "doc_id long, text string"))
    got = decontamination.decontaminate(docs, items, shard_words=shard_words)
    assert whole(got, "doc_id") == whole(docs, "doc_id")
    assert {r.doc_id: r.n_hit for r in got.collect()} == {1: 0, 2: 18, 3: 0}


def test_any_column_is_carried_by_identify_and_extract(spark):
    docs = clashing(spark.createDataFrame([(k, "the cat sat" if k % 2 else "die katze sass", "en" if k % 2 else "de") for k in range(40)], "doc_id long, text string, lang string"))
    found = language_id.identify(docs, language_id.fit(docs))
    assert whole(found, "doc_id") == whole(docs, "doc_id")
    pages = clashing(spark.createDataFrame([(1, "u", "<article><p>Some words stand here, as they do.</p></article>"), (2, "u", None)], "page_id long, url string, html string"))
    assert whole(html_extraction.extract(pages), "page_id") == whole(pages, "page_id")


def test_any_column_is_carried_by_echoed(spark):
    turns = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "r"), (1, 3, "assistant", "b"), (2, 0, "assistant", "c"), (3, 0, "user", "d")]
    df = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").withColumns({c: F.concat_ws("/", F.lit(c), "conv_id", "turn") for c in NAMES})
    got = preference.echoed(df)
    assert got.columns == df.columns
    rows = {(r.conv_id, r.turn): r for r in got.collect()}
    assert {k: r.text for k, r in rows.items()} == {(1, 0): "q", (1, 1): "a", (1, 2): "r", (1, 3): "r", (2, 0): "", (3, 0): "d"}
    assert all(r[c] == f"{c}/{k[0]}/{k[1]}" for k, r in rows.items() for c in NAMES)


def cut_plainly(words, items, window, longest):
    """Words left when runs of hit words are cut out again and again."""
    grams = {tuple(i[k : k + min(window, len(i))]) for i in items if i for k in range(len(i) - min(window, len(i)) + 1)}
    sizes = {len(g) for g in grams}
    while True:
        hit = set()
        for n in sizes:
            for k in range(len(words) - n + 1):
                if tuple(words[k : k + n]) in grams:
                    hit |= set(range(k, k + n))
        gone, run = set(), []
        for k in range(len(words) + 1):
            if k in hit:
                run.append(k)
            else:
                gone |= set(run) if len(run) >= longest else set()
                run = []
        if not gone:
            return words
        words = [w for k, w in enumerate(words) if k not in gone]


@pytest.mark.parametrize("shard_words", [1, 20, 45, 200_000])
def test_cuts_are_those_of_any_number_of_automata(spark, shard_words):
    r = random.Random(4)
    w, v, u = ([f"{c}{k}" for k in range(16)] for c in "wvu")
    items = [w[:15], v, u, ["s1", "s2", "s3"]] + [[r.choice("abc") for _ in range(r.randint(1, 20))] for _ in range(6)]
    texts = [w[:6] + v + w[6:15], w[:3] + u[:5] + v + u[5:] + w[3:15], ["x", *w[:15], "y"], [], w[:12], [*w[:7], "s1", *v, "s2", "s3", *w[7:15]]]
    texts += [[r.choice("abcd") for _ in range(r.randint(0, 60))] for _ in range(25)]
    table = spark.createDataFrame([(k, " ".join(i)) for k, i in enumerate(items)], "item_id long, text string")
    docs = spark.createDataFrame([(k, ", ".join(t)) for k, t in enumerate([*texts, texts[0]])], "doc_id long, text string")
    measured = decontamination.decontaminate(docs, table, shard_words=shard_words)
    got = {x.doc_id: x.text for x in decontamination.remove_cut_spans(measured).collect()}
    for k, t in enumerate([*texts, texts[0]]):
        want = cut_plainly(t, items, decontamination.WINDOW, decontamination.WINDOW)
        assert [x.decode() for x in words_of(got[k].encode())] == want, (k, t)


@pytest.mark.parametrize(
    "page",
    [
        "",
        '<div class="cookie-notice">We use cookies to improve your experience. Accept all cookies to go on.</div>',
        '<html><body><nav class="menu"><a href="/a">Home</a> <a href="/b">News</a> <a href="/c">About us</a></nav><footer>Copyright 2024</footer></body></html>',
        '<body><form><label>Name</label><input><button>Send</button></form><aside class="sidebar"><a href="/x">Related story</a></aside></body>',
    ],
)
def test_a_page_without_an_article_has_no_text(page):
    assert main_text(page, default_model()) == ""


def test_copies_of_untouched_texts_go(spark):
    words = [f"w{k}" for k in range(60)]
    before = [(1, " ".join(words)), (2, " ".join(words[:58])), (3, "another text of its own words"), (4, " ".join(words[:57])), (None, " ".join(words))]
    now = [(2, " ".join(words[:9])), (3, "another text of its own words"), (4, "w0 w1"), (None, " ".join(words))]
    docs = spark.createDataFrame(now, "doc_id long, text string").withColumn("copy", F.lit("x"))
    got = near_duplicates.drop_near_duplicates(docs, untouched=spark.createDataFrame(before, "doc_id long, text string"))
    assert got.columns == docs.columns
    assert {r.doc_id for r in got.collect()} == {2, 3, None}


def test_the_pipeline_keeps_near_copies_together(spark):
    """Of what op5 finds to be near copies, nine in ten are gone after the line and near stages."""
    import corpus_pipeline

    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    flags = near_duplicates.near_duplicates(docs).collect()
    near = {r.doc_id for r in flags if not r.keep and r.class_id != r.group_id}
    after = corpus_pipeline.drop_near_copies(spark, corpus_pipeline.drop_repeated_lines(spark, docs, sf), sf)
    left = {r.doc_id for r in after.select("doc_id").collect()}
    assert len(near) > 20 and len(near - left) >= 0.9 * len(near)
    exact = {r.doc_id for r in flags if not r.keep and r.class_id == r.group_id}
    assert not exact & left


def test_tally_copies_blocks_only():
    """Counts and sums equal bincount's; the fit's index of four bytes is never copied whole to eight."""
    import tracemalloc

    import numpy as np

    from tidemark.llm.toxicity import _tally

    index = np.random.default_rng(1).integers(0, 50, 4_000_000).astype("int32")
    weight = np.arange(50.0)
    tracemalloc.start()
    counts, sums = _tally(index, 50), _tally(index, 50, lambda part: weight[index[part]])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert counts.tolist() == np.bincount(index).tolist() and np.allclose(sums, np.bincount(index, weight[index]))
    assert peak < 4 * len(index) * 2


def test_components_stop_at_stars_and_leave_no_rounds_behind(spark, monkeypatch):
    """Stars take no round, tangled graphs equal union and find, and only the result stays in the shared folder."""
    from tidemark.llm import components

    names, made = [], components.materialise
    monkeypatch.setattr(components, "materialise", lambda df, name: names.append(name) or made(df, name))
    stars = spark.createDataFrame([(0, k) for k in range(1, 9)] + [(20, 21)], "a long, b long")
    assert {r.node: r.component for r in components.connected_components(stars).collect()} == {k: 0 for k in range(9)} | {20: 20, 21: 20}
    assert names == ["edges", "components"]

    draw = random.Random(5)
    edges = [(draw.randint(0, 400), draw.randint(0, 400)) for _ in range(260)] + [(500 - k, 499 - k) for k in range(60)]
    root = {k: k for e in edges for k in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        root[max(find(a), find(b))] = min(find(a), find(b))
    got = components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    linked = {k for a, b in edges if a != b for k in (a, b)}
    assert sorted((r.node, r.component) for r in got) == sorted((k, find(k)) for k in linked)


def test_near_duplicates_leave_only_flags_in_the_shared_folder(spark):
    import os

    from tidemark.llm.common import checkpoint_root

    folder = checkpoint_root(spark).removeprefix("file://")
    before = set(os.listdir(folder))
    docs = spark.createDataFrame([(k, " ".join(f"w{(k % 4) * 100 + j + (j == k)}" for j in range(60))) for k in range(24)], "doc_id long, text string")
    assert near_duplicates.near_duplicates(docs).count() == 24
    assert [x.split("-")[1] for x in set(os.listdir(folder)) - before] == ["flags"]
