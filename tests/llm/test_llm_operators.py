"""The training-data operators on small tables: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import components, decontamination, html_extraction, language_id, line_dedup, near_duplicates, packing, preference, quality_classifier, quality_rules, toxicity

DOCS = "doc_id long, text string, lang string, n_words long, __k1 string, digest string, score string"
LONG = "lorem ipsum dolor sit amet " * 20_000


def table(spark, texts):
    return spark.createDataFrame([(i, t, "en", -1, "x", "y", "z") for i, t in texts], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    words = " ".join(f"w{k} v{k * k}" for k in range(40))
    return table(spark, [(1, None), (2, ""), (3, "!!! ???"), (4, LONG), (5, words), (5, words), (6, words), (None, words + " more"), (7, "one two"), (8, "İstanbul \U0001f600 中文")])


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_decontamination_cases(spark, odd):
    bench = items(spark, [(1, " ".join(f"w{k} v{k * k}" for k in range(10))), (2, None), (3, "!!"), (4, "One TWO"), (4, "one two"), (None, "lorem ipsum dolor")])
    rows = decontamination.decontaminate(odd, bench).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows}
    assert (by[1].n_words, by[1].n_hit, by[1].contaminated) == (0, 0, False)
    assert (by[5].n_words, by[5].n_hit, by[5].n_items, by[5].contaminated) == (80, 20, 1, True)
    assert (by[7].n_hit, by[7].n_items) == (2, 1)
    assert (by[4].n_hit, by[4].n_items) == (60_000, 0)
    cut = decontamination.remove_hit_spans(decontamination.decontaminate(odd.where("doc_id = 5"), bench)).first().text
    assert cut.split() == [x for k in range(10, 40) for x in (f"w{k}", f"v{k * k}")]
    assert decontamination.decontaminate(odd, bench.limit(0)).where("n_hit > 0").count() == 0
    assert decontamination.decontaminate(odd.limit(0), bench).count() == 0


def test_long_runs_are_cut_until_none_is_left(spark):
    item = [f"i{k}" for k in range(26)]
    bench = items(spark, [(1, " ".join(item)), (2, "very short")])
    rest = [f"r{k}" for k in range(400)]
    texts = {
        1: [*rest, *item[:5]],
        2: [*rest[:9], *item[3:17], *rest[9:]],
        3: [*rest, *item[:7], *item[7:20], *item[7:13]],
        4: [*rest, "very", "short"],
    }
    docs = table(spark, [(k, " ".join(t)) for k, t in texts.items()] + [(5, None)])
    measured = decontamination.decontaminate(docs, bench)
    got = {r.doc_id: (r.text, r.n_cut) for r in decontamination.remove_cut_spans(measured).collect()}
    assert got[1] == (" ".join(texts[1]), 0) and got[4] == (" ".join(texts[4]), 0) and got[5] == (None, 0)
    assert got[2][0].split() == rest and got[2][1] == 14
    # what remains on both sides of a cut makes another run
    assert got[3][0].split() in (rest, [*rest, *item[7:13]])
    assert decontamination.decontaminate(docs.limit(0), bench).count() == 0


def test_many_automata_find_what_one_finds(spark):
    r = random.Random(2)
    word = lambda: f"w{r.randint(0, 3)}"
    texts = [" ".join(word() for _ in range(r.randint(0, 60))) for _ in range(60)]
    bench = items(spark, [(k, " ".join(word() for _ in range(r.randint(0, 9)))) for k in range(12)])
    docs = table(spark, list(enumerate(texts)))
    rows = bench.collect()
    for window in (3, 5):
        want = {}
        for k, t in enumerate(texts):
            w, hit, found = t.split(), set(), set()
            for it in rows:
                x = it.text.split()
                n = min(window, len(x))
                for s in range(len(x) - n + 1):
                    for p in range(len(w) - n + 1):
                        if n and w[p : p + n] == x[s : s + n]:
                            hit.update(range(p, p + n))
                            found.add(it.item_id)
            want[k] = (len(w), len(hit), len(found))
        for size in (200_000, 7):
            got = decontamination.decontaminate(docs, bench, window=window, shard_words=size).collect()
            assert {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in got} == want


@pytest.mark.parametrize("seed", range(40))
def test_plan_places_everything_once(seed):
    r = random.Random(seed)
    size = r.choice([7, 20, 100])
    from collections import Counter

    counts = Counter(r.randint(1, size) for _ in range(r.randint(0, 120)))
    plan = packing.Plan(dict(counts), size)
    got = Counter()
    for bins, content in plan.groups:
        assert bins > 0 and sum(n * k for n, k in content.items()) <= size
        for n, k in content.items():
            got[n] += bins * k
    assert got == counts


def test_reduction_keeps_the_optimum():
    """The reduced instance needs as many bins as an exhaustive search says, where that is small."""

    def best(lengths, size):
        lengths = sorted(lengths, reverse=True)
        top = len(lengths)

        def go(i, bins):
            nonlocal top
            if len(bins) >= top:
                return
            if i == len(lengths):
                top = len(bins)
                return
            for j in sorted({b: j for j, b in enumerate(bins) if b >= lengths[i]}.values()):
                go(i + 1, (*bins[:j], bins[j] - lengths[i], *bins[j + 1 :]))
            go(i + 1, (*bins, size - lengths[i]))

        go(0, ())
        return top

    class OnlyReduced(packing.Plan):
        def _best_fit(self):
            self.rest = [n for n, c in self.left.items() for _ in range(c)]

    from collections import Counter

    for seed in range(60):
        r = random.Random(seed)
        lengths = [r.randint(1, 20) for _ in range(r.randint(1, 9))]
        plan = OnlyReduced(dict(Counter(lengths)), 20)
        assert plan.sequences + best(plan.rest, 20) == best(lengths, 20)


def test_tokens_equal_the_tokenizers(spark):
    cache = packing.ChunkCache(packing.tokenizer_path())
    r = random.Random(1)
    letters = "abZÉéßİıſµª¹½'stredvmll 12,.!<|>\n\t\x0b\x85\xa0́中ЖΣς\U0001f600\x00#"
    for _ in range(2000):
        t = "".join(r.choice(letters) for _ in range(r.randint(0, 25))) + r.choice(["", "", "<|endoftext|>"])
        chunks = t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        got = np.frombuffer(b"".join(map(cache.__getitem__, chunks)), "<u4").tolist()
        assert got == cache.tokenizer.encode(t, add_special_tokens=False).ids


def test_packing_cases(spark, odd):
    rows = packing.pack_documents(odd).collect()
    assert sum(r.length == 1 for r in rows) == 2
    assert sorted({r.doc_id for r in rows if r.doc_id}) == list(range(1, 9))
    assert sum(r.doc_id == 5 for r in rows) == 2
    places = {(r.sequence_id, r.offset) for r in rows}
    assert len(places) == len(rows)
    assert packing.pack_documents(odd.limit(0)).count() == 0


def test_extraction_cases(spark):
    model = html_extraction.default_model()
    page = (
        "<html><head><title>t</title></head><body><div class='cookie-notice'>We use cookies to make this site better.</div><header><a href=/>Home</a></header>"
        "<article><h1>A title here</h1><p>First &amp; second&nbsp;sentence,\n of some words that go on.<p>Another paragraph with an <a href=x>inline link</a> in it and more words.</p>"
        "<div class='ad'>Buy this now, it is cheap.</div><script>if (a < b) x('</p>')</script><ul><li>one item of a list<li>another item</ul></article>"
        "<section id='comments'><h3>Comments</h3><p>Nice article, thank you very much.</p></section><form><label>Mail</label><input><button>Go</button></form><footer>&copy; 2024 Somebody</footer></body></html>"
    )
    text = html_extraction.main_text(page, model)
    assert text == "A title here\n\nFirst & second sentence, of some words that go on.\n\nAnother paragraph with an inline link in it and more words.\n\none item of a list\n\nanother item"
    rows = spark.createDataFrame([(1, "u", None, "x"), (2, "u", "", "x"), (3, "u", page, "x"), (3, "u", page, "x"), (4, "u", "<p>" * 3000 + "a", "x"), (5, None, "<article><p>" + "word " * 50_000, "x")], "page_id long, url string, html string, text string")
    got = html_extraction.extract(rows, model).collect()
    assert sorted((r.page_id, r.n_chars) for r in got)[:2] == [(1, 0), (2, 0)]
    assert all(len(r.text) == r.n_chars for r in got) and len(got) == 6
    assert next(r.n_chars for r in got if r.page_id == 5) == 249_999
    assert html_extraction.extract(rows.limit(0), model).count() == 0


@pytest.mark.parametrize("unit", ["<div>x", "<a x ", '<b title="x ', "<c '>'x", "<noscript>", "</script ", "<li>x<ul>", "<td>x", "<!--", "<p x='", "<table><tr><td>x"])
def test_broken_pages_take_linear_time(unit):
    import time

    start = time.process_time()
    text = html_extraction.main_text(unit * (1_000_000 // len(unit)), html_extraction.DomModel({}, np.zeros((2, 2, 2))))
    assert time.process_time() - start < 30
    assert len(text) <= 2_000_000


def test_messages_give_the_exact_marginals():
    """Against the sum over all labellings of small trees."""
    import itertools
    import math

    r = random.Random(3)
    model = html_extraction.DomModel({f: r.uniform(-1, 1) for f in ("element", "text", "tag p", "tag div")}, np.array([[[r.uniform(-1, 1) for _ in "ab"] for _ in "ab"] for _ in "ab"]))
    for page in ("<div><p>a b</p><p>c</p></div>", "<p>x</p>tail", "<div>a<div>b</div></div>"):
        tree = html_extraction.parse(page)
        pull = [sum(model.weights.get(f, 0) for f in fs) for fs in html_extraction.node_features(tree)]
        n, mass, total = len(pull), np.zeros(len(pull)), 0.0
        for y in itertools.product((0, 1), repeat=n):
            e = sum(p * v for p, v in zip(pull, y, strict=True))
            e += sum(model.potentials[int(tree.text[i] is not None), y[tree.parent[i]], y[i]] for i in range(1, n))
            total += math.exp(e)
            mass += math.exp(e) * np.array(y)
        assert np.allclose(model.marginals(tree), mass / total)


def test_language_cases(spark, odd):
    learn = table(spark, [(k, t) for k, t in enumerate(["the house and the garden of the man", "a dog in the street with the cat"] * 10)])
    other = learn.withColumns({"text": F.lit("das haus und der garten des mannes mit der katze"), "lang": F.lit("de")}).unionByName(learn.withColumns({"text": F.lit("москва и дом"), "lang": F.lit("ru")}))
    model = language_id.fit(learn.unionByName(other).unionByName(odd.withColumn("lang", F.lit(None).cast("string"))))
    assert model.langs == ["de", "en", "ru"]
    got = {r.doc_id: r for r in language_id.identify(odd, model).collect()}
    assert [got[k].lang_pred for k in (1, 2, 3)] == ["und"] * 3 and got[1].score == 0
    mixed = table(spark, [(1, "the man and the garden in the street with the dog. " * 3 + "der garten und das haus mit der katze des mannes " * 5), (2, "дом")])
    got = {r.doc_id: r for r in language_id.identify(mixed, model).collect()}
    assert [s.lang for s in got[1].lang_spans] == ["en", "de"] and got[1].lang_pred == "de"
    assert got[2].lang_pred == "ru"
    empty = language_id.fit(odd.limit(0))
    assert {r.lang_pred for r in language_id.identify(odd, empty).collect()} == {"und"}
    assert language_id.identify(odd.limit(0), model).count() == 0


def test_best_path_against_plain_viterbi():
    r = np.random.default_rng(5)
    model = language_id.LanguageModel(["a", "b", "c"], np.zeros((1, 3)), np.ones((1, 3), bool))
    for _ in range(200):
        word = -np.abs(r.normal(0, 3, (r.integers(1, 30), 3))).astype("float32")
        path = model.label(word)
        score = lambda p: word[np.arange(len(p)), p].sum() - language_id.SWITCH * (np.diff(p) != 0).sum()
        best = np.zeros(3)
        for row in word:
            best = np.maximum(best, best.max() - language_id.SWITCH) + row
        assert abs(score(path) - best.max()) < 1e-3


def test_signatures_estimate_the_weighted_similarity():
    r = np.random.default_rng(0)
    errors = []
    for _ in range(60):
        k = r.integers(0, 2**63, 60, dtype="uint64").tolist()
        a = {x: int(r.integers(1, 9)) for x in k[:45]}
        b = {x: (a[x] if x in a and r.random() < 0.5 else int(r.integers(1, 9))) for x in k[10:]}
        bag = lambda d: (np.array(sorted(d), "uint64"), np.array([d[x] for x in sorted(d)]))
        j = near_duplicates.overlap(bag(a), bag(b))
        assert abs(j - sum(min(a.get(x, 0), b.get(x, 0)) for x in k) / sum(max(a.get(x, 0), b.get(x, 0)) for x in k)) < 1e-12
        same = near_duplicates.signature(*bag(a), slots=256) == near_duplicates.signature(*bag(b), slots=256)
        errors.append((same.mean() - j) / np.sqrt(j * (1 - j) / 256))
    assert abs(np.mean(errors)) < 0.5 and 0.7 < np.std(errors) < 1.4


def test_near_duplicate_cases(spark, odd):
    got = near_duplicates.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    by = {(r.doc_id, r.keep): r for r in got}
    assert by[1, True].group_id == 1 and by[2, True].group_id == 2 and by[3, True].group_id == 3
    groups = {r.doc_id: r.group_id for r in got if r.doc_id in (5, 6, None)}
    assert groups == {5: None, 6: None, None: None}
    kept = near_duplicates.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 7, 8]
    assert near_duplicates.near_duplicates(odd.limit(0)).count() == 0


def test_crowded_bands_lose_no_link(spark):
    """Copies of one text with few to many edits: the groups are those of all pairs."""
    r = random.Random(8)
    base = [f"b{k}" for k in range(120)]
    texts = []
    for _ in range(120):
        rate = r.choice([0.01, 0.03, 0.06, 0.12])
        texts.append([r.choice([f"e{r.randint(0, 999)}"]) if r.random() < rate else w for w in base])
    docs = table(spark, [(k, " ".join(t)) for k, t in enumerate(texts)])
    bags = [near_duplicates.bag_of([w.encode() for w in t]) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if near_duplicates.overlap(bags[i], bags[j]) >= 0.8 - 1e-12:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    got = {r.doc_id: r.group_id for r in near_duplicates.near_duplicates(docs).collect()}
    assert got == {k: root(k) for k in range(len(texts))}


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components.connected_components(df).collect()}
    assert {got[k] for k in range(41)} == {0} and {got[k] for k in range(100, 140)} == {100}
    assert components.connected_components(df.limit(0)).count() == 0


def test_rule_measures_and_cases(spark, odd):
    measured = {r.doc_id: r for r in quality_rules.features(odd, keep=["doc_id"]).collect()}
    assert (measured[1].n_words, measured[1].n_repeat_words) == (0, 0)
    assert (measured[4].n_words, measured[4].n_repeat_words) == (100_000, 100_000)
    text = "a b c d e f g h i\nx #\n \na b c d e f g h z\nx #"
    row = quality_rules.features(table(spark, [(1, text)]), keep=["doc_id"]).first()
    assert (row.n_words, row.n_symbols, row.n_lines, row.n_dup_lines, row.n_repeat_words) == (22, 2, 4, 1, 16)
    none = spark.createDataFrame([], "doc_id long, quality int")
    judged = quality_rules.apply_rules(odd, none)
    assert judged.count() == odd.count() and judged.where("kept = base_failed").count() == 0
    assert quality_rules.apply_rules(odd.limit(0), none).count() == 0


def test_binomial_tail_is_exact(spark):
    from math import comb

    cases = [(x, n, p) for n in (1, 5, 40, 900) for x in (0, 1, 3, n // 50) if x <= n for p in (0.01, 0.2)]
    df = spark.createDataFrame(cases, "x int, n int, p double")
    for p in (0.01, 0.2):
        for r in df.where(F.col("p") == p).withColumn("t", quality_rules.binomial_tail(F.col("x"), F.col("n"), p)).collect():
            exact = sum(comb(r.n, i) * p**i * (1 - p) ** (r.n - i) for i in range(r.x + 1))
            assert r.t == 1.0 if r.x > r.n * p else abs(r.t - exact) < 1e-9 * max(exact, 1e-9) + 1e-12
    cut = df.limit(1).withColumn("t", quality_rules.binomial_tail(F.lit(900), F.lit(100_000), 0.01, terms=50)).first().t
    full = df.limit(1).withColumn("t", quality_rules.binomial_tail(F.lit(900), F.lit(100_000), 0.01, terms=900)).first().t
    assert full <= cut < 1.05 * full


def test_certified_cutoffs_hold_their_risk(spark):
    r = random.Random(6)
    rows = [(k, 50, 250, r.choice([0, 0, 1]) if k % 5 else 40, 5, 3, 0, 0, 1 if k % 5 else 0) for k in range(12_000)]
    measured = spark.createDataFrame([x[:-1] for x in rows], "doc_id long, n_words long, word_chars long, n_symbols long, n_capitals long, n_lines long, n_dup_lines long, n_repeat_words long")
    labels = spark.createDataFrame([(x[0], x[-1]) for x in rows], "doc_id long, quality int")
    cut = quality_rules.certify(measured, labels).collect()
    assert [(c.stratum, c.rule) for c in cut] == [(0, "symbols_per_word")] and cut[0].caught == 2400 and cut[0].x == 0
    few = quality_rules.certify(measured.where("doc_id < 1000"), labels).collect()
    assert few == []


def test_classifier_cases(spark, odd):
    labels = spark.createDataFrame([(4, 1), (5, 1), (3, 0), (7, 0), (99, 1), (4, None)], "doc_id long, quality int")
    net = quality_classifier.fit(odd, labels)
    got = quality_classifier.score(odd, net).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    plain = quality_classifier.fit(odd, labels.limit(0))
    assert len({r.score for r in quality_classifier.score(odd, plain).collect()}) == 1
    assert quality_classifier.score(odd.limit(0), net).count() == 0


def test_filters_see_every_place_of_a_text():
    r = np.random.default_rng(1)
    net = quality_classifier.ByteConvolution.start(3, 0.0)
    raw = bytes(r.integers(0, 256, 5000, dtype="uint8"))
    pairs, tables = quality_classifier.pairs_of(raw), net.tables()
    got = quality_classifier.answers(pairs, tables)
    assert len(got) == len(raw) - 7
    for i in (0, 7, 8, len(got) - 1):
        window = net.embedding[np.frombuffer(raw[i : i + 8], "uint8")]
        assert np.allclose(got[i], np.einsum("kd,kdf->f", window, net.filters), atol=1e-4)
    tops = quality_classifier.chunk_features(pairs, tables, net.bias)
    assert np.allclose(tops.max(0), np.maximum(got.max(0) + net.bias, 0), atol=1e-5)


def test_toxicity_cases(spark, odd):
    learn = table(spark, [(k, f"plain words number {k} here " + ("awful nasty " * (1 + k % 4) if k % 3 == 0 else "fine")) for k in range(300)])
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(300)] + [(1, None)], "doc_id long, toxic int")
    model = toxicity.fit(learn, labels)
    assert all(np.diff(model.thresholds) > 0)
    got = {r.doc_id: r for r in toxicity.score(learn, model).collect()}
    assert all(got[k].rejected == (k % 3 == 0) for k in got)
    assert toxicity.score(odd, model).where("rejected").count() == 0
    nothing = toxicity.fit(odd, labels.limit(0))
    assert toxicity.score(odd, nothing).where("rejected").count() == 0
    assert toxicity.score(odd.limit(0), model).count() == 0


def test_ordinal_gradient():
    """The fit reaches a point where no threshold or weight can be moved for a better likelihood."""
    r = np.random.default_rng(2)
    x = r.random((400, 3)) < 0.5
    grades = np.clip((x @ [2, -1, 0] + r.logistic(size=400)).round().astype(int), 0, 2)
    indptr = np.concatenate([[0], np.cumsum(x.sum(1))])
    w, th = toxicity.fit_ordinal(indptr, np.nonzero(x)[1], grades, 3, 3, steps=600, rate=0.05, l2=0.0)

    def loss(w, th):
        tail = np.column_stack([np.ones(400), 1 / (1 + np.exp(th[None] - (x @ w)[:, None])), np.zeros(400)])
        return -np.log(tail[np.arange(400), grades] - tail[np.arange(400), grades + 1]).mean()

    at = loss(w, th)
    for k in range(3):
        for d in (-0.05, 0.05):
            assert loss(w + d * np.eye(3)[k], th) > at - 1e-5
            if k < 2:
                assert loss(w, th + d * np.eye(2)[k]) > at - 1e-5


def test_edit_distance_and_lines(spark, odd):
    def plain(a, b):
        p = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            q = [i]
            for j, y in enumerate(b, 1):
                q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
            p = q
        return p[-1]

    r = random.Random(3)

    def changed(s, k):
        s = list(s)
        for _ in range(k):
            i, o = r.randrange(len(s)), r.random()
            s[i : i + (o > 0.3)] = r.choice("abé\U0001f600") * (o < 0.7)
        return "".join(s)

    pairs = [(a, changed(a, r.randint(0, 4))) for _ in range(600) for a in ["".join(r.choice("abé\U0001f600") for _ in range(r.randint(8, 24)))]]
    df = spark.createDataFrame(pairs, "a string, b string")
    far = line_dedup.counts_apart(line_dedup.char_counts(F.col("a")), line_dedup.char_counts(F.col("b")))
    for x in df.select("a", "b", line_dedup.edit_distance(F.col("a"), F.col("b")).alias("d"), far.alias("c")).collect():
        want = plain(x.a, x.b)
        assert x.d == want and x.c <= 4 if want <= 2 else x.d > 2
    got = line_dedup.dedup_lines(odd)
    assert len(got.columns) == len(odd.columns) + 3 and got.count() == odd.count()
    by = {r.doc_id: r for r in got.collect()}
    assert by[1].text is None and by[1].n_lines == 0 and by[2].text == "" and by[2].n_lines == 1
    assert by[None].text and by[6].text == "" and by[6].n_exact == 1
    assert line_dedup.dedup_lines(odd.limit(0)).count() == 0


@pytest.mark.parametrize(("tau", "hot"), [(1, 1), (2, 24), (3, 1), (3, 24), (4, 24), (5, 1)])
def test_line_join_against_all_pairs(spark, tau, hot, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT_LINES", hot)
    monkeypatch.setattr(line_dedup, "GROWTH", 4)
    r = random.Random(9)
    from test_llm_queries import _edits

    base = ["".join(r.choice("abcdefgh ent") for _ in range(r.randint(38, 48))) for _ in range(12)]
    lines = [x for b in base for _ in range(9) for x in ["".join(c for c in b if r.random() > 0.03 * tau / 2) + r.choice(["", "q"])] if len(x) >= 32]
    # many lines of one template, which share segments
    lines += [f"the entry with number {r.randint(0, 9999)} was seen here again" for _ in range(60)] + ["short", "short"]
    docs = table(spark, [(k, "\n".join(lines[k::11])) for k in range(11)])
    spots = sorted((k, i, x) for k in range(11) for i, x in enumerate(lines[k::11]))
    first, want = {}, set()
    for k, i, x in spots:
        if x in first or len(x) >= 32 and any(len(y) >= 32 and _edits(x, y, tau) <= tau for y in first if y != x and first[y] < (k, i)):
            want.add((k, i))
        first.setdefault(x, (k, i))
    got = {(r.doc_id, i) for r in line_dedup.line_report(docs, tau=tau).collect() for i in r.removed}
    assert got == want


def test_lines_of_one_template_meet_few_others(spark, monkeypatch):
    """Lines that differ in a number: each is compared with some early lines, not with all."""
    met, led = [], line_dedup._led

    def counted(*args):
        out = led(*args)
        met.append(out.count())
        return out

    monkeypatch.setattr(line_dedup, "_led", counted)
    docs = table(spark, [(k, f"stamp number {k} of a page that was printed by the same machine") for k in range(2_000)])
    rows = {r.doc_id: r.n_near for r in line_dedup.line_report(docs).collect()}
    assert rows[0] == 0 and sum(rows.values()) == 1_999
    assert sum(met) < 30 * 2_000


def test_near_copies_keep_the_lines_they_share(spark):
    r = random.Random(4)
    para = lambda: " ".join(f"w{r.randint(0, 10**6)}" for _ in range(30))
    common, base = para(), [para() for _ in range(9)]
    other = [*base[:8], base[8].replace(" ", " x ", 1)]
    docs = {1: [common, para()], 2: [*base, common], 3: [*other, common], 4: [base[0], *[para() for _ in range(8)]], 5: [*base, base[1], common]}
    got = {x.doc_id: x.text.split("\n") for x in line_dedup.dedup_lines(table(spark, [(k, "\n".join(v)) for k, v in docs.items()]), spare_copies=True).collect()}
    assert got == {1: docs[1], 2: base, 3: other, 4: docs[4][1:], 5: base}
    plain = {x.doc_id: x.text.split("\n") for x in line_dedup.dedup_lines(table(spark, [(k, "\n".join(v)) for k, v in docs.items()])).collect()}
    assert plain[3] == [] or len(plain[3]) == 1 and plain[4] == docs[4][1:]


def test_preference_cases(spark):
    turns = "pair_id long, turn int, role string, text string, prompt string"
    a = [(1, 0, "user", "hi", "x"), (1, 1, "assistant", "good", "x"), (2, 0, "user", None, "x"), (2, 1, "assistant", "same", "x"), (3, 0, "user", "only", "x")]
    b = [(1, 0, "user", "hi", "x"), (1, 1, "assistant", "bad!", "x"), (2, 0, "user", None, "x"), (2, 1, "assistant", "same", "x"), (None, 0, "user", "null", "x")]
    got = {r.pair_id: r for r in preference.preference_pairs(spark.createDataFrame(a, turns), spark.createDataFrame(b, turns)).collect()}
    one = got[1]
    assert one.prompt == "<|im_start|>user\nhi<|im_end|>\n" and one.n_prompt_turns == 1
    assert [one.chosen[s.start : s.end] for s in one.chosen_spans] == ["good<|im_end|>"]
    assert [one.rejected[s.start : s.end] for s in one.rejected_spans] == ["bad!<|im_end|>"]
    assert (got[2].chosen, got[2].rejected, got[2].n_prompt_turns) == ("", "", 2)
    assert got[3].rejected == "" and "only" in got[3].chosen
    assert got[None].chosen == "" and "null" in got[None].rejected
    empty = spark.createDataFrame([], turns)
    assert preference.preference_pairs(empty, empty).count() == 0


def test_pipeline_stages_keep_clean_documents(spark, tmp_path):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        assert out.count() <= docs.count()
        assert out.select("doc_id").exceptAll(docs.select("doc_id")).count() == 0
        out.write.parquet(str(tmp_path / stage.__name__))
        docs = spark.read.parquet(str(tmp_path / stage.__name__))
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert packed.select("doc_id").distinct().count() == docs.count()
    assert corpus_pipeline.run(spark, sf).select("doc_id").distinct().count() == docs.count()
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf).count() == 0


def test_pipeline_near_stage_against_flags(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()}
    assert kept == {r.doc_id for r in near_duplicates.near_duplicates(docs).where("keep").collect()}
