"""Benchmark decontamination with a generalised suffix automaton of the normalised test items."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import discard, map_text, materialise, words_of

WINDOW = 13
#: Words of test items in one automaton: bounds what is broadcast at a time (two states a word at most).
SHARD_WORDS = 200_000

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


class SuffixAutomaton:
    """Generalised suffix automaton over word sequences, with the items that own each window.

    A window is ``window`` consecutive words of an item; an item of fewer words is one window itself.
    """

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window, self.names = window, [name for name, _ in items]
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [[self.vocab.setdefault(w, len(self.vocab)) for w in words] for _, words in items]
        for seq in coded:
            last = 0
            for w in seq:
                last = self._extend(last, w)
        #: By state: items with a full window that ends there, (length, items) of short items that do.
        self.owners: dict[int, set[int]] = {}
        self.shorts: dict[int, dict[int, set[int]]] = {}
        for k, seq in enumerate(coded):
            state = 0
            for i, w in enumerate(seq, 1):
                state = self.next[state][w]
                if i >= window:
                    self.owners.setdefault(self._above(state, window), set()).add(k)
            if seq and len(seq) < window:
                self.shorts.setdefault(self._above(state, len(seq)), {}).setdefault(len(seq), set()).add(k)
        #: The state on the suffix path that holds the last ``window`` words, and the next with short items.
        self.full = [self._above(s, window) if n >= window else 0 for s, n in enumerate(self.length)]
        self.short = [-1] * len(self.length)
        for s in sorted(range(len(self.length)), key=self.length.__getitem__):
            self.short[s] = s if s in self.shorts else self.short[self.link[s]] if s else -1

    def _above(self, state: int, n: int) -> int:
        while self.link[state] >= 0 and self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def _add(self, n: int, nxt: dict[int, int], link: int) -> int:
        self.next.append(nxt)
        self.length.append(n)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, p: int, q: int, w: int) -> int:
        """Clone ``q`` so that the words which reach it from ``p`` have a state of their own."""
        clone = self._add(self.length[p] + 1, dict(self.next[q]), self.link[q])
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _extend(self, last: int, w: int) -> int:
        q = self.next[last].get(w)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, w)
        cur, p = self._add(self.length[last] + 1, {}, 0), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, w)
        return cur

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Spans [from, to) of hit words, in order and merged, and the items that have occurring windows."""
        nxt, link, length, short, window = self.next, self.link, self.length, self.short, self.window
        spans: list[tuple[int, int]] = []
        found: set[int] = set()
        state = n = 0
        for i, w in enumerate(map(self.vocab.get, words), 1):
            if w is None:
                state = n = 0
                continue
            to = nxt[state].get(w)
            if to is None:
                while to is None and state:
                    state = link[state]
                    to = nxt[state].get(w)
                n = length[state]
                if to is None:
                    continue
            state = to
            n += 1
            reach = 0
            if n >= window:
                reach = window
                found |= self.owners[self.full[state]]
            s = short[state]
            while s >= 0:
                for size, owners in self.shorts[s].items():
                    if size <= n:
                        reach = max(reach, size)
                        found |= owners
                s = short[link[s]] if s else -1
            if reach:
                first = i - reach
                while spans and spans[-1][1] >= first:
                    first = min(first, spans.pop()[0])
                spans.append((first, i))
        return spans, found


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def automata(benchmark: DataFrame, item: str, text: str, window: int, shard_words: int) -> Iterator[SuffixAutomaton]:
    """Automata over the items, each of ``shard_words`` words (or one item) at most; items stream in."""
    shard, size = [], 0
    rows = benchmark.select(F.col(item).cast("string").alias("i"), F.col(text).cast("binary").alias("t"))
    for row in rows.where("t is not null").toLocalIterator():
        words = words_of(bytes(row.t))
        if shard and size + len(words) > shard_words:
            yield SuffixAutomaton(shard, window)
            shard, size = [], 0
        if words:
            shard.append((row.i, words))
            size += len(words)
    if shard:
        yield SuffixAutomaton(shard, window)


def _scanned(docs: DataFrame, text: str, shards: Iterator[SuffixAutomaton]) -> DataFrame:
    """A table of k1, k2 (hashes of a text), spans and names of the texts that any automaton hits.

    The texts pass one automaton after the other, and only that one is in memory.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{text}`").alias("text")).where("text IS NOT NULL").select("text", *_text_key("text"))
    found = []
    for automaton in shards:
        shared = spark.sparkContext.broadcast(automaton)

        def make(shared=shared):
            def scan(raws: list[bytes | None]) -> list[list]:
                spans, names = [], []
                for raw in raws:
                    got, owners = shared.value.scan(words_of(raw or b""))
                    spans.append([{"start": a, "end": b} for a, b in got])
                    names.append(sorted({x for x in (shared.value.names[k] for k in owners) if x is not None}))
                return [spans, names]

            return scan

        hits = map_text(texts, "text", T.StructType.fromDDL("spans array<struct<start: long, end: long>>, names array<string>"), make, ["k1", "k2"])
        found.append(materialise(hits.where(F.size("spans") > 0).dropDuplicates(["k1", "k2"]), "hits"))
        shared.destroy()
    union = found[0]
    for more in found[1:]:
        union = union.unionByName(more)
    both = union.groupBy("k1", "k2").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("names"))).alias("names"))
    out = materialise(both, "hits")
    discard(*found)
    return out


def _text_key(text: str) -> tuple[Column, Column]:
    return F.xxhash64(F.col(text)).alias("k1"), F.xxhash64(F.lit("text"), F.col(text)).alias("k2")


def _long_runs(automaton_scan, words: list[bytes], spans: list[tuple[int, int]], least: int) -> list[tuple[int, int]]:
    """Runs of ``least`` hit words and more, and those that come together once these are cut out."""
    gone: list[tuple[int, int]] = []
    places = list(range(len(words)))
    while runs := [(a, b) for a, b in spans if b - a >= least]:
        gone += [(places[k], places[k] + 1) for a, b in runs for k in range(a, b)]
        inside = {k for a, b in runs for k in range(a, b)}
        places = [p for k, p in enumerate(places) if k not in inside]
        spans = automaton_scan([words[p] for p in places])
    return _merge(gone)


def _cut_places(docs: DataFrame, text: str, hits: DataFrame, shards: Callable[[], Iterator[SuffixAutomaton]], least: int) -> DataFrame:
    """(k1, k2, gone): places of the words that ``_long_runs`` takes out, with several automata.

    What is left of a text passes all automata again until it has no long run; a later pass sees only the
    texts that were cut in the one before.
    """

    def make():
        def cut(texts: list[dict]) -> list[list]:
            left, gone, places = [], [], []
            for t in texts:
                words, known = words_of(t["text"] or b""), json.loads(t["found"])
                at = known.get("places") or list(range(len(words)))
                runs = _merge([(s["start"], s["end"]) for s in known["spans"]])
                inside = {k for a, b in runs if b - a >= least for k in range(a, b)}
                rest = [k for k in range(len(words)) if k not in inside]
                left.append(b" ".join(words[k] for k in rest).decode())
                gone.append([at[k] for k in sorted(inside)])
                places.append([at[k] for k in rest])
            return [left, gone, places]

        return cut

    out = T.StructType.fromDDL("left string, gone array<long>, places array<long>")

    def step(texts: DataFrame) -> DataFrame:
        both = F.struct(F.col("text").cast("binary").alias("text"), F.to_json(F.struct("spans", "places")).alias("found")).alias("both")
        return materialise(map_text(texts.select("k1", "k2", both), "both", out, make, ["k1", "k2"], as_is=True).where(F.size("gone") > 0), "cuts")

    texts = docs.select(F.col(f"`{text}`").alias("text")).where("text IS NOT NULL").select("text", *_text_key("text")).join(hits, ["k1", "k2"]).dropDuplicates(["k1", "k2"])
    rounds = [step(texts.withColumn("places", F.lit(None).cast("array<long>")))]
    while not rounds[-1].isEmpty():
        last = rounds[-1].select("k1", "k2", "places", F.col("left").alias("text"))
        again = _scanned(last, "text", shards())
        found = again.select(F.col("k1").alias("l1"), F.col("k2").alias("l2"), "spans")
        l1, l2 = _text_key("text")
        rounds.append(step(last.withColumns({"l1": l1, "l2": l2}).join(found, ["l1", "l2"])))
        discard(again)
    every = reduce(DataFrame.unionByName, [r.select("k1", "k2", "gone") for r in rounds])
    cuts = materialise(every.groupBy("k1", "k2").agg(F.flatten(F.collect_list("gone")).alias("gone")), "cuts")
    discard(*rounds)
    return cuts


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    coverage: tuple[int, int] = (1, 20),
    longest: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    keep: list[str] | None = None,
) -> DataFrame:
    """Measure how much of each document occurs in the test items, and what of it is too long to stay.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased.  The training
    tokens stream through the automaton; wherever the longest match reaches ``window`` words (or a whole
    shorter item), the words of that match are hit.  Adds n_words, n_hit, n_items, items_sha256 (of the
    sorted, comma-joined ids), contaminated (the share of hit words is at least ``coverage``), n_cut (words
    in runs of ``longest`` hit words and more, which ``remove_cut_spans`` takes out), hit_spans and cut_spans
    (start and end in code points of each run, end exclusive; a cut run may also come from what stands on
    both sides of another, which n_cut doesn't count).

    An automaton holds ``shard_words`` words of items at most and is broadcast.  More items make more
    automata, which the texts pass one after the other, only one of them in memory at a time; what they
    find is joined to the documents, and what is left of a cut text passes them all again, so the result is
    the same with any number of automata.  Defined cases: a null or wordless text has no words and is not
    contaminated; a very long text streams through like any other; null items are skipped, items with a
    null id mark words but are not named, repeated items count once by id; an empty benchmark hits nothing
    and an empty table stays empty; repeated documents each get their row; other columns are carried, those
    named like a new one are replaced.
    """
    sc = docs.sparkSession.sparkContext

    def shards() -> Iterator[SuffixAutomaton]:
        return automata(benchmark, item, item_text, window, shard_words)

    first = shards()
    one, two = next(first, None), next(first, None)
    shared, hits = None, None
    if two is not None:
        hits = _scanned(docs, text, shards())
        hits = hits.join(_cut_places(docs, text, hits, shards, longest), ["k1", "k2"], "left")
    elif one is not None:
        shared = sc.broadcast(one)
    num, den = coverage
    out = T.StructType.fromDDL(
        "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, n_cut long,"
        " hit_spans array<struct<start: long, end: long>>, cut_spans array<struct<start: long, end: long>>"
    )

    def row(raw: bytes | None, words: list[bytes], spans: list[tuple[int, int]], names: list[str], cut: list[tuple[int, int]]) -> tuple:
        ids = sorted(names, key=str.encode)
        n_hit = sum(b - a for a, b in spans)
        hit_at, cut_at = [], []
        if spans:
            places = [m.span() for m in _WORD.finditer(raw.decode())]
            hit_at, cut_at = ([{"start": places[a][0], "end": places[b - 1][1]} for a, b in runs] for runs in (spans, cut))
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        n_cut = sum(b - a for a, b in spans if b - a >= longest)
        return len(words), n_hit, len(ids), digest, n_hit > 0 and den * n_hit >= num * len(words), n_cut, hit_at, cut_at

    if hits is None:

        def make():
            automaton = shared.value if shared else None

            def measure(texts: list[bytes | None]) -> list[list]:
                rows = []
                for raw in texts:
                    words = words_of(raw or b"")
                    spans, found = automaton.scan(words) if automaton else ([], set())
                    names = {x for x in (automaton.names[k] for k in found) if x is not None}
                    cut = _long_runs(lambda w: automaton.scan(w)[0], words, spans, longest) if spans else []
                    rows.append(row(raw, words, spans, list(names), cut))
                return [list(c) for c in zip(*rows, strict=True)]

            return measure

        return map_text(docs, text, out, make, keep)

    # the row travels as one value, so that no column of it can clash
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    joined = docs.select(whole, F.col(f"`{text}`").alias("text"), *_text_key(f"`{text}`")).join(hits, ["k1", "k2"], "left")
    ready = joined.select("row", "text", F.to_json(F.struct("spans", "names", "gone")).alias("found"))
    fed = ready.select("row", F.struct(F.col("text").cast("binary").alias("text"), "found").alias("both"))

    def make_joined():
        def measure(pairs: list[dict]) -> list[list]:
            rows = []
            for pair in pairs:
                raw, words = pair["text"], words_of(pair["text"] or b"")
                found = json.loads(pair["found"])
                spans = _merge([(s["start"], s["end"]) for s in found.get("spans", [])])
                cut = _merge([(k, k + 1) for k in found.get("gone", [])])
                rows.append(row(raw, words, spans, found.get("names", []), cut))
            return [list(c) for c in zip(*rows, strict=True)]

        return measure

    measured = map_text(fed, "both", out, make_joined, ["row"], as_is=True)
    new = {f.name.lower() for f in out}
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in new]
    return measured.select(*[F.col("row")[c].alias(c) for c in kept], *[f.name for f in out])


def remove_cut_spans(measured: DataFrame, *, text: str = "text") -> DataFrame:
    """Cut the ``cut_spans`` out of ``text``; each cut leaves a blank.

    A null text stays null; a text without such spans is unchanged.
    """
    return _cut(measured, F.col("cut_spans"), text)


def remove_hit_spans(measured: DataFrame, *, text: str = "text", min_chars: int = 1) -> DataFrame:
    """Cut the ``hit_spans`` of at least ``min_chars`` code points out of ``text``; each cut leaves a blank.

    A null text stays null; a text without such spans is unchanged.
    """
    return _cut(measured, F.filter("hit_spans", lambda s: s["end"] - s["start"] >= min_chars), text)


def _cut(measured: DataFrame, cuts: Column, text: str) -> DataFrame:
    body = F.col(f"`{text}`")
    done = F.aggregate(
        cuts,
        F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda acc, s: F.struct(
            F.concat(acc["out"], F.substring(body, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(" ")).alias("out"),
            s["end"].alias("at"),
        ),
        lambda acc: F.concat(acc["out"], F.substring(body, (acc["at"] + 1).cast("int"), F.lit(2147483647))),
    )
    return measured.withColumn(text, F.when(F.size(cuts) > 0, done).otherwise(body))
