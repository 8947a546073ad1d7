"""Near-duplicate documents: BagMinHash signatures, bands, verified multiset overlap, components.

Documents are bags of five-word shingles.  A signature slot of two bags agrees with the probability of their
weighted Jaccard similarity: every shingle has a Poisson process over time and weight, a bag sees the points
below its weight, and a slot keeps its earliest point.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import bound_batches, discard, map_text, materialise, release, words_of
from tidemark.llm.components import connected_components
from tidemark.session import ship_package

SHINGLE = 5
SIMILARITY = 0.8
#: 24 bands of 5 slots: a pair of similarity 0.8 shares no band with a probability of 7e-5.
BANDS, BAND_SLOTS = 24, 5
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_KNOWN_WORDS = 400_000


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        self[word] = h
        return h


@lru_cache(maxsize=1)
def _word_hashes() -> _WordHashes:
    return _WordHashes()


def bag_of(words: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles and how often each occurs; fewer words than a shingle has are one."""
    h = np.fromiter(map(_word_hashes().__getitem__, words), "uint64", len(words))
    n = max(1, len(h) - size + 1)
    total = np.zeros(n, "uint64")
    for k in range(min(size, len(h))):
        total = _mix(total * _GOLDEN + h[k : k + n])
    return np.unique(total, return_counts=True)


def signature(items: np.ndarray, counts: np.ndarray, slots: int = BANDS * BAND_SLOTS) -> np.ndarray:
    """Times of the slots' earliest points, as unsigned 64-bit patterns.

    The weight axis is cut into dyadic blocks [0, 1), [1, 2), [2, 4) ...; a block's points come at a rate of
    ``slots`` times its width, fall on one of its unit levels by chance, and count where the level is below
    the item's weight.  Only points before a horizon are made; it is doubled until every slot has one.
    """
    horizon = (np.log(slots) + 4) / counts.sum()
    while True:
        best = np.full(slots, np.inf)
        block, width = 0, 1
        inside = np.arange(len(items))
        while len(inside):
            _points(best, items[inside], counts[inside], block, width, slots, horizon)
            block, width = block + 1, 2**block
            inside = inside[counts[inside] > width]
        if best.max() <= horizon:
            return best.view("uint64")
        horizon *= 2


def _points(best: np.ndarray, items: np.ndarray, counts: np.ndarray, block: int, width: int, slots: int, horizon: float) -> None:
    stream = _mix(items + np.uint64((block + 1) * 0xD1342543DE82EF95 % 2**64))
    low = 0 if block == 0 else width
    mean = slots * width * horizon
    many = int(mean + 3 * mean**0.5) + 1
    at, time = 0, np.zeros(len(items))
    live = np.arange(len(items))
    while len(live):
        steps = np.arange(at + 1, at + many + 1, dtype="uint64") * _GOLDEN
        x = _mix(stream[live][:, None] + steps[None, :])
        gaps = -np.log(((x >> np.uint64(11)).astype("float64") + 0.5) * 2.0**-53) / (slots * width)
        gaps[:, 0] += time[live]
        times = np.cumsum(gaps, axis=1)
        row, col = np.nonzero(times <= horizon)
        if len(row):
            y = _mix(x[row, col] ^ _GOLDEN)
            if block:
                below = low + ((y >> np.uint64(32)) % np.uint64(width)).astype("int64") < counts[live[row]]
                row, col, y = row[below], col[below], y[below]
            np.minimum.at(best, ((y & np.uint64(0xFFFFFFFF)) % np.uint64(slots)).astype("int64"), times[row, col])
        time[live] = times[:, -1]
        live = live[times[:, -1] <= horizon]
        at += many


def band_keys(sig: np.ndarray) -> np.ndarray:
    rows = sig.reshape(BANDS, BAND_SLOTS)
    key = np.arange(1, BANDS + 1, dtype="uint64")
    for k in range(BAND_SLOTS):
        key = _mix(key * _GOLDEN + rows[:, k])
    return key.view("int64")


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = np.minimum(a[1][i], b[1][j]).sum()
    return float(common / (a[1].sum() + b[1].sum() - common))


def _row_key(doc_id: str, text: str) -> tuple[Column, Column]:
    """What tells rows apart: rows with the same id and text have the same key."""
    return F.xxhash64(doc_id, text).alias("k1"), F.hash(text, doc_id).alias("k2")


def _sketches(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """k1, k2, doc_id, digest (of the words, null without any) and band keys of each document."""

    def make():
        def sketch(texts: list[bytes | None]) -> list[list]:
            digests, bands = [], []
            seen: dict[bytes, np.ndarray] = {}
            for raw in texts:
                words = words_of(raw or b"")
                if not words:
                    digests.append(None)
                    bands.append(None)
                    continue
                d = hashlib.blake2b(b" ".join(words), digest_size=16).digest()
                if d not in seen:
                    seen[d] = band_keys(signature(*bag_of(words)))
                digests.append(d)
                bands.append(seen[d])
            return [digests, bands]

        return sketch

    fed = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).select("doc_id", "text", *_row_key("doc_id", "text"))
    return map_text(fed, "text", T.StructType.fromDDL("digest binary, bands array<long>"), make, ["k1", "k2", "doc_id"])


def _least(n: int, share: float) -> int:
    """The least whole number that is ``share`` of ``n`` or more."""
    return int(np.ceil(share * n - 1e-9))


#: Blocks that shingles are dealt to by hash; a sketch tells which hold one, and two or more, of a bag.
BLOCKS = 512


def prefix_keys(bag: tuple[np.ndarray, np.ndarray], leader: tuple[np.ndarray, np.ndarray], name: bytes, similarity: float) -> np.ndarray:
    """The first shingles of a bag in its leader's order, as many as a partner must share one of.

    What the leader lacks comes first, so that the keys of bags far from it are their own.  A shingle's
    repetitions are told apart.
    """
    items, counts = bag
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = np.minimum(np.searchsorted(leader[0], items), len(leader[0]) - 1)
    theirs = np.where(leader[0][at] == items, leader[1][at], 0)
    token = _mix(np.repeat(items, counts) + (nth + 1).astype("uint64") * _GOLDEN)
    order = np.lexsort((token, nth < np.repeat(theirs, counts)))
    size = len(token) - _least(len(token), similarity) + 1
    return _mix(token[order[:size]] ^ np.uint64(int.from_bytes(name[:8], "little"))).view("int64")


def block_sketch(bag: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, int]:
    """Bits of the blocks with a shingle and with two, as numbers, and the shingles beyond two of a block.

    Two bags share at most as many shingles as bits of both, and the lesser number beyond.
    """
    held = np.bincount((_mix(bag[0] ^ _GOLDEN) % np.uint64(BLOCKS)).astype("int64"), bag[1], BLOCKS)
    bits = np.packbits(np.concatenate([held >= 1, held >= 2]), bitorder="little").view("int64")
    return bits, int(np.maximum(held - 2, 0).sum())


def _verified(pairs: DataFrame, texts: DataFrame, prefixes: float | None = None) -> DataFrame:
    """(a, b, distance) of pairs of digests by the overlap of their whole bags.

    With a similarity as ``prefixes`` also size (shingles of a), keys (a's prefix in b's order), blocks and
    beyond (a's sketch).
    """
    side = lambda c: texts.select(F.col("digest").alias(c), F.col("text").alias(f"text_{c}"))
    fed = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", F.col("text_a").cast("binary"), F.col("text_b").cast("binary"))
    ship_package(pairs.sparkSession)
    bound_batches(pairs.sparkSession)

    def compare(batches):
        import pyarrow as pa

        recent: OrderedDict[bytes, tuple] = OrderedDict()

        def bag(key: bytes, raw: bytes) -> tuple:
            if key in recent:
                recent.move_to_end(key)
            else:
                recent[key] = bag_of(words_of(raw))
                if len(recent) > 64:
                    recent.popitem(last=False)
            return recent[key]

        for batch in batches:
            far, extra = [], []
            for a, b, x, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                mine, other = bag(a, x), bag(b, y)
                far.append(1 - overlap(mine, other))
                if prefixes:
                    extra.append((int(mine[1].sum()), prefix_keys(mine, other, b, prefixes), *block_sketch(mine)))
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64()]
            made = [pa.array(c, t) for c, t in zip(zip(*extra, strict=True), kinds, strict=True)] if extra else []
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(far, pa.float64()), *made], names=["a", "b", "distance", *_EXTRA[: len(made)]])

    return fed.mapInArrow(compare, "a binary, b binary, distance double" + (", size long, keys array<long>, blocks array<long>, beyond long" if prefixes else ""))


_EXTRA = ("size", "keys", "blocks", "beyond")


def _open_pairs(checked: DataFrame, component: DataFrame, similarity: float) -> DataFrame:
    """(a, b): pairs with one leader and different components that may reach ``similarity``.

    Two such bags share a shingle among the first of each in the leader's order (prefix filter); at the
    first shared one the rest of both must still suffice (positional filter), and so must what their block
    sketches allow them to share.  Pairs within the leader's own component, the bulk of a large group, are
    never met: one side is always from outside it.
    """
    at = lambda c: component.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
    placed = checked.join(at("a"), "a", "left").join(at("b"), "b", "left")
    placed = placed.withColumns({"ca": F.coalesce("ca", "a"), "cb": F.coalesce("cb", "b")})
    outside = placed.where("ca <> cb").select("b").distinct()
    about = F.struct("size", "blocks", "beyond", (F.col("ca") == F.col("cb")).alias("led"))
    rows = placed.join(outside, "b", "left_semi").select("a", "ca", about.alias("of"), F.posexplode("keys").alias("pos", "key"))
    rows = materialise(rows, "prefixes")
    release(rows.sparkSession)
    least = lambda n: F.ceil(n * (similarity / (1 + similarity)) - 1e-9)
    short = rows.where(F.col("pos") <= F.col("of.size") - least(2 * F.col("of.size")))
    x = short.select("key", F.col("a").alias("x"), F.col("ca").alias("cx"), F.col("of").alias("ox"), F.col("pos").alias("px"))
    y = rows.select("key", F.col("a").alias("y"), F.col("ca").alias("cy"), F.col("of").alias("oy"), F.col("pos").alias("py"))
    nx, ny = F.col("ox.size"), F.col("oy.size")
    both = sum((F.bit_count(F.get("ox.blocks", k).bitwiseAND(F.get("oy.blocks", k))) for k in map(F.lit, range(2 * BLOCKS // 64))), F.lit(0))
    most = F.least(nx - F.col("px"), ny - F.col("py"), both + F.least("ox.beyond", "oy.beyond"))
    enough = (F.col("p.key") == F.col("q.key")) & (F.col("cx") != F.col("cy")) & (nx <= ny) & (most >= least(nx + ny))
    met = [x.where("NOT ox.led").alias("p").join(y.alias("q"), enough), x.where("ox.led").alias("p").join(y.where("NOT oy.led").alias("q"), enough)]
    pairs = met[0].select("x", "y").unionByName(met[1].select("x", "y"))
    found = materialise(pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "pairs")
    discard(rows)
    return found


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, among: DataFrame | None = None) -> DataFrame:
    """doc_id, class_id, group_id and keep of each document, with k1 and k2 (which tell rows apart).

    Documents with the same words are a class, named by its least id.  Classes that share a band are
    compared with the band's leader, the class that shares most bands with others.  Where that leaves a
    leader's classes in several components, the pairs among them that can still reach ``similarity`` are
    found by their prefixes in the leader's order and compared too.  So each link between different texts
    of a band is found or can't change a component, and no group's pairs are listed.  Components of classes
    linked at ``similarity`` or more are groups, named by their least id; one document of each, that with
    the least id, has ``keep``.

    Defined cases: a document without words (or a null text) is a class and group of its own; documents
    with fewer than five words are one shingle; rows with the same id and text share their flags; null ids
    come first; an empty table gives an empty result; other columns play no part.  With ``among`` (doc_id) only
    rows with one of these ids count.
    """
    limit = 1 - similarity + 1e-12
    sketches = _sketches(docs, doc_id, text)
    rows = materialise(sketches if among is None else sketches.join(among, "doc_id", "left_semi"), "sketches")
    me = F.struct("doc_id", "k1", "k2")
    classes = materialise(rows.where("digest IS NOT NULL").groupBy("digest").agg(F.min(me).alias("first"), F.any_value("bands").alias("bands")), "classes")

    keyed = classes.select("digest", F.explode("bands").alias("key")).distinct()
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared_members = materialise(keyed.join(shared, "key"), "members")
    rank = materialise(shared_members.groupBy("digest").agg(F.sum("n").alias("rank")), "ranks")
    members = materialise(shared_members.select("key", "digest").join(rank, "digest"), "ranked")
    wanted = rank.join(classes, "digest").select("digest", "first.k1", "first.k2")
    found = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).select("text", *_row_key("doc_id", "text")).join(wanted, ["k1", "k2"])
    texts = materialise(found.select("digest", "text").dropDuplicates(["digest"]), "texts")

    discard(shared_members)
    top = members.groupBy("key").agg(F.max(F.struct("rank", "digest")).alias("top")).select("key", F.col("top.digest").alias("leader"))
    pairs = members.join(top, "key").where("digest <> leader").select(F.col("digest").alias("a"), F.col("leader").alias("b")).distinct()
    checked = materialise(_verified(pairs, texts, similarity), "checked")
    release(docs.sparkSession)
    links = checked.where(F.col("distance") <= limit).select("a", "b")
    component = connected_components(links)
    left = _open_pairs(checked, component, similarity)
    if not left.isEmpty():
        more = materialise(_verified(left, texts).where(F.col("distance") <= limit).select("a", "b"), "links")
        if not more.isEmpty():
            # what is linked hangs on its component already
            first, hung = component, component.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
            component = connected_components(hung.unionByName(more))
            discard(first)
        discard(more)

    discard(rank, members, texts, checked, left)
    release(docs.sparkSession)
    grouped = classes.select("digest", "first").join(component.withColumnRenamed("node", "digest"), "digest", "left").withColumn("component", F.coalesce("component", "digest"))
    firsts = grouped.groupBy("component").agg(F.min("first").alias("kept"))
    by_class = grouped.join(firsts, "component").select("digest", F.col("first.doc_id").alias("class_id"), "kept")
    flags = rows.drop("bands").join(by_class, "digest", "left").select(
        "doc_id",
        F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("kept.doc_id")).alias("group_id"),
        (F.col("digest").isNull() | (F.col("kept") == me)).alias("keep"),
        "k1",
        "k2",
    )
    out = materialise(flags, "flags")
    discard(rows, classes, component)
    release(docs.sparkSession)
    return out


def drop_near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, untouched: DataFrame | None = None) -> DataFrame:
    """The documents without all but one of each group; the columns are those of ``docs``.

    ``untouched`` has the texts of the same documents (doc_id, text) before something was cut out of them.  Then
    documents go, too, whose untouched text is a copy of that of another one in ``docs`` with a lesser id; those
    with a null id, and ids that ``docs`` doesn't have, play no part in that.
    """
    flags = near_duplicates(docs, doc_id=doc_id, text=text, similarity=similarity)
    kept = flags.where("keep").select("k1", "k2").distinct()
    # the row travels as one value, so that no column of it can clash
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    left = docs.select(row, *_row_key(doc_id, text)).join(kept, ["k1", "k2"]).dropDuplicates(["k1", "k2"]).select("row")
    if untouched is not None:
        own = materialise(docs.select(F.col(doc_id).alias("doc_id")).where("doc_id IS NOT NULL").distinct(), "ids")
        before = near_duplicates(untouched, doc_id=doc_id, text=text, similarity=similarity, among=own)
        copies = before.groupBy("doc_id").agg(F.max("keep").alias("kept")).where("NOT kept").select(F.col("doc_id").alias("copy"))
        left = left.join(copies, F.col("row")[doc_id] == F.col("copy"), "left_anti")
    return left.select("row.*")
