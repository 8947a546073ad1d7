"""Best-fit packing of documents into training sequences after Martello-Toth dominance reduction.

Lengths are whole tokens up to the sequence size, so the instance is a histogram of at most that many
lengths however many pieces there are.  The histogram is solved on the driver by groups of equal bins; the
pieces themselves are cut, ranked and placed by Spark.
"""

from __future__ import annotations

import bisect
import itertools
import math
import re
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import map_text, materialise
from tidemark.session import ship_package

CAPACITY = 2048
#: Distinct white-space-free chunks whose ids a task keeps, and their longest size in characters.
CACHE_CHUNKS, CACHE_CHARS = 400_000, 40
#: Pieces of a length that are ranked together.
BUCKET_PIECES = 200_000


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: How the vocabulary's tokenizer cuts a normalised text into the words it merges letters in.
_CUT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Printable Latin characters, which are normalised already but for upper case.
_LATIN = re.compile("[!-~\u00a1-\u012f\u0131-\u024f]+")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else the next free one."""
    own = [33 <= b <= 126 or 161 <= b <= 172 or b >= 174 for b in range(256)]
    free = itertools.count(256)
    return [chr(b) if own[b] else chr(next(free)) for b in range(256)]


class ChunkCache(dict):
    """Ids (little-endian unsigned 32-bit) of a chunk of text without ASCII white space.

    The vocabulary's tokenizer drops white space and never joins tokens across it, so a text's ids are
    those of its chunks one after the other; frequent chunks, and frequent words in them, are looked up.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.letters = _byte_letters()
        self.words: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            mapped = word if word.isascii() else "".join(map(self.letters.__getitem__, word.encode()))
            ids = b"".join(t.id.to_bytes(4, "little") for t in self.merge(mapped))
            if len(word) <= CACHE_CHARS:
                if len(self.words) >= CACHE_CHUNKS:
                    self.words.clear()
                self.words[word] = ids
        return ids

    def __missing__(self, chunk: str) -> bytes:
        if _LATIN.fullmatch(chunk) and "<|" not in chunk:
            ids = b"".join(map(self._word, _CUT.findall(chunk.lower())))
        else:
            ids = np.asarray(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()
        if len(chunk) <= CACHE_CHARS:
            if len(self) >= CACHE_CHUNKS:
                self.clear()
            self[chunk] = ids
        return ids


@lru_cache(maxsize=1)
def _cache(path: str) -> ChunkCache:
    """One for each Python worker, whichever tasks it runs."""
    return ChunkCache(path)


def token_pieces(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of each piece of each document.

    A document is its ids, then id 0 as the end mark; a null text is an empty one.  Only documents longer
    than ``capacity`` are cut.
    """
    path = path or tokenizer_path()
    one = "array<struct<piece: int, start: long, length: long, ids_crc32: long>>"
    out = T.StructType.fromDDL(f"pieces {one}")

    def make():
        cache, end = _cache(path), bytes(4)

        def cut(texts: list[bytes | None]) -> list[list]:
            found = []
            for raw in texts:
                chunks = (raw or b"").decode().replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
                ids = b"".join([*map(cache.__getitem__, chunks), end])
                found.append(
                    [
                        {"piece": k, "start": at // 4, "length": len(part) // 4, "ids_crc32": zlib.crc32(part)}
                        for k, at in enumerate(range(0, len(ids), 4 * capacity))
                        for part in (ids[at : at + 4 * capacity],)
                    ]
                )
            return [found]

        return cut

    return map_text(docs, text, out, make, [doc_id]).select(F.col(doc_id), F.inline("pieces"))


class Plan:
    """Groups of equal sequences: each has a number of bins and how many pieces of which length a bin holds."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        self.capacity = capacity
        self.left = {n: c for n, c in counts.items() if c > 0}
        self.lengths = sorted(self.left)
        self.groups: list[tuple[int, dict[int, int]]] = []
        self.fixed = 0
        self._reduce()
        self._best_fit()

    def _take(self, bins: int, content: dict[int, int]) -> None:
        self.groups.append((bins, content))
        for n, k in content.items():
            self.left[n] -= bins * k
            if not self.left[n]:
                del self.left[n]
                self.lengths.pop(bisect.bisect_left(self.lengths, n))

    def _largest(self, room: int, used: Counter) -> int:
        """The longest piece left, besides ``used``, that fits ``room``; 0 if none does."""
        at = bisect.bisect_right(self.lengths, room)
        while at:
            at -= 1
            if self.left[self.lengths[at]] > used[self.lengths[at]]:
                return self.lengths[at]
        return 0

    def _most(self, room: int, used: Counter) -> int:
        """How many pieces fit ``room`` at most, counted to 3."""
        fit = 0
        for n in self.lengths:
            here = min(3 - fit, self.left[n] - used[n], room // n)
            if n > room or fit == 3:
                break
            fit, room = fit + max(here, 0), room - n * max(here, 0)
        return fit

    def _pair(self, room: int, used: Counter) -> tuple[int, int]:
        """Two pieces, the longer one first, with the largest sum that fits ``room``."""
        best = (0, 0)
        there = [n for n in self.lengths[: bisect.bisect_right(self.lengths, room)] if self.left[n] > used[n]]
        low, high = 0, len(there) - 1
        while low <= high:
            a, b = there[low], there[high]
            if a + b > room:
                high -= 1
                continue
            if a + b > sum(best) and (low < high or self.left[a] - used[a] > 1):
                best = (b, a)
            low += 1
        return best

    def _dominant(self, j: int) -> dict[int, int] | None:
        """A set of at most three pieces with ``j`` that dominates every other feasible set with ``j``."""
        room, used = self.capacity - j, Counter({j: 1})
        most, top = self._most(room, used), self._largest(room, used)
        if most == 0:
            return {j: 1}
        if most == 1 or top == room:
            return dict(Counter([j, top]))
        if most == 2:
            a, b = self._pair(room, used)
            if top >= a + b:
                return dict(Counter([j, top]))
            if top == a:
                # b is the longest that fits beside the longest piece: any other pair is covered one by one.
                used[a] += 1
                if self._largest(room - a, used) == b and self._largest(room - b, Counter([j, b])) == a:
                    shorter = [n for n in self.lengths if b < n < a]
                    if not shorter:
                        return dict(Counter([j, a, b]))
        return None

    def _reduce(self) -> None:
        """Fix dominating sets, longest piece first, until a whole pass finds none."""
        again = True
        while again:
            again = False
            for j in self.lengths[::-1]:
                while j in self.left and (content := self._dominant(j)):
                    bins = min(self.left[n] // k for n, k in content.items())
                    self._take(bins, content)
                    self.fixed += bins
                    again = True

    def _best_fit(self) -> None:
        """Best fit of what is left, longest first: each piece into the fullest bin that still has room."""
        rooms: list[int] = []
        open_at: dict[int, list[list]] = {}

        def put(room: int, bins: int, content: dict[int, int]) -> None:
            if room not in open_at:
                open_at[room] = []
                bisect.insort(rooms, room)
            open_at[room].append([bins, content])

        for n in self.lengths[::-1]:
            count = self.left[n]
            while count:
                at = bisect.bisect_left(rooms, n)
                if at < len(rooms):
                    room = rooms[at]
                    bins, content = open_at[room].pop()
                    if not open_at[room]:
                        del open_at[room]
                        rooms.pop(at)
                else:
                    room, bins, content = self.capacity, math.inf, {}
                each = room // n
                full = min(bins, count // each)
                if full:
                    put(room - each * n, full, content | {n: content.get(n, 0) + each})
                    count -= full * each
                    bins -= full
                if bins and count and count < each:
                    put(room - count * n, 1, content | {n: content.get(n, 0) + count})
                    count, bins = 0, bins - 1
                if 0 < bins < math.inf:
                    put(room, bins, content)
        self.groups += [(bins, content) for same in open_at.values() for bins, content in same]
        self.left, self.lengths = {}, []

    @property
    def sequences(self) -> int:
        return sum(bins for bins, _ in self.groups)

    def slots(self) -> list[tuple[int, int, int, int, int]]:
        """(length, first rank, pieces a bin, first sequence, offset): where the pieces of a length go by rank."""
        out, base, rank = [], 0, Counter()
        for bins, content in self.groups:
            offset = 0
            for n in sorted(content, reverse=True):
                out.append((n, rank[n], content[n], base, offset))
                rank[n] += bins * content[n]
                offset += n * content[n]
            base += bins
        return out


def pack(pieces: DataFrame, *, capacity: int = CAPACITY, doc_id: str = "doc_id") -> DataFrame:
    """Add sequence_id and offset to pieces with a ``length`` of 1 to ``capacity``.

    ``pieces`` is read twice and must give the same rows each time (see ``materialise``).  Only the counts
    by length (at most ``capacity`` rows) reach the driver, and the plan that goes back is bounded by the
    lengths too.  Pieces of a length are interchangeable: each gets a rank, from its place in a bucket of
    its length and the sizes of the buckets before, so that a frequent length is dealt to many tasks.
    Equal rows (repeated documents) are ranked in any order; an empty table gives an empty result.
    """
    spark = pieces.sparkSession
    ship_package(spark)
    rows = pieces.groupBy("length").count().collect()
    plan = Plan({r["length"]: r["count"] for r in rows}, capacity)
    buckets = max(8, math.ceil(sum(r["count"] for r in rows) / BUCKET_PIECES))
    at: dict[int, tuple] = {}
    for n, *slot in plan.slots():
        at.setdefault(n, []).append(slot)
    placed = spark.sparkContext.broadcast({n: tuple(np.array(c, "int64") for c in zip(*s, strict=True)) for n, s in at.items()})

    bucketed = pieces.withColumn("bucket", F.pmod(F.xxhash64(doc_id, "piece"), F.lit(buckets)).cast("int"))
    sizes = bucketed.groupBy("length", "bucket").count()
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "bucket").orderBy(doc_id, "piece", "ids_crc32")
    ranked = (
        bucketed.withColumn("nth", F.row_number().over(inside) - 1)
        .join(firsts, ["length", "bucket"])
        .withColumn("rank", F.col("first") + F.col("nth"))
        .drop("bucket", "nth", "first")
    )

    @F.pandas_udf("sequence_id long, offset long")
    def place(length, rank):
        import pandas as pd

        n, r = length.to_numpy(), rank.to_numpy()
        seq, off = np.zeros(len(n), "int64"), np.zeros(len(n), "int64")
        order = np.argsort(n, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(n[order])) + 1) if len(n) else []:
            size = int(n[part[0]])
            first, each, base, offset = placed.value[size]
            k = np.searchsorted(first, r[part], "right") - 1
            inner = r[part] - first[k]
            seq[part] = base[k] + inner // each[k]
            off[part] = offset[k] + inner % each[k] * size
        return pd.DataFrame({"sequence_id": seq, "offset": off})

    return ranked.withColumn("at", place("length", "rank")).select(*pieces.columns, "at.sequence_id", "at.offset")


def pack_documents(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Tokenise, cut and pack all documents: a row for each piece with its sequence and place there."""
    pieces = materialise(token_pieces(docs, doc_id=doc_id, text=text, capacity=capacity, path=path), "pieces")
    return pack(pieces, capacity=capacity, doc_id=doc_id)
