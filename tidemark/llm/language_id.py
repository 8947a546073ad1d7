"""Language identification: script ranges narrow the candidates, Viterbi over per-word scores labels spans."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import bounded_sample, held_out, map_text
from tidemark.session import ship_package

#: Bytes of labelled text that the letter statistics are counted on at most.
SAMPLE_BYTES = 64_000_000
BUCKETS = 1 << 16
#: Cost in nats of a change of language between two words, and the most that one word can speak for one.
SWITCH, WORD_LIMIT = 6.0, 8.0
#: Share of a language's letters that a script must have for the language to be its candidate.
SCRIPT_SHARE = 0.01
#: Letters that are scored at a time.
SLAB = 1 << 18

# Unicode ranges of scripts (first, last code point).
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F), (0xA8E0, 0xA8FF)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)],
}


@lru_cache(maxsize=1)
def _script_of() -> np.ndarray:
    """By code point: 0 no letter, 1 a letter of no listed script, from 2 the scripts in order."""
    table = np.fromiter((chr(c).isalpha() for c in range(0x110000)), "uint8", 0x110000)
    for k, ranges in enumerate(SCRIPTS.values(), 2):
        for a, b in ranges:
            table[a : b + 1] *= np.where(table[a : b + 1] > 0, k, 1).astype("uint8")
    return table


def _read(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram bucket and script of each letter, and where each word (run of letters) begins among them."""
    points = np.frombuffer(raw.decode().lower().encode("utf-32-le"), "<u4")
    script = _script_of()[points]
    letter = script > 0
    padded = np.full(len(points) + 2, 32, "uint32")
    padded[1:-1] = np.where(letter, points, 32)
    code = padded[:-2] * np.uint32(0x9E3779B1) ^ padded[1:-1] * np.uint32(0x85EBCA77) ^ padded[2:] * np.uint32(0xC2B2AE3D)
    code = (code * np.uint32(0x27D4EB2F)) >> np.uint32(16)
    begins = letter & ~np.concatenate([[False], letter[:-1]])
    return code[letter], script[letter], np.flatnonzero(begins[letter])


@dataclass
class LanguageModel:
    langs: list[str]
    scores: np.ndarray  # BUCKETS, languages: log probability of a trigram
    candidates: np.ndarray  # scripts, languages: whether the language is written so

    def word_scores(self, code: np.ndarray, script: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """A row for each word: the languages' scores, 0 for the best, at least -WORD_LIMIT for a candidate."""
        out = np.empty((len(begins), len(self.langs)), "float32")
        edges = np.append(begins, len(code))
        at = 0
        while at < len(begins):
            to = max(at + 1, int(np.searchsorted(edges, edges[at] + SLAB, "right")) - 1)
            a, b = edges[at], edges[to]
            out[at:to] = np.add.reduceat(self.scores[code[a:b]], begins[at:to] - a, axis=0)
            at = to
        allowed = self.candidates[script[begins]]
        out = np.where(allowed, out, -np.inf)
        out -= out.max(1, keepdims=True)
        return np.where(allowed, np.maximum(out, -WORD_LIMIT), -1e6).astype("float32")

    def label(self, word: np.ndarray) -> np.ndarray:
        """The language of each word on the best path."""
        best = int(word.sum(0, dtype="float64").argmax())
        gain = np.cumsum(word - word[:, best : best + 1], axis=0, dtype="float64")
        gain = np.concatenate([np.zeros((1, gain.shape[1])), gain])
        # no stretch in another language gains half a change: the path that stays is the best one
        if (gain - np.minimum.accumulate(gain, axis=0)).max() <= SWITCH / 2:
            return np.full(len(word), best)
        n = len(self.langs)
        now, back = [0.0] * n, []
        for row in word.tolist():
            top = max(now)
            source, changed = now.index(top), top - SWITCH
            back.append([k if v >= changed else source for k, v in enumerate(now)])
            now = [max(v, changed) - top + r for v, r in zip(now, row, strict=True)]
        path = np.empty(len(word), "int64")
        state = now.index(max(now))
        for i in range(len(word) - 1, -1, -1):
            path[i] = state
            state = back[i][state]
        return path


def fit(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", max_bytes: int = SAMPLE_BYTES) -> LanguageModel:
    """Count letter trigrams by language on documents outside the held-out fold with a text and a language.

    Of at most about ``max_bytes`` of text, taken by a hash of the id.  Without such documents the model
    has no language and every text is ``und``.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(doc_id, text, lang).where(F.col(text).isNotNull() & F.col(lang).isNotNull() & ~held_out(doc_id))
    sample = bounded_sample(rows, doc_id, text, max_bytes)
    n = BUCKETS + len(SCRIPTS) + 2

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for raw, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                code, script, _ = _read(raw)
                mine = sums.setdefault(name, np.zeros(n, "int64"))
                mine[:BUCKETS] += np.bincount(code, minlength=BUCKETS)
                mine[BUCKETS:] += np.bincount(script, minlength=n - BUCKETS)
        for name, mine in sums.items():
            at = np.flatnonzero(mine)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype("int32")), pa.array(mine[at])], names=["lang", "at", "n"])

    counted = sample.select(F.col(text).cast("binary").alias("t"), F.col(lang).alias("lang")).mapInArrow(tally, "lang string, at int, n long")
    got = counted.groupBy("lang", "at").agg(F.sum("n").alias("n")).toArrow()
    names = got.column("lang").to_pylist()
    langs = sorted(set(names))
    counts = np.zeros((n, len(langs)))
    place = {name: k for k, name in enumerate(langs)}
    counts[got.column("at").to_numpy(), [place[x] for x in names]] = got.column("n").to_numpy()
    grams, scripts = counts[:BUCKETS], counts[BUCKETS:]
    scores = np.log((grams + 0.2) / (grams.sum(0) + 0.2 * BUCKETS)) if langs else grams
    candidates = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(0), 1) if langs else scripts > 0
    candidates[~candidates.any(1)] = True
    return LanguageModel(langs, scores.astype("float32"), candidates)


def identify(docs: DataFrame, model: LanguageModel, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add lang_pred, score and lang_spans.

    ``lang_spans`` are runs of words (runs of letters, numbered from 0) of one language; ``lang_pred`` is the
    language with most letters (the first by name if several), ``score`` its share of the letters.  A null
    text or one without letters is ``und`` with score 0 and no spans.  Whole texts are read.  Repeated
    documents each get their row; other columns are carried, those named like a new one replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = T.StructType.fromDDL("lang_pred string, score double, lang_spans array<struct<start: int, end: int, lang: string>>")

    def make():
        model = shared.value

        def one(raw: bytes | None) -> tuple:
            code, script, begins = _read(raw or b"")
            if not len(begins) or not model.langs:
                return "und", 0.0, []
            path = model.label(model.word_scores(code, script, begins))
            letters = np.bincount(path, np.diff(np.append(begins, len(code))), len(model.langs))
            top = int(letters.argmax())
            cuts = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(path)]
            spans = [{"start": a, "end": b, "lang": model.langs[path[a]]} for a, b in zip(cuts, cuts[1:], strict=False)]
            return model.langs[top], float(letters[top] / letters.sum()), spans

        return lambda texts: [list(c) for c in zip(*map(one, texts), strict=True)]

    return map_text(docs, text, out, make, keep)
