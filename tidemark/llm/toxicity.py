"""Toxicity by cumulative-link (proportional odds) regression over sparse text features."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import labelled_sample, map_text, words_of

#: Bytes of labelled text that a model is fitted on at most.
SAMPLE_BYTES = 40_000_000
#: Features (words and word beginnings) that a model keeps at most.
FEATURES = 8192
#: Severity grades: 0 not toxic, then toxic with little to much evidence.
GRADES = 4
_PREFIXES = (3, 4, 5)
_CACHE = 300_000


def features_of(word: bytes) -> list[int]:
    """Hashed features of a word: itself and its beginnings."""
    s = word.decode(errors="replace")
    return [zlib.crc32(b"w" + word), *(zlib.crc32(f"{k}{s[:k]}".encode()) for k in _PREFIXES if len(s) >= k)]


def _words(raw: bytes | None) -> set[bytes]:
    return set(words_of((raw or b"").decode().lower().encode()))


@dataclass
class OrdinalModel:
    """P(grade >= k) = 1 / (1 + exp(thresholds[k - 1] - weights . x)): one set of weights, ordered thresholds."""

    weights: dict[int, float]
    thresholds: np.ndarray

    def tail(self, eta: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k from 1, by row."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - np.asarray(eta)[:, None], -60, 60)))

    def expected(self, eta: np.ndarray) -> np.ndarray:
        return self.tail(eta).sum(1)


def _tally(index: np.ndarray, n: int, weights=None, block: int = 1 << 20) -> np.ndarray:
    """Counts of each index below ``n``, or sums of ``weights`` (of a slice), block by block: numpy copies an index to eight bytes each."""
    out = np.zeros(n, "int64" if weights is None else "float64")
    for start in range(0, len(index), block):
        part = slice(start, start + block)
        out += np.bincount(index[part], None if weights is None else weights(part), n)
    return out


def fit_ordinal(indptr: np.ndarray, columns: np.ndarray, grades: np.ndarray, n_features: int, n_grades: int, *, steps: int = 200, rate: float = 0.1, l2: float = 2e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by full-batch Adam on the penalised likelihood of binary features."""
    rows = np.repeat(np.arange(len(grades), dtype="int32"), np.diff(indptr))
    share = np.array([(np.sum(grades >= k) + 0.5) / (len(grades) + 1) for k in range(1, n_grades)])
    start = np.log((1 - share) / share)
    params = np.concatenate([np.zeros(n_features), [start[0]], np.log(np.maximum(np.diff(start), 0.1))])
    first, second = np.zeros_like(params), np.zeros_like(params)
    at = np.arange(len(grades))
    for step in range(1, steps + 1):
        w, th = params[:n_features], np.cumsum([params[n_features], *np.exp(params[n_features + 1 :])])
        eta = _tally(rows, len(grades), lambda part: w[columns[part]])
        tail = np.ones((len(grades), n_grades + 1))
        tail[:, -1] = 0
        tail[:, 1:-1] = 1 / (1 + np.exp(np.clip(th[None, :] - eta[:, None], -60, 60)))
        p = np.maximum(tail[at, grades] - tail[at, grades + 1], 1e-12)
        slope = tail * (1 - tail)
        up, down = slope[at, grades] / p, slope[at, grades + 1] / p
        g_eta = -(up - down) / len(grades)
        g_th = np.array([np.sum(up[grades == k]) - np.sum(down[grades == k - 1]) for k in range(1, n_grades)]) / len(grades)
        g_raw = np.cumsum(g_th[::-1])[::-1]
        grad = np.concatenate([_tally(columns, n_features, lambda part: g_eta[rows[part]]) + l2 * w, g_raw[:1], g_raw[1:] * np.exp(params[n_features + 1 :])])
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        params -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return params[:n_features], np.cumsum([params[n_features], *np.exp(params[n_features + 1 :])])


def grades_of(toxic: np.ndarray, evidence: np.ndarray, n_grades: int = GRADES) -> np.ndarray:
    """Grade 0 for rows that aren't toxic; toxic ones by which part of them has less evidence."""
    grades = np.zeros(len(toxic), "int64")
    if toxic.any():
        cuts = np.quantile(evidence[toxic], np.arange(1, n_grades - 1) / (n_grades - 1))
        grades[toxic] = 1 + np.searchsorted(cuts, evidence[toxic], "left")
    return grades


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", max_bytes: int = SAMPLE_BYTES, n_features: int = FEATURES) -> OrdinalModel:
    """Fit on labelled documents of at most about ``max_bytes`` of text, taken by a hash of the id.

    Only the first threshold rests on labels: these are 0 or 1 (the largest wins where an id has several; null ones are left out); a toxic
    document's grade comes from how many strongly toxic features it has.  Without rows of both kinds the
    model finds nothing toxic.
    """
    marks = labels.where(F.col(label).isNotNull()).groupBy(doc_id).agg((F.max(label) > 0).alias("__toxic"))
    sample = labelled_sample(docs, marks, doc_id, text, max_bytes)

    def make():
        known: dict[bytes, list[int]] = {}

        def featurise(texts: list[bytes | None]) -> list[list]:
            found = []
            for raw in texts:
                ids: set[int] = set()
                for w in _words(raw):
                    if (x := known.get(w)) is None:
                        x = features_of(w)
                        if len(known) < _CACHE:
                            known[w] = x
                    ids.update(x)
                found.append(np.fromiter(ids, "uint32", len(ids)).astype("int32"))
            return [found]

        return featurise

    got = map_text(sample, text, T.StructType.fromDDL("ids array<int>"), make, ["__toxic"]).toArrow()
    toxic = np.asarray(got.column("__toxic").to_pylist(), bool)
    none = OrdinalModel({}, np.full(GRADES - 1, 60.0))
    if not toxic.any() or toxic.all():
        return none
    sizes, parts = [], []
    for chunk in got.column("ids").chunks:
        sizes.append(np.diff(chunk.offsets.to_numpy()))
        parts.append(chunk.flatten().to_numpy())
    del got
    # numbers of four bytes and counts without weights: the sample's features are what the driver holds most of
    names = np.unique(np.concatenate([np.unique(p.view("uint32")) for p in parts]))
    columns = np.concatenate([np.searchsorted(names, p.view("uint32")).astype("int32") for p in parts])
    del parts
    rows_at = np.repeat(np.arange(len(toxic), dtype="int32"), np.concatenate(sizes))
    n1, n0 = toxic.sum(), (~toxic).sum()
    d1 = _tally(columns[toxic[rows_at]], len(names))
    d0 = _tally(columns, len(names)) - d1
    odds = np.log((d1 + 0.5) / (n1 + 1)) - np.log((d0 + 0.5) / (n0 + 1))
    strength = np.abs(odds) / np.sqrt(1 / (d1 + 0.5) + 1 / (d0 + 0.5))
    strength[d1 + d0 < 4] = 0
    kept = np.sort(np.argsort(-strength, kind="stable")[:n_features])
    kept = kept[strength[kept] > 2]
    place = np.full(len(names), -1, "int32")
    place[kept] = np.arange(len(kept))
    strong = (odds > 2) & (strength > 4)
    evidence = _tally(rows_at[strong[columns]], len(toxic))
    columns = place[columns]
    rows_at, columns = rows_at[columns >= 0], columns[columns >= 0]
    indptr = np.concatenate([[0], np.cumsum(_tally(rows_at, len(toxic)))])
    del rows_at
    weights, thresholds = fit_ordinal(indptr, columns, grades_of(toxic, evidence), len(kept), GRADES)
    return OrdinalModel({int(n): float(w) for n, w in zip(names[kept], weights, strict=True) if w}, thresholds)


def score(docs: DataFrame, model: OrdinalModel, *, text: str = "text", reject_at: float = 0.5, keep: list[str] | None = None) -> DataFrame:
    """Add severity (expected grade), p_toxic (that the grade is at least 1), grade (the likeliest) and rejected.

    A null or wordless text has no features and the scores of that.  Every word of a text counts, once, however
    long it is.  Repeated documents each get their row, an empty table stays empty; other columns are carried,
    those named like a new one replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = T.StructType.fromDDL("severity double, p_toxic double, grade int, rejected boolean")

    def make():
        weights, nothing = shared.value.weights, ()
        known: dict[bytes, tuple] = {}

        def rate(texts: list[bytes | None]) -> list[list]:
            eta = np.zeros(len(texts))
            for k, raw in enumerate(texts):
                ids: set[int] = set()
                for w in _words(raw):
                    if (x := known.get(w)) is None:
                        x = tuple(i for i in features_of(w) if i in weights) or nothing
                        if len(known) >= _CACHE:
                            known.clear()
                        known[w] = x
                    if x:
                        ids.update(x)
                eta[k] = sum(weights[i] for i in sorted(ids))
            tail = shared.value.tail(eta)
            mass = -np.diff(np.concatenate([np.ones((len(texts), 1)), tail, np.zeros((len(texts), 1))], 1), axis=1)
            return [tail.sum(1).tolist(), tail[:, 0].tolist(), mass.argmax(1).tolist(), (tail[:, 0] >= reject_at).tolist()]

        return rate

    return map_text(docs, text, out, make, keep)
