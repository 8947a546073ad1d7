"""Document quality by a byte-level convolutional network, trained and applied in numpy.

Filters of eight bytes move byte by byte over the whole text; their largest answers in overlapping chunks of
512 bytes are averaged over the chunks and combined into one probability.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import held_out, labelled_sample, map_text

#: Bytes of labelled text that a network is trained on at most.
SAMPLE_BYTES = 24_000_000
EMBEDDING, FILTERS, PAIRS = 8, 16, 4
#: Bytes from the first pair of a filter to its last.
SPAN = 2 * (PAIRS - 1)
#: Filter positions in half a chunk; chunks overlap by half.
HALF = 256
#: Chunks of a document that one training step uses (all count when a text is scored).
STEP_CHUNKS = 6


@dataclass
class ByteConvolution:
    embedding: np.ndarray  # bytes, EMBEDDING
    filters: np.ndarray  # 2 * PAIRS, EMBEDDING, FILTERS
    bias: np.ndarray  # FILTERS
    weights: np.ndarray  # FILTERS
    offset: float

    @classmethod
    def start(cls, seed: int, offset: float) -> ByteConvolution:
        r = np.random.default_rng(seed)
        return cls(
            r.normal(0, 0.5, (256, EMBEDDING)).astype("float32"),
            r.normal(0, (2 * PAIRS * EMBEDDING) ** -0.5, (2 * PAIRS, EMBEDDING, FILTERS)).astype("float32"),
            np.zeros(FILTERS, "float32"),
            r.normal(0, 0.3, FILTERS).astype("float32"),
            offset,
        )

    def tables(self) -> np.ndarray:
        """What two neighbouring bytes add to the answers, by their place in the filter and their value."""
        by_byte = np.einsum("bd,kdf->kbf", self.embedding, self.filters)
        # a pair is a little-endian 16-bit number: its first byte is the low one
        return (by_byte[0::2][:, None, :, :] + by_byte[1::2][:, :, None, :]).reshape(PAIRS, 65536, FILTERS)

    def logit(self, pooled: np.ndarray) -> np.ndarray:
        return pooled @ self.weights + self.offset


def pairs_of(raw: bytes) -> np.ndarray:
    """Each byte of the text with the next one as a 16-bit number; short texts are filled up to one filter width."""
    b = np.frombuffer(raw.ljust(2 * PAIRS, b"\0"), "uint8").astype("uint16")
    return b[:-1] | b[1:] << 8


def answers(pairs: np.ndarray, tables: np.ndarray) -> np.ndarray:
    n = len(pairs) - SPAN
    out = tables[0][pairs[:n]]
    for k in range(1, PAIRS):
        out += tables[k][pairs[2 * k : 2 * k + n]]
    return out


def chunk_features(pairs: np.ndarray, tables: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """The filters' largest answers in each chunk, rectified: a row a chunk, the last one may be short.

    Long texts go through in pieces, so memory doesn't grow with the text.
    """
    n, step = len(pairs) - SPAN, 128 * HALF
    halves = []
    for at in range(0, n, step):
        a = answers(pairs[at : min(at + step, n) + SPAN], tables)
        halves.append(np.maximum.reduceat(a, np.arange(0, len(a), HALF), axis=0))
    h = np.concatenate(halves)
    tops = np.maximum(h[:-1], h[1:]) if len(h) > 1 else h
    return np.maximum(tops + bias, 0)


def train(texts: list[bytes], labels: np.ndarray, *, steps: int = 700, batch: int = 48, rate: float = 0.01, seed: int = 7) -> ByteConvolution:
    """Adam on the cross-entropy; each step takes some documents and up to STEP_CHUNKS chunks of each."""
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    net = ByteConvolution.start(seed, float(np.log(share / (1 - share))))
    if not 0 < labels.sum() < len(labels):
        net.weights[:] = 0
        return net
    r = np.random.default_rng(seed)
    names = ("embedding", "filters", "bias", "weights", "offset")
    first, second = ({n: np.zeros_like(np.asarray(getattr(net, n), "float32")) for n in names} for _ in range(2))
    by_label = [np.flatnonzero(labels == k) for k in (0, 1)]
    weight = [1 - share, share]
    width = 2 * HALF + SPAN
    # pairs that occur are numbered, so that a step makes answers for them alone
    seen = np.zeros(65536, bool)
    for t in texts:
        seen[pairs_of(t)] = True
    number = np.cumsum(seen) - 1
    known = np.flatnonzero(seen)
    low, high = known & 255, known >> 8
    for step in range(1, steps + 1):
        by_byte = np.einsum("bd,kdf->kbf", net.embedding, net.filters)
        tables = by_byte[0::2][:, low] + by_byte[1::2][:, high]
        windows, sizes, target, cost, room = [], [], [], [], []
        for d in range(batch):
            k = d % 2  # as many of each label; the cost restores their shares
            pairs = pairs_of(texts[r.choice(by_label[k])])
            starts = np.arange(0, max(1, len(pairs) - width + HALF), HALF)
            taken = r.choice(starts, min(STEP_CHUNKS, len(starts)), replace=False)
            for at in taken:
                part = number[pairs[at : at + width]]
                windows.append(np.pad(part, (0, width - len(part))))
                room.append(len(part) - SPAN)
            sizes.append(len(taken))
            target.append(k)
            cost.append(2 * weight[k])
        sizes, target, cost, room, shown = np.array(sizes), np.array(target), np.array(cost), np.array(room), np.array(windows)
        owner = np.repeat(np.arange(batch), sizes)
        n = width - SPAN
        a = tables[0][shown[:, :n]]
        for k in range(1, PAIRS):
            a += tables[k][shown[:, 2 * k : 2 * k + n]]
        a[np.arange(n)[None, :] >= room[:, None]] = -np.inf
        best = a.argmax(1)
        top = np.take_along_axis(a, best[:, None, :], 1)[:, 0, :]
        h = np.maximum(top + net.bias, 0)
        pooled = np.stack([np.bincount(owner, h[:, f], batch) for f in range(FILTERS)], 1) / sizes[:, None]
        p = 1 / (1 + np.exp(-np.clip(net.logit(pooled), -30, 30)))
        g = (p - target) * cost / batch
        g_top = (g / sizes)[owner][:, None] * net.weights * (h > 0)
        g_filters, g_embedding = np.zeros_like(net.filters), np.zeros_like(net.embedding)
        live_i, live_f = np.nonzero(g_top)
        g_live = g_top[live_i, live_f].astype("float32")
        by_filter = np.zeros((len(live_i), FILTERS), "float32")
        by_filter[np.arange(len(live_i)), live_f] = g_live
        at = best[live_i, live_f]
        for k in range(2 * PAIRS):
            pair = shown[live_i, at + k - k % 2]
            byte = (high if k % 2 else low)[pair]
            g_filters[k] = net.embedding[byte].T @ by_filter
            pull = net.filters[k].T[live_f] * g_live[:, None]
            g_embedding += np.stack([np.bincount(byte, pull[:, j], 256) for j in range(EMBEDDING)], 1).astype("float32")
        grads = {"embedding": g_embedding, "filters": g_filters, "bias": g_top.sum(0), "weights": pooled.T @ g + 1e-4 * net.weights, "offset": g.sum()}
        pace = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for n in names:
            first[n] = 0.9 * first[n] + 0.1 * grads[n]
            second[n] = 0.999 * second[n] + 0.001 * grads[n] ** 2
            move = pace * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-7)
            value = getattr(net, n) - move
            setattr(net, n, float(value) if n == "offset" else value.astype("float32"))
    return net


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality", max_bytes: int = SAMPLE_BYTES) -> ByteConvolution:
    """Train on labelled documents outside the held-out fold, of at most about ``max_bytes`` of text.

    Null labels are left out, the smallest wins where an id has several; null texts are empty ones.
    Without rows of both labels every score is the share of label 1.
    """
    marks = labels.where(F.col(label).isNotNull()).groupBy(doc_id).agg(F.min(label).cast("int").alias("__label"))
    rows = labelled_sample(docs, marks.where(~held_out(doc_id)), doc_id, text, max_bytes)
    got = rows.select(F.col(text).cast("binary").alias("t"), "__label", F.xxhash64(doc_id, text).alias("o")).toArrow()
    order = np.argsort(got.column("o").to_numpy(), kind="stable")
    texts, marks = got.column("t").to_pylist(), (got.column("__label").to_numpy() > 0).astype(int)
    return train([texts[i] or b"" for i in order], marks[order])


def score(docs: DataFrame, net: ByteConvolution, *, text: str = "text", threshold: float = 0.7, keep: list[str] | None = None) -> DataFrame:
    """Add score (0 to 1, higher: label 1 likelier) and predicted (1 from ``threshold`` on).

    The filters see every place of every text; very long ones go through in pieces, empty and null texts are
    scored as zero bytes.  Repeated documents each get their row, an empty table stays empty; other columns
    are carried, those named like a new one replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def make():
        net, tables = shared.value, shared.value.tables()

        def rate(texts: list[bytes | None]) -> list[list]:
            pooled = np.stack([chunk_features(pairs_of(t or b""), tables, net.bias).mean(0) for t in texts])
            p = 1 / (1 + np.exp(-np.clip(net.logit(pooled).astype("float64"), -30, 30)))
            return [p.tolist(), (p >= threshold).astype(int).tolist()]

        return rate

    return map_text(docs, text, T.StructType.fromDDL("score double, predicted int"), make, keep)
