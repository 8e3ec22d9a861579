"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

Tokens are runs of letters, of digits or of other visible bytes. Features are hashes of words, of two words in a row, and of three
shapes in a row (case, repetition of the word before, digits, the marks themselves), each with its share of all features of the
text as value; a score is the sparse dot product with the weights, put through the logistic function.

Training uses a sample of the labelled documents of about `bound` documents, chosen by a hash of doc_id (all, if fewer);
their sparse features come to the driver. The 2 ** 18 weights have a fixed size. A document that is labelled more than once
counts once, as 1 if any row says 1. Labels of null doc_id, null labels and labels without a document teach nothing; without
examples every score is 0.5. Null text counts as empty, and empty texts get the score of the bias. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .batches import small_batches, trimmed

BITS, BOUND, EPOCHS, SCALE = 18, 6000, 4, 20.0
U = np.uint64
# classes of bytes: 0 space, 1 letter, 2 digit, 3 other
KIND = np.full(256, 3, dtype=np.uint8)
KIND[words.SPACE] = 0
KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
KIND[48:58] = 2
CAPITAL = np.zeros(256, dtype=bool)
CAPITAL[65:91] = True


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of each row, one row after the other, and the n + 1 offsets."""
    n = len(offsets) - 1
    if not len(data):
        return np.zeros(0, dtype=np.int64), np.zeros(n + 1, dtype=np.int64)
    kind = KIND[data]
    new = np.concatenate([[True], kind[1:] != kind[:-1]])
    new[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(data))
    seen = kind[starts] > 0
    starts, ends = starts[seen], ends[seen]
    if not len(starts):
        return np.zeros(0, dtype=np.int64), np.zeros(n + 1, dtype=np.int64)
    rows = np.searchsorted(offsets, starts, "right") - 1
    k = kind[starts]
    h = words.hashes(data, starts, ends)
    capitals = np.add.reduceat(CAPITAL[data].astype(np.int64), np.stack([starts, ends], 1).ravel().clip(max=len(data) - 1))[::2] if len(starts) else 0
    same = np.zeros(len(starts), dtype=bool)
    same[1:] = (h[1:] == h[:-1]) & (rows[1:] == rows[:-1])
    shape = np.where(k == 3, h, (k + np.where(k == 1, 4 * np.minimum(capitals, 2) + 16 * same, 0)).astype(np.uint64))
    scale = words.numbers(6, 21)
    with np.errstate(over="ignore"):
        two = rows[1:] == rows[:-1]
        three = rows[2:] == rows[:-2]
        parts = [
            (words.mix(h + scale[0]), rows),
            (words.mix(h[:-1] * scale[1] + h[1:])[two], rows[1:][two]),
            (words.mix((shape[:-2] * scale[2] + shape[1:-1]) * scale[3] + shape[2:] * scale[4])[three], rows[2:][three]),
        ]
    found, row = np.concatenate([x for x, _ in parts]) >> U(64 - BITS), np.concatenate([x for _, x in parts])
    order = np.argsort(row, kind="stable")
    return found[order].astype(np.int64), np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))])


class Ftrl:
    """Logistic regression by FTRL-proximal updates, one example at a time."""

    def __init__(self, size: int = 1 << BITS, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= self.l1, 0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        """One update; the last weight is the bias."""
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ value, -35, 35))) - label) * value
        step = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - step * w
        self.n[at] += g * g


def train(docs: DataFrame, labels: DataFrame, *, label: str = "quality", bound: int = BOUND, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (bias last) from docs (doc_id, text) and labels (doc_id, <label> 0 or 1)."""
    small_batches(docs.sparkSession)
    truth = labels.select(F.col("doc_id").cast("long").alias("of"), F.col(label).cast("int").alias("y")).filter("of is not null and y in (0, 1)")
    n = truth.count()
    model = Ftrl()
    if n:
        draw = F.pmod(F.xxhash64("of"), F.lit(1 << 30))
        truth = truth.filter(draw < min(1 << 30, -(-bound * (1 << 30) // n))).groupBy("of").agg(F.max("y").alias("y"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                data, offsets = words.utf8(batch.column(1))
                for lo, hi in words.chunks(offsets):
                    f, at = features(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                    packed = [np.array(np.unique(f[a:b], return_counts=True), dtype=np.int32).tobytes() for a, b in zip(at, at[1:], strict=False)]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(packed, pa.binary()), batch.column(2).slice(lo, hi - lo)], ["doc_id", "f", "y"])

        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(truth, F.col("doc_id") == F.col("of")).select("doc_id", "text", "y").mapInArrow(trimmed(run), "doc_id long, f binary, y int").collect()
        examples = []
        for r in sorted(rows, key=lambda r: (hash_of(r["doc_id"]), r["f"])):
            at, count = np.frombuffer(r["f"], dtype=np.int32).reshape(2, -1)
            value = count * (SCALE / max(1, count.sum()))
            examples.append((np.append(at, len(model.z) - 1), np.append(value, 1.0), r["y"]))
        for _ in range(epochs):
            for x in examples:
                model.learn(*x)
    return model.weights().astype(np.float32)


def hash_of(doc_id: int) -> int:
    return int(words.mix(np.array([doc_id], dtype=np.int64).view(np.uint64))[0])


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """(doc_id, score, predicted) for each row of docs (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            data, offsets = words.utf8(batch.column(1))
            for lo, hi in words.chunks(offsets):
                f, at = features(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                total = np.concatenate([[0.0], np.cumsum(w[f], dtype=np.float64)])
                logit = w[-1] + SCALE * (total[at[1:]] - total[at[:-1]]) / np.maximum(1, np.diff(at))
                p = 1 / (1 + np.exp(-np.clip(logit, -35, 35)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(trimmed(run), "doc_id long, score double, predicted int")
