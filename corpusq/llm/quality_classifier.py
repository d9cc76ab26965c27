"""Supervised subword embeddings for document quality.

A word's features are the word itself and its character n-grams of 3 and 4 with ``<`` and ``>`` around;
two words in a row are a feature, too. Features are hashed to ``BUCKETS`` learned vectors, which start
at zero: what training never met weighs nothing. A document is the average of its features'
vectors; a softmax over the two labels is trained with plain stochastic gradient descent in numpy, one
document at a time, from a fixed seed.

The model is fitted on at most ``SAMPLE`` labelled rows outside the held-out fold, those with the
smallest hash of their id: a documented bound, so that fitting takes the same time at every size. It
bounds the rows, also where ids repeat, and a row's distinct buckets bound its bytes
(8 * ``BUCKETS`` at most). Their whole texts count. Every document is then scored in parallel. As the
score is linear in the average, each bucket's vector is folded into one number first, and a worker
keeps the sums of words it has met.

Rows whose label is neither 0 nor 1 are left out of fitting; without any row left every score is 0.5.
Null or empty texts get the score of the bias alone. A null id is never held out. Labels, lang,
source and id are not inputs. Repeated rows get equal results; extra columns are ignored, whatever
their names; an empty table gives no rows; texts of any length count whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS, DIM, SAMPLE, EPOCHS, RATE, SEED = 1 << 18, 10, 4000, 6, 0.4, 17
FOLDS, THRESHOLD, CACHE, LONG = 5, 0.3, 300_000, 64


def features(word: str) -> list[int]:
    """The buckets of a word: itself, then its n-grams in order."""
    w, crc = f"<{word}>", zlib.crc32
    if w.isascii():
        b = w.encode()
        return [crc(b, 1) % BUCKETS, *(crc(b[i : i + n]) % BUCKETS for n in (3, 4) for i in range(len(b) - n + 1))]
    return [crc(w.encode(), 1) % BUCKETS, *(crc(w[i : i + n].encode()) % BUCKETS for n in (3, 4) for i in range(len(w) - n + 1))]


def _hash(word: str) -> int:
    return zlib.crc32(word.encode(), 2)


def pairs(hashes: np.ndarray) -> np.ndarray:
    """The buckets of every two neighbours, from the words' hashes."""
    h = hashes.astype(np.uint64)
    return ((h[:-1] * np.uint64(0x9E3779B1) + h[1:] * np.uint64(0x85EBCA6B)) >> np.uint64(13)).astype(np.int64) % BUCKETS


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and how often each occurs."""
    words = (text or "").split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.float64)
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    parts = [(features(w), n) for w, n in counts.items()]
    hashes = {w: _hash(w) for w in counts}
    both = pairs(np.fromiter(map(hashes.__getitem__, words), np.int64, len(words)))
    ids = np.concatenate([*(f for f, _ in parts), both])
    n = np.r_[np.repeat([n for _, n in parts], [len(f) for f, _ in parts]), np.ones(len(both))]
    distinct, at = np.unique(ids, return_inverse=True)
    return distinct, np.bincount(at, n)


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def train(rows: list[tuple[np.ndarray, np.ndarray, int]]) -> tuple[np.ndarray, float]:
    """(folded weight per bucket, bias) from bags and labels, by stochastic gradient descent."""
    rng = np.random.default_rng(SEED)
    vectors, out, bias = np.zeros((BUCKETS, DIM)), rng.uniform(-1, 1, (DIM, 2)), np.zeros(2)
    rows = [(ids, n / n.sum(), y) for ids, n, y in rows if len(ids)]
    steps, done = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            ids, share, y = rows[k]
            rate = RATE * (1 - done / steps)
            done += 1
            mean = share @ vectors[ids]
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = out @ p
            out -= rate * np.outer(mean, p)
            bias -= rate * p
            # Shares sum to one, so a document's step is scaled by its number of distinct buckets.
            vectors[ids] -= rate * np.outer(share * len(ids), back)
    return (vectors @ (out[:, 1] - out[:, 0])).astype(np.float64), float(bias[1] - bias[0])


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, limit: int) -> DataFrame:
    """ids, counts (binary) and label of the rows to fit on."""
    chosen = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("_y"))
    chosen = chosen.where(F.col("_y").isin(0, 1) & F.col("_id").isNotNull() & ~held_out(F.col("_id"))).orderBy(F.xxhash64("_id"), "_id", "_y").limit(limit)
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_t"))
    rows = texts.join(F.broadcast(chosen), "_id")  # at most ``limit`` rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bags = [bag(t.as_py()) for t in b.column(1)]
            ids, n = [x.astype("<i4").tobytes() for x, _ in bags], [x.astype("<f4").tobytes() for _, x in bags]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary()), pa.array(n, pa.binary()), b.column(2)], ["_id", "ids", "n", "_y"])

    bags = rows.mapInArrow(run, "_id long, ids binary, n binary, _y int")
    return bags.orderBy(F.xxhash64("_id"), "_id", "_y", "ids", "n").limit(limit)  # ids may repeat


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", limit: int = SAMPLE) -> tuple[np.ndarray, float]:
    found = sample(docs, labels, id_col, text_col, label_col, limit).collect()
    found.sort(key=lambda r: (r._id, r._y, bytes(r.ids), bytes(r.n)))
    return train([(np.frombuffer(r.ids, "<i4").astype(np.int64), np.frombuffer(r.n, "<f4").astype(np.float64), r._y) for r in found])


class Scorer(dict):
    """Word to (sum of its features' weights, number of features, hash)."""

    def __init__(self, weights: np.ndarray, bias: float):
        super().__init__()
        self.weights, self.list, self.bias = weights, weights.tolist(), bias

    def __missing__(self, word: str) -> tuple[float, int, int]:
        w = self.list
        found = [w[i] for i in features(word)]
        value = (sum(found), len(found), _hash(word))
        if len(word) <= LONG:
            if len(self) >= CACHE:
                self.clear()
            self[word] = value
        return value

    def score(self, text: str | None) -> float:
        words = (text or "").split()
        z = self.bias
        if words:
            sums, sizes, hashes = zip(*map(self.__getitem__, words))
            both = pairs(np.array(hashes, np.int64))
            z += (sum(sums) + float(self.weights.take(both).sum())) / (sum(sizes) + len(both))
        return float(1 / (1 + np.exp(-z)))


def predict(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    known = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*known.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([scorer.score(t.as_py()) for t in b.column(1)], pa.float64())], ["_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_t")).mapInArrow(run, "_id long, score double")
    return rows.select(F.col("_id").alias(id_col), held_out(F.col("_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return predict(docs, fit(docs, labels))
