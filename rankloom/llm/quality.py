"""Document quality: random-indexing word vectors, pooled, and a small network.

A word is seen as its letters, its signs and its shape. Each of these has a fixed
sparse random index vector; its word vector adds the index vectors of its neighbours.
A document is the mean and the spread of its vectors. A two-layer network in numpy
turns that into a probability, calibrated by a temperature on rows it did not learn.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import text_slices, tidy_task, worker_cache
from rankloom.session import stash

PARTS = 3  # a word's letters, signs and shape


class WordParts(dict):
    """Buckets of a word's letters, signs and shape in one number, by its bytes; emptied when it is full."""

    def __init__(self, buckets: int, most: int = 150_000):
        self.buckets, self.most = buckets, most

    def __missing__(self, word: bytes) -> int:
        text = word.decode()
        letters = "".join(c for c in text if c.isalpha())
        signs = "".join(c for c in text if not c.isalnum())
        size = len(letters)
        case = "none" if not size else "upper" if letters.isupper() and size > 1 else "title" if letters[0].isupper() else "lower"
        shape = f"{case} {min(size, 8)} {any(c.isdigit() for c in text)}"
        found = 0
        for part in ("w" + letters.lower(), "s" + signs[:8], "f" + shape):
            found = found * self.buckets + zlib.crc32(part.encode()) % self.buckets
        if len(word) <= 128:
            if len(self) >= self.most:
                self.clear()
            self[word] = found
        return found


@worker_cache(2)
def _parts(buckets: int) -> WordParts:
    return WordParts(buckets)


def _buckets(texts: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket numbers of all words of all texts, words of each text)."""
    words = [t.encode().split() for t in texts]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    every = list(chain.from_iterable(words))
    found = np.fromiter(map(_parts(buckets).__getitem__, every), np.int64, len(every))
    return np.stack([found // buckets**2, found // buckets % buckets, found % buckets], axis=1), counts


def index_vectors(buckets: int, size: int, entries: int = 6, seed: int = 7) -> np.ndarray:
    """Fixed sparse vectors of +1 and -1, one for each bucket."""
    rng = np.random.default_rng(seed)
    out = np.zeros((buckets, size), np.float32)
    places = np.argsort(rng.random((buckets, size)), axis=1)[:, :entries]
    np.put_along_axis(out, places, rng.choice(np.float32([-1, 1]), (buckets, entries)), axis=1)
    return out


def neighbour_sums(texts: list[str], buckets: int, index: np.ndarray, window: int) -> np.ndarray:
    """For each bucket, the index vectors of the letters of words up to ``window`` places away, added up."""
    parts, counts = _buckets(texts, buckets)
    owner = np.repeat(np.arange(len(counts)), counts)
    out = np.zeros_like(index, np.float64)
    for step in range(1, window + 1):
        near = owner[step:] == owner[:-step]
        left, right = parts[:-step][near], parts[step:][near]
        for here, there in ((left, right), (right, left)):
            for part in range(PARTS):
                pair, times = np.unique(here[:, part] * buckets + there[:, 0], return_counts=True)
                np.add.at(out, pair // buckets, index[pair % buckets] * times[:, None])
    return out


@dataclass
class QualityModel:
    """Everything a task needs to score texts, a few megabytes whatever the corpus."""

    buckets: int
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float

    def logits(self, features: np.ndarray) -> np.ndarray:
        hidden = np.tanh(((features - self.mean) / self.scale) @ self.first + self.first_bias)
        return hidden @ self.second + self.second_bias

    def probabilities(self, features: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(features) / self.temperature)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def pooled(texts: list[str], buckets: int, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the vectors of each whole text, and the logarithm of its words; zeros if it has none."""
    parts, counts = _buckets(texts, buckets)
    size = vectors.shape[1]
    out = np.zeros((len(texts), 2 * size + 1), np.float32)
    squares = vectors**2
    ends = np.cumsum(counts)
    for i, (end, n) in enumerate(zip(ends.tolist(), counts.tolist())):
        if n:
            used, times = np.unique(parts[end - n : end], return_counts=True)
            share = (times / (n * PARTS)).astype(np.float32)
            mean = share @ vectors[used]
            out[i, :size] = mean
            out[i, size:-1] = np.sqrt(np.maximum(share @ squares[used] - mean**2, 0))
            out[i, -1] = np.log1p(n)
    return out


def _network(x: np.ndarray, y: np.ndarray, hidden: int, epochs: int, seed: int) -> tuple:
    """Two layers by Adam on mini-batches, with weight decay; (weights and biases)."""
    rng = np.random.default_rng(seed)
    w = [
        rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)),
        np.zeros(hidden),
        rng.normal(0, 1 / np.sqrt(hidden), hidden),
        np.zeros(1),
    ]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in w]
    step, batch = 0, 128
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        for a in range(0, len(x), batch):
            rows = order[a : a + batch]
            h = np.tanh(x[rows] @ w[0] + w[1])
            error = (_sigmoid(h @ w[2] + w[3]) - y[rows]) / len(rows)
            back = np.outer(error, w[2]) * (1 - h**2)
            gradients = [x[rows].T @ back + 1e-4 * w[0], back.sum(0), h.T @ error + 1e-4 * w[2], np.array([error.sum()])]
            step += 1
            rate = 3e-3 * (1 - epoch / epochs) + 1e-4
            for p, g, (m, v) in zip(w, gradients, moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[0], w[1], w[2], float(w[3][0])


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of the least log loss, from a fine grid."""
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 120))

    def loss(t: float) -> float:
        p = np.clip(_sigmoid(logits / t), 1e-9, 1 - 1e-9)
        return -float(np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)))

    return float(min(grid, key=loss)) if len(y) else 1.0


def train(
    df: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "label",
    sample_rows: int = 20_000,
    buckets: int = 8192,
    size: int = 64,
    window: int = 2,
    hidden: int = 32,
    epochs: int = 30,
    seed: int = 7,
) -> QualityModel:
    """Fit on the documents of at most ``sample_rows`` labelled ids, those of the smallest hashes, with their whole texts.

    ``labels`` has an id and a label, 0 or 1; null ids and labels are left out, of
    several labels of an id the greatest counts, and null texts teach nothing. Word
    vectors are added up in eight tasks; the driver receives one sum a task and one pooled
    vector a sampled row. A fifth of the sample sets the temperature only. Without
    rows of both labels the score is the share of label 1 (0.5 without rows).
    """
    marked = labels.filter(F.col(id).isNotNull() & F.col(label).isNotNull())
    marked = marked.groupBy(F.col(id).alias("id")).agg(F.max(F.col(label).cast("int")).alias("y"))
    chosen = marked.withColumn("h", F.xxhash64(F.col("id").cast("string"))).orderBy("h", "id").limit(sample_rows)
    rows = df.filter(F.col(text).isNotNull()).select(F.col(id).alias("id"), F.col(text).alias("text"))
    sample = rows.join(F.broadcast(stash(chosen, "quality-ids")), "id").select("h", "y", "text")  # at most sample_rows ids
    tasks = 8
    kept = stash(sample.repartition(tasks, "h"), "quality-sample")
    index = index_vectors(buckets, size, seed=seed)

    @tidy_task
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((buckets, size))
        for batch in batches:
            for _, _, texts in text_slices(batch.column(0)):
                total += neighbour_sums(texts, buckets, index, window)
        yield pa.RecordBatch.from_arrays([pa.array([total.astype(np.float32).tobytes()], pa.binary())], ["sums"])

    vectors = np.zeros((buckets, size), np.float32)
    # few tasks, however many files the sample has: each sends a whole table of sums
    for row in kept.select("text").coalesce(tasks).mapInArrow(sums, "sums binary").collect():
        vectors += np.frombuffer(row["sums"], np.float32).reshape(buckets, size)
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors = (index / np.linalg.norm(index, axis=1, keepdims=True) + vectors / np.maximum(norm, 1)).astype(np.float32)

    @tidy_task
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_slices(batch.column(2)):
                x = [row.tobytes() for row in pooled(texts, buckets, vectors)]
                columns = [batch.column(0)[a:b], batch.column(1)[a:b], pa.array(x, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["h", "y", "x"])

    found = kept.select("h", "y", "text").mapInArrow(features, "h long, y int, x binary").toPandas().sort_values(["h", "x"])
    y = (found["y"].to_numpy(float) > 0).astype(float)
    x = np.array([np.frombuffer(v, np.float32) for v in found["x"]], np.float64).reshape(len(y), 2 * size + 1)
    width = 2 * size + 1
    if len(set(y)) < 2:
        share = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
        zero = np.zeros((width, hidden)), np.zeros(hidden), np.zeros(hidden), float(np.log(share / (1 - share)))
        return QualityModel(buckets, vectors, np.zeros(width), np.ones(width), *zero, 1.0)
    # copies of a text fall on the same side, so that the temperature is set on unseen texts
    aside = np.array([zlib.crc32(v) % 5 == 0 for v in found["x"]])
    if aside.all() or len(set(y[~aside])) < 2:
        aside[:] = False
    mean, scale = x[~aside].mean(0), x[~aside].std(0) + 1e-3
    weights = _network((x[~aside] - mean) / scale, y[~aside], hidden, epochs, seed)
    model = QualityModel(buckets, vectors, mean, scale, *weights, 1.0)
    model.temperature = _temperature(model.logits(x[aside]), y[aside])
    return model


def score(
    df: DataFrame,
    model: QualityModel,
    id: str = "doc_id",
    text: str = "text",
    keep: tuple[Column, ...] = (),
    keep_text: bool = False,
) -> DataFrame:
    """(id, text if wanted, *keep, score) of every whole text, one row for each row; a null text is empty.

    The score is the calibrated probability of label 1. An empty text has the
    features of no words and a score like any other. Null ids and repeated rows
    stay; columns not named in ``keep`` are left out, whatever their names.
    """
    held = df.sparkSession.sparkContext.broadcast(model)
    kept = df.select(F.col(id).alias("id"), F.col(text).alias("text"), *keep)
    others = ["text"] * keep_text + kept.columns[2:]
    places = [1] * keep_text + list(range(2, len(kept.columns)))  # of the columns that pass through

    @tidy_task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            for a, b, texts in text_slices(batch.column(1)):
                p = m.probabilities(pooled([t or "" for t in texts], m.buckets, m.vectors))
                rest = [batch.column(i)[a:b] for i in places]
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], *rest, pa.array(p)], ["id", *others, "score"])

    fields = [f"`{c}` {kept.schema[c].dataType.simpleString()}" for c in ["id", *others]]
    return kept.mapInArrow(run, ", ".join([*fields, "score double"])).withColumnRenamed("id", id)
