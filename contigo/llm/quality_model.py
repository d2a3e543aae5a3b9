"""Quality classifier: random-indexing word vectors pooled by document, and a two-layer network.

1. Words (runs of other bytes than ASCII white space, A-Z in lower case) are hashed to
   ``LEXICAL`` slots, their shapes (capitals, digits, symbols, marks, length, same as the word before) to
   ``SHAPES`` more. Each slot has a fixed sparse ternary index vector of ``DIM`` numbers with
   ``SPARSE`` entries of +1 and as many of -1.
2. Random indexing: one pass over all documents adds to each slot's context vector the index
   vectors of its neighbours, words with words, shapes with shapes. Tasks add up in a table of
   fixed size, Spark sums the tables; the sums are whole numbers, so every run gives the same.
3. A document is the mean of its words' context vectors (of unit length), the mean of its
   shapes', the logarithm of its length and its share of different words.
4. The network (tanh layer, logistic output) learns in numpy on the driver from ``SAMPLE``
   labelled rows (a documented bound: those with the least hash of doc_id, of the rows the
   caller allows). A fifth of them only fit the temperature that calibrates its probabilities.

Edge cases: null and empty texts have the mean document of no words, all zeros; repeated
rows are scored each; null labels and labels of rows that don't exist teach nothing; with
labels of one kind or none, every score is that kind's share (0.5 without any); an empty
table gives no rows; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, text_docs
from .repeats import CHUNK_BYTES, _buffers, _groups, _power, _sums
from .toxicity import fold

LEXICAL, SHAPES, DIM, SPARSE = 8192, 512, 32, 2
SLOTS = LEXICAL + SHAPES
SAMPLE = 8_000
HIDDEN, EPOCHS = 32, 400
FEATURES = 2 * DIM + 2

_rng = np.random.default_rng(6)
#: The places of each slot's +1 (first SPARSE) and -1 entries.
_INDEX = np.argsort(_rng.random((SLOTS, DIM)), axis=1)[:, : 2 * SPARSE].astype(np.int64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
#: What a byte tells of its word's shape.
_CLASS = np.zeros(256, np.uint8)
_CLASS[97:123] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 4
_CLASS[list(b"#$%&*<>{}[]=_~^")] = 8
_CLASS[list(b"!?")] = 16
_CLASS[list(b"|")] = 32


def slots(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lexical slot and shape slot of each word, and each text's first word (texts + 1 of them)."""
    at = (offsets - offsets[0]).astype(np.int64)
    raw = data[offsets[0] : offsets[-1]]
    n = len(raw)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(at), np.int64)
    low = _LOWER[raw]
    word = ~_SPACE[low]
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    first = np.flatnonzero(word & (~np.concatenate([[False], word[:-1]]) | edge[:-1]))
    last = np.flatnonzero(word & (~np.concatenate([word[1:], [False]]) | edge[1:])) + 1
    of = np.searchsorted(first, at)
    if not len(first):
        return first, first, of
    sums = _sums(low)
    h = (sums[last] - sums[first]) * _power(n)[1][first]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    lexical = (h >> np.uint64(40)).astype(np.int64) % LEXICAL
    kind = np.bitwise_or.reduceat(_CLASS[raw], first).astype(np.int64)
    long = last - first
    capitals = ((kind & 3) == 2) & (long > 1)
    same = np.concatenate([[False], h[1:] == h[:-1]])
    shape = (kind >> 2) & 15 | capitals * 16 | same * 32 | np.digitize(long, (3, 6, 10)) * 64
    return lexical, LEXICAL + shape + 256 * (kind == 0), of


def _contexts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to (slot, d0, d1, ...): a task's sums of neighbours' index vectors."""
    total = np.zeros(SLOTS * DIM, np.int64)

    def add(slot: np.ndarray, near: np.ndarray) -> None:
        nonlocal total
        base = slot * DIM
        for k in range(2 * SPARSE):
            seen = np.bincount(base + _INDEX[near, k], minlength=len(total))
            total += seen if k < SPARSE else -seen

    for batch in batches:
        offsets, data = _buffers(batch.column(1))
        for a, b in _groups(offsets, CHUNK_BYTES * 4):
            lexical, shape, of = slots(offsets[a : b + 1], data)
            if len(lexical) < 2:
                continue
            inside = np.ones(len(lexical), bool)
            inside[of[(of > 0) & (of < len(lexical))]] = False  # a text's first word has no neighbour before it
            left, right = np.flatnonzero(inside[1:]), np.flatnonzero(inside[1:]) + 1
            for x in (lexical, shape):
                add(x[left], x[right])
                add(x[right], x[left])
    some = np.flatnonzero(total.reshape(SLOTS, DIM).any(axis=1))
    table = total.reshape(SLOTS, DIM)[some]
    yield pa.RecordBatch.from_arrays([pa.array(some), *(pa.array(table[:, d].copy()) for d in range(DIM))], ["slot", *(f"d{d}" for d in range(DIM))])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Context vectors of all slots, scaled to unit length."""
    names = [f"d{d}" for d in range(DIM)]
    sums = text_docs(docs).mapInArrow(_contexts, "slot long, " + ", ".join(f"{x} long" for x in names))
    out = np.zeros((SLOTS, DIM))
    for r in sums.groupBy("slot").agg(*[F.sum(x).alias(x) for x in names]).collect():  # SLOTS rows at most
        out[r[0]] = r[1:]
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)).astype(np.float32)


@dataclass
class Model:
    vectors: np.ndarray
    constant: float | None = None
    mean: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES))
    scale: np.ndarray = field(default_factory=lambda: np.ones(FEATURES))
    layers: tuple = ()
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((x - self.mean) / self.scale @ w1 + b1) @ w2 + b2

    def chance(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def pooled(vectors: np.ndarray, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """The feature rows of texts."""
    lexical, shape, of = slots(offsets, data)
    n = np.diff(of)
    out = np.zeros((len(n), FEATURES))
    some = np.flatnonzero(n)
    if len(some):
        count = n[some]
        text = np.repeat(np.arange(len(some)), count)
        for k, x in enumerate((lexical, shape - LEXICAL)):
            width = (LEXICAL, SHAPES)[k]
            pair, times = np.unique(text * width + x, return_counts=True)  # a word that a text repeats is added once, as often as it is there
            rows = vectors[pair % width + (0, LEXICAL)[k]] * times[:, None]
            begin = np.searchsorted(pair // width, np.arange(len(some)))
            out[some, k * DIM : (k + 1) * DIM] = np.add.reduceat(rows, begin, axis=0) / count[:, None]
            if not k:
                out[some, 2 * DIM + 1] = np.diff(np.append(begin, len(pair))) / count
        out[some, 2 * DIM] = np.log1p(count)
    return out


def _pooled(model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = model.value
        for batch in batches:
            offsets, data = _buffers(batch.column(1))
            for a, b in _groups(offsets, CHUNK_BYTES):
                x = pooled(vectors, offsets[a : b + 1], data)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "x"])

    return run


def _scores(model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        for batch in batches:
            offsets, data = _buffers(batch.column(1))
            for a, b in _groups(offsets, CHUNK_BYTES):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(m.chance(pooled(m.vectors, offsets[a : b + 1], data)))], ["doc_id", "score"])

    return run


def _train(x: np.ndarray, y: np.ndarray) -> tuple:
    """Weights of the two layers, by Adam on all rows with weight decay."""
    rng = np.random.default_rng(60)
    w = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
    for t in range(1, EPOCHS + 1):
        h = np.tanh(x @ w[0] + w[1])
        d = (1 / (1 + np.exp(-np.clip(h @ w[2] + w[3], -40, 40))) - y) / len(y)
        back = d[:, None] * w[2] * (1 - h * h)
        for k, g in enumerate((x.T @ back + 3e-4 * w[0], back.sum(axis=0), h.T @ d + 3e-4 * w[2], np.array([d.sum()]))):
            m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
            w[k] = w[k] - 0.01 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return tuple(w)


def _temperature(z: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss on rows that the network has not seen."""
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 141))
    loss = [np.mean(np.logaddexp(0, z / t) - y * z / t) for t in grid]
    return float(grid[int(np.argmin(loss))])


def learn(docs: DataFrame, labels: DataFrame, allowed: Column, sample: int = SAMPLE) -> Model:
    """A model from the labels (doc_id, quality) of rows that ``allowed`` (over doc_id) lets it learn from."""
    spark, texts = docs.sparkSession, text_docs(docs)
    model = Model(word_vectors(docs))
    some = labels.where(allowed & F.col("quality").isNotNull()).select("doc_id", (F.col("quality") == 1).alias("y"), F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id").limit(sample)
    rows = texts.join(F.broadcast(some.select("doc_id")), "doc_id", "left_semi").mapInArrow(_pooled(spark.sparkContext.broadcast(model.vectors)), "doc_id long, x array<double>")
    by_id: dict[int, list] = {}
    for r in rows.collect():  # SAMPLE rows of FEATURES numbers at most, but for rows that share a doc_id
        by_id[r.doc_id] = r.x
    known = [(r.h, r.y, by_id[r.doc_id]) for r in some.collect() if r.doc_id in by_id]
    if not known or len({y for _, y, _ in known}) < 2:
        model.constant = float(np.mean([y for _, y, _ in known])) if known else 0.5
        return model
    x, y = np.array([k[2] for k in known]), np.array([k[1] for k in known], float)
    held = np.array([(k[0] >> 20) % 5 == 0 for k in known])
    if held.all() or not held.any():
        held[:] = False
    model.mean, model.scale = x[~held].mean(axis=0), x[~held].std(axis=0) + 1e-3
    model.layers = _train((x[~held] - model.mean) / model.scale, y[~held])
    if held.any():
        model.temperature = _temperature(model.logits(x[held]), y[held])
    return model


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score: the chance of good quality."""
    return text_docs(docs).mapInArrow(_scores(docs.sparkSession.sparkContext.broadcast(model)), "doc_id long, score double")


def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    out = score_quality(docs, learn(docs, labels, fold(4) != 2))
    return out.select("doc_id", (fold(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
