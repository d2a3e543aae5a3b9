"""Toxic passages by maximum-scoring segments over token log-odds.

Learning (``learn``):

1. Tokens are runs of bytes other than white space and marks, in lower case, and their
   beginnings of 4 to 8 bytes. Labelled rows: the ``SAMPLE`` rows (a documented bound) with
   the least hash of doc_id of those the caller lets it learn from, equal texts once.
   Four fifths of them teach token scores, the rest calibrates.
2. Tokens in ``LEAST_TEXTS`` toxic sample texts or more are candidates, all of them: the sample
   bounds their number. One pass over all documents counts how many texts hold each: these
   corpus counts are the Dirichlet prior of the log-odds ratio of toxic and other texts.
3. Tokens whose log-odds are ``LEAST_ODDS`` or more away from 0 score them with their sign, shrunk by
   1 - (SHRINK / z) ** 2 where z, the standard errors by a likelihood ratio of the two counts (none in
   other texts is evidence, not a lack of it), is over ``LEAST_Z``; all others score nothing (in a large
   sample toxic texts' mere length makes small log-odds significant). Of a token's keys the one
   furthest from 0 counts, and every token also costs ``DRIFT``.

Scoring (``find_passages``): the linear-time scan of Ruzzo and Tompa gives all maximal
scoring segments of a text. Under the null model (tokens drawn with their rates in teaching texts
that aren't toxic), scores have an extreme-value distribution (Karlin and Altschul): a segment of
score S in a text of N tokens is expected exp(log K + log N - lambda * S) times, lambda
being the root of E[exp(lambda * score)] = 1. K is the most likely one given the best segments of
the teaching texts that aren't toxic; texts without any are known to have less than the least
score of a token. Segments with an expectation below ``LEVEL`` are passages. A logistic curve over
the best segment's log expectation and the number of passages, fitted on the calibration rows,
gives the score.

Edge cases: null and empty texts have no tokens and the lowest score; very long texts are scanned
once, whole; repeated rows and rows with equal or null ids are scored each; ties between equally
good keys don't change a score; labels that are null or for rows that don't exist teach nothing;
without toxic labels every score is 0; an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lean, read_table, text_docs
from .repeats import CHUNK_BYTES, _buffers, _groups, _power, _sums

SAMPLE = 20_000
LEAST_TEXTS = 3
LEAST_Z = 2.0
SHRINK = 2.0
LEAST_ODDS = 2.0
DRIFT = 0.02
PRIOR = 10.0
LEVEL = 0.05
BEGINNINGS = (4, 5, 6, 7, 8)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GAP = np.zeros(256, bool)
_GAP[[32, *range(9, 14), *b".,!?;:#$%&*|\"'()[]{}<>"]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def tokens(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """First byte, end and text of each token, and its keys: (tokens that have such a key, hashes)."""
    at = (offsets - offsets[0]).astype(np.int64)
    low = _LOWER[data[offsets[0] : offsets[-1]]]
    n = len(low)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none, []
    latin = np.flatnonzero((low[:-1] == 0xC3) & (low[1:] >= 0x80) & (low[1:] <= 0x9E) & (low[1:] != 0x97)) + 1
    low[latin] += 32
    word = ~_GAP[low]
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    first = np.flatnonzero(word & (~np.concatenate([[False], word[:-1]]) | edge[:-1]))
    last = np.flatnonzero(word & (~np.concatenate([word[1:], [False]]) | edge[1:])) + 1
    sums, inverse = _sums(low), _power(n)[1][first]
    base, long = sums[first], last - first
    keys = [(np.arange(len(first)), _mix((sums[last] - base) * inverse))]
    for k in BEGINNINGS:
        some = np.flatnonzero(long >= k)
        keys.append((some, _mix((sums[first[some] + k] - base[some]) * inverse[some] + np.uint64(k * 0x5851F42D4C957F2D & (1 << 64) - 1))))
    return first, last, np.searchsorted(at, first, "right") - 1, keys


class Lookup:
    """Places of hashes in a sorted table, -1 where they aren't in it."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(hashes >> np.uint64(44)).astype(np.int64)] = True

    def find(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices into x that are in the table, and their places there."""
        some = np.flatnonzero(self.maybe[(x >> np.uint64(44)).astype(np.int64)])
        if not len(some) or not len(self.hashes):
            return some[:0], some[:0]
        place = np.minimum(np.searchsorted(self.hashes, x[some]), len(self.hashes) - 1)
        ok = self.hashes[place] == x[some]
        return some[ok], place[ok]


def _count_new(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to (key, n): texts that hold each key, by chunk."""
    for batch in batches:
        offsets, data = _buffers(batch.column(1))
        for a, b in _groups(offsets, CHUNK_BYTES):
            _, _, text, keys = tokens(offsets[a : b + 1], data)
            if not keys:
                continue
            t, k = np.concatenate([text[i] for i, _ in keys]), np.concatenate([h for _, h in keys])
            order = np.lexsort((t, k))
            t, k = t[order], k[order]
            new = np.concatenate([[True], (k[1:] != k[:-1]) | (t[1:] != t[:-1])])
            found, n = np.unique(k[new], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["key", "n"])


def _count_known(table):
    """(doc_id, text) to (place, n), one row for each key of the table and task; and place -1: texts, -2: tokens."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(table.value)
        total, texts, words = np.zeros(len(lookup.hashes), np.int64), 0, 0
        for batch in batches:
            offsets, data = _buffers(batch.column(1))
            texts += batch.num_rows
            for a, b in _groups(offsets, CHUNK_BYTES):
                first, _, text, keys = tokens(offsets[a : b + 1], data)
                words += len(first)
                for some, h in keys:
                    i, place = lookup.find(h)
                    pair = np.unique(text[some[i]] * len(total) + place)
                    total += np.bincount(pair % len(total), minlength=len(total)) if len(pair) else 0
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, [-1, -2])), pa.array(np.append(total[some], [texts, words]))], ["place", "n"])

    return run


@dataclass
class Model:
    """Sorted key hashes and their scores; the null model's lambda and log K; the logistic curve."""

    keys: np.ndarray
    scores: np.ndarray
    rate: float = 1.0
    log_k: float = 0.0
    curve: tuple = (-50.0, 0.0, 0.0)

    def chance(self, best: np.ndarray, passages: np.ndarray) -> np.ndarray:
        a, b, c = self.curve
        return 1 / (1 + np.exp(-np.clip(a + b * np.clip(best, -30, 10) + c * np.log1p(passages), -50, 50)))


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, end, score), by Ruzzo and Tompa's linear scan."""
    out: list[tuple[int, int, float, float]] = []  # first, end, sum before, sum after
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        first, end, left, right = i, i + 1, before, total
        while True:
            k = len(out) - 1
            while k >= 0 and out[k][2] >= left:
                k -= 1
            if k < 0 or out[k][3] >= right:
                out.append((first, end, left, right))
                break
            first, left = out[k][0], out[k][2]
            del out[k:]
    return [(a, b, r - x) for a, b, x, r in out]


def _best_keys(scores: np.ndarray, lookup: Lookup, keys: list[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    """For each of n tokens the place of its key whose score is furthest from 0, -1 without one."""
    out, far = np.full(n, -1), np.zeros(n)
    for some, h in keys:
        i, place = lookup.find(h)
        token, size = some[i], np.abs(scores[place])
        more = size > far[token]
        out[token[more]], far[token[more]] = place[more], size[more]
    return out


def _null_counts(model):
    """(doc_id, text) to (place, n): tokens whose score is that key's, and place -1: all tokens."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        lookup, total, words = Lookup(m.keys), np.zeros(len(m.keys), np.int64), 0
        for batch in batches:
            offsets, data = _buffers(batch.column(1))
            for a, b in _groups(offsets, CHUNK_BYTES):
                first, _, _, keys = tokens(offsets[a : b + 1], data)
                best = _best_keys(m.scores, lookup, keys, len(first))
                words += len(first)
                total += np.bincount(best[best >= 0], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(total[some], words))], ["place", "n"])

    return run


def _scored(model):
    """(doc_id, text) to (doc_id, words, best, passages)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        lookup = Lookup(m.keys)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]))
        for batch in batches:
            offsets, data = _buffers(batch.column(1))
            for a, b in _groups(offsets, CHUNK_BYTES):
                first, last, text, keys = tokens(offsets[a : b + 1], data)
                of = np.searchsorted(text, np.arange(b - a + 1))
                n = np.diff(of)
                best, found = np.minimum(-m.log_k - np.log(np.maximum(n, 1)), 0), [[] for _ in range(b - a)]  # no segment: no evidence
                of_key = _best_keys(m.scores, lookup, keys, len(first))
                if (of_key >= 0).any():
                    value = np.where(of_key >= 0, m.scores[of_key], 0.0)
                    places = np.flatnonzero(value)
                    for t in np.unique(text[places]):
                        mine = places[(lo := np.searchsorted(places, of[t])) : lo + np.searchsorted(places[lo:], of[t + 1])].tolist()
                        row, at = [], of[t]
                        for p in mine:  # tokens without a score between two with one cost DRIFT each
                            row += [-DRIFT * (p - at), value[p] - DRIFT]
                            at = p + 1
                        top = -math.inf
                        for x, y, s in maximal_segments(row):
                            log_e = m.log_k + math.log(n[t]) - m.rate * s
                            top = max(top, -log_e)
                            if log_e < math.log(LEVEL):
                                p, q = mine[x // 2], mine[(y - 1) // 2]
                                begin = int(offsets[a + t] - offsets[a])
                                found[t].append({"start": int(first[p]) - begin, "end": int(last[q]) - begin, "score": s, "expected": math.exp(log_e)})
                        best[t] = top if top > -math.inf else best[t]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(n), pa.array(best), pa.array(found, kind)], ["doc_id", "words", "best", "passages"])

    return run


_SCORED = "doc_id long, words long, best double, passages array<struct<start int, end int, score double, expected double>>"


def null_rate(q: np.ndarray, s: np.ndarray) -> float:
    """The positive root of E[exp(lambda * score)] = 1."""
    if not len(q):
        return 1.0
    mean = lambda x: float((q * np.exp(x * (s - DRIFT))).sum() + (1 - q.sum()) * math.exp(-x * DRIFT)) - 1
    lo, hi = 1e-6, 1e-6
    while mean(hi) <= 0 and hi < 50:
        lo, hi = hi, 2 * hi
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if mean(mid) <= 0 else (lo, mid)
    return max(lo, 0.05)


def null_size(scored: DataFrame, rate: float, least: float) -> float:
    """log K from texts of the null model, scored with K = 1: the most likely K for best segments S of N tokens, whose chance of staying
    below x is exp(-K * N * exp(-rate * x)); texts without a segment have stayed below the least score."""
    gain = F.col("best") + F.log(F.greatest("words", F.lit(1)).cast("double"))  # rate * S
    some = gain > 1e-9
    r = scored.where("words > 0").agg(F.count_if(some).alias("n"), F.sum(F.col("words") * F.exp(-F.when(some, gain).otherwise(F.lit(rate * least)))).alias("s")).first()
    return math.log((r.n + 0.5) / r.s) if r.s else 0.0


def logistic(x: np.ndarray, y: np.ndarray) -> tuple:
    """Logistic curve over columns of x with a small ridge, by Newton's method; steps that don't improve are halved, as classes may be parted cleanly."""
    x = np.column_stack([np.ones(len(x)), x])
    w, ridge = np.zeros(x.shape[1]), np.array([1e-6] + [1e-2] * (x.shape[1] - 1))
    loss = lambda w: float(np.logaddexp(0, np.where(y > 0, -1, 1) * (x @ w)).sum() + (ridge * w * w).sum() / 2)
    now = loss(w)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + np.diag(ridge + 1e-9), x.T @ (y - p) - ridge * w)
        size = 1.0
        while size > 1e-9 and not loss(w + size * step) < now:
            size /= 2
        if size <= 1e-9 or now - loss(w + size * step) < 1e-9 * now:
            break
        w = w + size * step
        now = loss(w)
    return tuple(w.tolist())


def evidence(y1: np.ndarray, n1: float, y0: np.ndarray, n0: float) -> np.ndarray:
    """Standard errors by which y1 of n1 texts hold a token more often than y0 of n0: the signed root of the likelihood ratio, which grows as y0 falls, down to none."""
    share = (y1 + y0) / max(n1 + n0, 1)
    part = lambda seen, meant: np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-300) / np.maximum(meant, 1e-300)), 0.0)
    g = part(y1, n1 * share) + part(n1 - y1, n1 * (1 - share)) + part(y0, n0 * share) + part(n0 - y0, n0 * (1 - share))
    return np.sign(y1 - n1 * share) * np.sqrt(np.maximum(2 * g, 0))


def learn(docs: DataFrame, labels: DataFrame, allowed: Column, sample: int = SAMPLE) -> Model:
    """A model from the labels (doc_id, toxic) of rows that ``allowed`` (over doc_id) lets it learn from."""
    spark, texts = docs.sparkSession, text_docs(docs)
    some = labels.where(allowed & F.col("toxic").isNotNull()).select("doc_id", (F.col("toxic") == 1).alias("toxic"))
    some = some.withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(sample)  # SAMPLE rows of three small columns at most
    rows = texts.join(F.broadcast(some), "doc_id")
    # of equal texts the row with the least hash, so that reruns learn the same
    rows = rows.groupBy(F.xxhash64("text").alias("t"), "toxic").agg(F.min_by(F.struct("doc_id", "text", "h"), F.struct("h", "doc_id")).alias("row")).select("row.*", "toxic").cache()
    teach = rows.where(F.pmod(F.shiftright("h", 20), 5) != 0)
    pick = lambda df, toxic: df.where(F.col("toxic") if toxic else ~F.col("toxic")).select("doc_id", "text")
    try:
        fresh = pick(teach, True).mapInArrow(_count_new, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_TEXTS)
        top = fresh.collect()
        if not top:
            return Model(np.zeros(0, np.uint64), np.zeros(0))
        keys = np.array([r.key for r in top], np.int64).view(np.uint64)
        order = np.argsort(keys)
        keys, y1 = keys[order], np.array([r.n for r in top], float)[order]
        table = spark.sparkContext.broadcast(keys)

        def counts(df: DataFrame) -> tuple[np.ndarray, float, float]:
            got = df.mapInArrow(lean(_count_known(table)), "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()
            out, rest = np.zeros(len(keys)), {-1: 0, -2: 0}
            for r in got:
                if r.place >= 0:
                    out[r.place] = r.n
                else:
                    rest[r.place] = r.n
            return out, rest[-1], rest[-2]

        y0, n0, words0 = counts(pick(teach, False))
        every, n_every, _ = counts(texts)
        n1 = pick(teach, True).count()
        prior = PRIOR * (every + 0.01) / (n_every + 1)
        odds = np.log((y1 + prior) / (n1 + PRIOR - y1 - prior)) - np.log((y0 + prior) / (n0 + PRIOR - y0 - prior))
        z = evidence(y1, n1, y0, n0)
        take = (np.abs(z) > LEAST_Z) & (np.abs(odds) >= LEAST_ODDS)
        model = Model(keys[take], odds[take] * (1 - (SHRINK / z[take]) ** 2))
        if take.any():
            clean = pick(teach, False)
            null = {r.place: r.n for r in clean.mapInArrow(_null_counts(spark.sparkContext.broadcast(model)), "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()}
            seen = np.array([null.get(k, 0) for k in range(len(model.keys))]) + prior[take]
            model.rate = null_rate(seen / max(null.get(-1, 0) + prior[take].sum(), 1), model.scores)
            model.log_k = null_size(clean.mapInArrow(_scored(spark.sparkContext.broadcast(model)), _SCORED), model.rate, float(np.abs(model.scores).min()) - DRIFT)
        shared = spark.sparkContext.broadcast(model)
        held = rows.where(F.pmod(F.shiftright("h", 20), 5) == 0)
        got = pick(held, True).mapInArrow(_scored(shared), _SCORED).select("best", F.size("passages").alias("p"), F.lit(1.0).alias("y"))
        got = got.union(pick(held, False).mapInArrow(_scored(shared), _SCORED).select("best", F.size("passages").alias("p"), F.lit(0.0).alias("y"))).collect()
        if got:
            x = np.array([(min(max(r.best, -30), 10), math.log1p(r.p)) for r in got])
            y = np.array([r.y for r in got])
            model.curve = logistic(x, y)
            if min(model.curve[1:]) < 0:  # neither may count against a text's being toxic
                model.curve = (*logistic(x[:, :1], y), 0.0)
        return model
    finally:
        rows.unpersist()


def find_passages(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, words, best (minus the log expectation of the best segment), passages, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = text_docs(docs).select("doc_id", "text").mapInArrow(lean(_scored(shared)), _SCORED)
    a, b, c = (F.lit(float(v)) for v in model.curve)
    best = F.least(F.greatest(F.col("best"), F.lit(-30.0)), F.lit(10.0))
    line = F.least(F.greatest(a + b * best + c * F.log1p(F.size("passages")), F.lit(-50.0)), F.lit(50.0))
    return out.withColumn("score", 1 / (1 + F.exp(-line))).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs with a score under 0.5, in one pass without a join."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(names.index("text")).fill_null("")
            best, passages = [], []
            for got in _scored(shared)([pa.RecordBatch.from_arrays([batch.column(names.index("doc_id")), text], ["doc_id", "text"])]):
                best.append(got.column(2).to_numpy())
                passages.append(np.diff(got.column(3).offsets.to_numpy()))
            if best:
                yield batch.filter(pa.array(shared.value.chance(np.concatenate(best), np.concatenate(passages)) < 0.5))

    return docs.mapInArrow(lean(run), docs.schema)


def fold(mod: int) -> Column:
    """crc32 of doc_id as text, modulo mod."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % mod


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    out = find_passages(docs, learn(docs, labels, fold(5) != 0))
    return out.select("doc_id", (fold(5) == 0).alias("held_out"), "score", "predicted", F.size("passages").alias("n_passages"))
