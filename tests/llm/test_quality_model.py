import random
import zlib

import numpy as np

from contigo.llm import quality_model as q
from contigo.llm.toxicity import fold
from pyspark.sql import functions as F


def brute_contexts(texts):
    """Sums of neighbours' index vectors, one word at a time."""
    index = np.zeros((q.SLOTS, q.DIM))
    for s in range(q.SLOTS):
        index[s, q._INDEX[s, : q.SPARSE]] = 1
        index[s, q._INDEX[s, q.SPARSE :]] = -1
    out = np.zeros((q.SLOTS, q.DIM))
    for t in texts:
        data = np.frombuffer((t or "").encode(), np.uint8)
        lexical, shape, _ = q.slots(np.array([0, len(data)]), data)
        for x in (lexical, shape):
            for i in range(len(x)):
                for j in (i - 1, i + 1):
                    if 0 <= j < len(x):
                        out[x[i]] += index[x[j]]
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def test_word_vectors(spark):
    texts = [None, "", "one", "a b A b\nc#1 DD ee ee", "é è!! | |", "x " * 50]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, slot int").repartition(3)
    assert np.allclose(q.word_vectors(df), brute_contexts(texts), atol=1e-6)


def test_learns(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    docs, labels = [], []
    for i in range(800):
        ws = [rng.choice(words) for _ in range(rng.randint(5, 120))]
        kind = i % 4
        if kind == 0:
            ws = [w.upper() + "!!" for w in ws] if i % 8 else [w + "###" for w in ws]
        docs.append((i, " ".join(ws), 1.0))
        if i % 3:
            labels.append((i, int(kind != 0)))
    docs += [(9000, None, 1.0), (9001, "", 1.0), (9001, "", 1.0)]
    d = spark.createDataFrame(docs, "doc_id long, text string, score double")
    lab = spark.createDataFrame([*labels, (7777, 1), (0, None)], "doc_id long, quality int")
    model = q.learn(d, lab, fold(4) != 2)
    rows = q.score_quality(d, model).collect()
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 for r in rows)
    by = {r.doc_id: r.score for r in rows}
    held = [i for i in range(800) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([(by[i] >= 0.7) == (i % 4 != 0) for i in held]) > 0.97
    again = {r.doc_id: r.score for r in q.score_quality(d.repartition(5), q.learn(d.repartition(3), lab, fold(4) != 2)).collect()}
    assert all(abs(again[k] - v) < 1e-9 for k, v in by.items())
    assert q.score_quality(d.limit(0), model).count() == 0
    assert {r.score for r in q.score_quality(d, q.learn(d, lab.limit(0), F.lit(True))).collect()} == {0.5}
