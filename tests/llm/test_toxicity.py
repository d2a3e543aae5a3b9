import random
import zlib

import numpy as np

from contigo.llm import toxicity
from pyspark.sql import functions as F


def brute_segments(s):
    """Maximal segments by definition: the best segment (shortest on ties), then left and right of it."""
    def go(a, b):
        best = max(((round(sum(s[i:j]), 9), i - j, -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=None)
        if best is None or best[0] <= 0:
            return []
        i, j = best[3], best[4]
        return [*go(a, i), (i, j), *go(j, b)]

    return go(0, len(s))


def test_segments():
    rng = random.Random(2)
    for _ in range(200):
        s = [round(rng.uniform(-3, 3), 3) for _ in range(rng.randint(0, 14))]
        assert [(a, b) for a, b, _ in toxicity.maximal_segments(s)] == brute_segments(s)


def test_fold(spark):
    ids = [0, 1, -5, 123456789, 10**15]
    got = spark.createDataFrame([(i,) for i in ids], "doc_id long").select(toxicity.fold(5).alias("f")).collect()
    assert [r.f for r in got] == [zlib.crc32(str(i).encode()) % 5 for i in ids]


def test_learns_and_marks(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    vocabulary = [word() for _ in range(400)]
    docs, labels = [], []
    for i in range(900):
        ws = [rng.choice(vocabulary) for _ in range(rng.randint(1, 150))]
        toxic = i % 7 == 0
        if toxic:
            for _ in range(rng.randint(2, 4)):
                ws.insert(rng.randrange(len(ws) + 1), rng.choice(["Zznasty!", "qqvile,", "ÉXXBAD"]))
        docs.append((i, " ".join(ws), 0.5))
        if i % 3:
            labels.append((i, int(toxic)))
    docs += [(2000, None, 1.0), (2001, "", 1.0), (2002, "éxxbad zznasty qqvile " * 3, 1.0), (2002, "éxxbad zznasty qqvile " * 3, 1.0)]
    d = spark.createDataFrame(docs, "doc_id long, text string, score double")
    lab = spark.createDataFrame([*labels, (5000, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.learn(d, lab, toxicity.fold(5) != 0)
    rows = toxicity.find_passages(d, model).collect()
    assert len(rows) == len(docs)
    by = {r.doc_id: r for r in rows}
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([by[i].predicted == (i % 7 == 0) for i in held]) > 0.98
    assert by[2000].predicted == by[2001].predicted == 0 and by[2002].predicted == 1
    text = dict((k, t) for k, t, _ in docs)[2002].encode()
    p = by[2002].passages[0]
    assert text[p.start : p.end].decode().startswith("éxxbad") and p.expected < 0.05
    assert toxicity.find_passages(d.limit(0), model).count() == 0
    kept = sorted(map(tuple, toxicity.keep_clean(d, model).collect()), key=str)
    assert kept == sorted((x for x in docs if not by[x[0]].predicted), key=str)
    none = toxicity.learn(d, lab.limit(0), F.lit(True))
    assert all(r.score < 1e-6 and r.predicted == 0 for r in toxicity.find_passages(d, none).collect())


def test_words_in_a_thousandth_of_documents(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    vocabulary, rare = [word() for _ in range(300)], [f"zq{a}{b}x" for a in "vwxyz" for b in "rstu"]
    docs, labels = [], []
    for i in range(8000):
        ws, toxic = [rng.choice(vocabulary) for _ in range(8)], i < 160
        if toxic:  # 20 words, each in 8 documents, and in no clean one
            ws.insert(rng.randrange(9), rare[i % 20])
        docs.append((i, " ".join(ws)))
        labels.append((i, int(toxic)))
    d, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.learn(d, lab, F.lit(True))
    new = [(i, " ".join([*rng.choices(vocabulary, k=8), *([rare[i]] if i < 20 else [])])) for i in range(200)]
    got = {r.doc_id: r.predicted for r in toxicity.find_passages(spark.createDataFrame(new, "doc_id long, text string"), model).collect()}
    assert sum(got[i] for i in range(20)) >= 18 and sum(got[i] for i in range(20, 200)) <= 2
    z = toxicity.evidence(np.array([180.0, 180.0, 16.0, 1.0]), 1800, np.array([0.0, 1.0, 0.0, 8.0]), 14200)
    assert z[0] > z[1] > toxicity.LEAST_Z and z[2] > toxicity.LEAST_Z > z[3]


def test_every_token_is_a_candidate(spark):
    signs = "abcdefghijklmnopqrstuvwxyz0123456789+-/=@_"
    stop_words = " ".join(a + b + c for a in signs for b in signs for c in signs[:38])  # over 65,536, in every text
    docs = [(i, f"{stop_words} {'zq' if i < 20 else 'en'} {i}") for i in range(48)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.learn(d, spark.createDataFrame([(i, int(i < 24)) for i in range(48)], "doc_id long, toxic int"), F.lit(True))
    assert (model.scores > 0).sum() == 1 and model.scores.max() > toxicity.LEAST_ODDS


def test_log_odds_with_their_prior(spark):
    """Scores of words against the formula over counts made by hand."""
    rng = random.Random(8)
    docs = [(i, " ".join([f"id{i}", *rng.sample(["aa", "bb", "cc", "dd"], 2), *(["zz"] if i % 6 == 0 and i % 4 or i % 97 == 0 else []), *(["yy"] if i % 6 and i % 3 or i % 50 == 0 else [])])) for i in range(900)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.learn(d, spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(900)], "doc_id long, toxic int"), F.lit(True))
    teach = {r.doc_id for r in d.where(F.pmod(F.shiftright(F.xxhash64("doc_id"), 20), 5) != 0).collect()}
    key = lambda w: int(toxicity.tokens(np.array([0, len(w)], np.int32), np.frombuffer(w.encode(), np.uint8))[3][0][1][0])
    score = dict(zip(model.keys.tolist(), model.scores.tolist()))
    n1, n0 = sum(i % 6 == 0 for i in teach), sum(i % 6 > 0 for i in teach)
    for w in ("zz", "yy", "aa"):
        y1, y0 = (sum(w in t.split() for i, t in docs if i in teach and (i % 6 == 0) == x) for x in (True, False))
        prior = toxicity.PRIOR * (sum(w in t.split() for _, t in docs) + 0.01) / 901
        odds = np.log((y1 + prior) / (n1 + toxicity.PRIOR - y1 - prior)) - np.log((y0 + prior) / (n0 + toxicity.PRIOR - y0 - prior))
        cells = [(y1, n1), (n1 - y1, n1), (y0, n0), (n0 - y0, n0)]
        share = [(y1 + y0) / (n1 + n0), 1 - (y1 + y0) / (n1 + n0)] * 2
        z = np.sqrt(2 * sum(c * np.log(c / (n * p)) for (c, n), p in zip(cells, share) if c))
        want = odds * (1 - (toxicity.SHRINK / z) ** 2) if abs(odds) >= toxicity.LEAST_ODDS and z > toxicity.LEAST_Z else None
        assert (want is None) == (w == "aa") and (want is None and key(w) not in score or abs(score[key(w)] - want) < 1e-9)
    assert score[key("zz")] > 1 > -1 > score[key("yy")]


def test_null_model():
    """lambda is a root of the null model's equation, K the most likely one on a fine grid."""
    rng = np.random.default_rng(1)
    q, s = np.array([0.002, 0.001, 0.003]), np.array([2.5, 4.0, -3.0])
    x = toxicity.null_rate(q, s)
    assert abs((q * np.exp(x * (s - toxicity.DRIFT))).sum() + (1 - q.sum()) * np.exp(-x * toxicity.DRIFT) - 1) < 1e-6
    assert toxicity.null_rate(np.zeros(0), np.zeros(0)) == 1.0


def test_null_size(spark):
    rng = np.random.default_rng(3)
    rate, least, k = 0.9, 2.0, 0.02
    words = rng.integers(20, 800, 4000)
    s = (np.log(k * words) - np.log(rng.exponential(size=4000))) / rate  # extreme values
    s = np.where(s < least, 0.0, s)
    df = spark.createDataFrame([(int(n), float(rate * x - np.log(n))) for n, x in zip(words, s)], "words long, best double")
    got = np.exp(toxicity.null_size(df, rate, least))
    grid = np.linspace(0.005, 0.08, 3000)
    some = s > 0
    like = [np.log(g) * some.sum() - g * (words * np.exp(-rate * np.where(some, s, least))).sum() for g in grid]
    assert abs(got - grid[int(np.argmax(like))]) < 1e-3 and abs(got - k) < 0.003


def test_registered_query(spark):
    """held_out and predicted of op4_toxicity on the whole smallest table; scores do better than chance by far."""
    rows = {r.doc_id: r for r in toxicity.op4_toxicity(spark, "/root/testdata/sf0.01").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").count()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert len(rows) == docs
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1
    held = [i for i in labels if i in rows and rows[i].held_out]
    good = [(rows[a].score > rows[b].score) + 0.5 * (rows[a].score == rows[b].score) for a in held if labels[a] == 1 for b in held if labels[b] == 0]
    assert np.mean(good) > 0.75


def test_long_texts_and_null_ids(spark):
    words = "en bo ka li mu " * 40_000
    docs = [(i, f"plain {i} words here") for i in range(60)] + [(100 + i, f"zqzqzq {i} words here") for i in range(30)] + [(None, "zqzqzq zqzqzq"), (500, words), (501, words + "zqzqzq zqzqzq zqzqzq")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.learn(d, spark.createDataFrame([(i, int(i >= 100)) for i in [*range(60), *range(100, 130)]], "doc_id long, toxic int"), F.lit(True))
    got = {r.doc_id: r for r in toxicity.find_passages(d, model).collect()}
    assert len(got) == len(docs) and got[None].predicted == 1 and got[500].predicted == 0 and got[501].words == 200_003
    kept = {r.doc_id for r in toxicity.keep_clean(d, model).collect()}
    assert None not in kept and 500 in kept


def test_logistic_of_classes_parted_cleanly():
    """Converges to the least penalised loss, on clean, noisy and one-sided classes."""
    rng = np.random.default_rng(5)
    for clean in (True, False):
        best = np.concatenate([rng.normal(-4, 1, 3000), rng.normal(8, 1, 300)])
        y = (best > 2).astype(float)
        if not clean:
            y[::40] = 1 - y[::40]
        x = np.column_stack([best, np.log1p(np.maximum(best, 0) // 2)])
        w = np.array(toxicity.logistic(x, y))
        x1 = np.column_stack([np.ones(len(x)), x])
        p = 1 / (1 + np.exp(-x1 @ w))
        assert np.abs(x1.T @ (y - p) - np.array([1e-6, 1e-2, 1e-2]) * w).max() < 1e-2  # the gradient is gone
        assert ((p >= 0.5) == (best > 2)).mean() > 0.999
