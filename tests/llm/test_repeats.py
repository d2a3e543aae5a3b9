import hashlib
import random
from collections import Counter

import pytest

from contigo.llm import repeats


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    n = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if n[d[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        kept = bytes(x for x, g in zip(d, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("most, heads", [(8000, 100_000), (3, 150)])
def test_against_brute_force(spark, most, heads):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, long = prose(100), prose(400)
    texts = [None, "", "short", "x" * 399, "x" * 400, "x" * 401, "ab" * 700, prose(300), long, long, long[:900] + prose(40) + long[900:], "abc " * 300]
    for _ in range(25):
        texts.append(prose(rng.randint(0, 200)) + passage[: rng.choice([300, 399, 420, 520])] + prose(rng.randint(0, 60)))
        texts.append(prose(30) + passage[rng.randint(0, 60) :] + prose(rng.randint(0, 3)))
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, token string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(df, keep_bytes=False, most_runs=most, part_heads=heads).collect()}
    want = brute(texts, repeats.LENGTH)
    assert [got[i] for i in range(len(texts))] == want
    assert sum(w[1] > 0 for w in want) > 10
    assert repeats.remove_repeats(df.limit(0)).count() == 0


def test_sliding_min():
    import numpy as np

    x = np.random.default_rng(0).integers(0, 50, 1000).astype(np.uint64)
    for w in (1, 7, 337, 1000):
        assert (repeats._sliding_min(x, w) == [x[j : j + w].min() for j in range(1000 - w + 1)]).all()


def test_equal_heads_compares_bytes():
    import numpy as np

    rng = random.Random(3)
    for length in (8, 13, 24, 40):
        data = bytes(rng.choice(b"ab") for _ in range(3000))
        at = np.array(sorted(rng.sample(range(3000 - length), 900)))
        token = np.array([rng.randrange(2) for _ in at])
        order, starts = repeats.equal_heads(repeats._words(np.frombuffer(data, np.uint8)), at, token, length)
        got = sorted(sorted(g.tolist()) for g in np.split(order, starts[1:])) if len(order) else []
        want = {}
        for k, (a, t) in enumerate(zip(at.tolist(), token.tolist())):
            want.setdefault((t, data[a : a + length]), []).append(k)
        assert got == sorted(g for g in want.values() if len(g) > 1)


def test_registered_query(spark):
    """op10_repeats on the whole smallest table, against every 400-byte string of it."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    data = [(r.text or "").encode() for r in rows]
    n = Counter(hash(d[i : i + 400]) for d in data for i in range(len(d) - 399))
    got = {r.doc_id: r for r in repeats.op10_repeats(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(rows)
    for r, d in zip(rows, data):
        gone = bytearray(len(d))
        for i in range(len(d) - 399):
            if n[hash(d[i : i + 400])] > 1:
                gone[i : i + 400] = b"\x01" * 400
        kept = bytes(x for x, g in zip(d, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        x = got[r.doc_id]
        assert (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) == (len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    assert sum(x.n_removed > 0 for x in got.values()) > 10


def test_null_ids_clashing_columns_and_long_texts(spark):
    rng = random.Random(1)
    long = "".join(rng.choice("abcdefgh ") for _ in range(300_000))
    rows = [(None, long[:500], 1), (1, long, 2), (2, "", 3), (3, long[1000:2000], 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    got = {r.doc_id: r.n_removed for r in repeats.remove_repeats(df, keep_bytes=False).collect()}
    assert got == {None: 0, 1: 1000, 2: 0, 3: 1000}
