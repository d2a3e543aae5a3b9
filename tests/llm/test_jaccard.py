import random
import re

import numpy as np
import pyarrow as pa
import pytest

from contigo.llm import jaccard


def sets_of(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(ws[i : i + 5]) for i in range(len(ws) - 4)} if len(ws) >= 5 else {tuple(ws)} if ws else set()


def brute(texts):
    sets, up = [sets_of(t) for t in texts], list(range(len(texts)))

    def find(v):
        while up[v] != v:
            v = up[v]
        return v

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("block, exact", [(2048, False), (7, False), (64, True)])
def test_against_brute_force(spark, monkeypatch, block, exact):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdéF") for _ in range(rng.randint(1, 4)))
    texts = [None, "", " \n", "One two", "one  TWO", "one two three", "a b c d e", "A b\tc d\ne"]
    for _ in range(12):
        base = [word() for _ in range(rng.choice([6, 12, 25, 60, 200, 800]))]
        for _ in range(rng.randint(1, 9)):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 30))):
                own[rng.randrange(len(own))] = word()
            own += [word() for _ in range(rng.choice([0, 0, len(own) // 6]))]
            texts += [" ".join(own)] * rng.choice([1, 1, 2])
    shared = [word() for _ in range(40)]
    for _ in range(40):
        texts.append(" ".join(shared + [word() for _ in range(rng.choice([5, 12, 14, 30]))]))
    monkeypatch.setattr(jaccard, "BLOCK", block)
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n int")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(df, exact).collect()}
    want = brute(texts)
    assert [got[i] for i in range(len(texts))] == want
    kept = {r.doc_id for r in jaccard.keep_one_each(df).collect()} if block == 7 else {c for _, c in want}
    assert kept == {c for _, c in want}


def tile(key, keys):
    """A tile of one block: sets of the same 50 elements, each a component of its own."""
    n = len(keys)
    lists = lambda x, kind: pa.array(x.tolist(), pa.list_(kind))
    columns = [pa.array([key] * n)] + [pa.array([0] * n, pa.int32())] * 3 + [pa.array(range(n)), pa.array([50] * n), pa.array(range(n)), pa.array([True] * n), pa.array([True] * n)]
    return pa.RecordBatch.from_arrays([*columns, lists(np.ones((n, 16), np.int64), pa.int64()), lists(keys >> 48, pa.int16())], ["key", "band", "i", "j", "rep", "n", "c", "own", "second", "bits", "marks"])


def test_pairs_come_from_the_first_tiles_that_they_share():
    rng = np.random.default_rng(3)
    keys = rng.integers(-(1 << 63), 1 << 63, (3, 64))
    keys[1, 5:] = keys[0, 5:]  # 0 and 1 share 59 tiles, 2 one with either
    keys[2, 60] = keys[0, 60]
    for at in (1, 2, 3):  # other keys with the same mark
        keys[2, at] = keys[0, at] ^ 1
    made = {}
    for at in range(64):
        for key in set(keys[:, at].tolist()):
            some = np.flatnonzero(keys[:, at] == key)
            batch = tile(key, keys[some])
            for out in jaccard._tiles(False)([batch.set_column(4, "rep", pa.array(some))]):
                for pair in zip(out["a"].to_pylist(), out["b"].to_pylist()):
                    made.setdefault(pair, []).append(at)
    assert made == {(0, 1): [5, 6, 7, 8], (0, 2): [60], (1, 2): [60]}


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.jaccard_components(df).count() == 0


def test_hot_copies_repeated_and_null_ids(spark):
    """Many copies of one text, rows that share an id, null ids, a very long text."""
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(i, "one text that many rows hold word for word", "a") for i in range(1500)]
    rows += [(3000, "another text of its own kind with words", "a"), (3000, "another text of its own kind with words", "b"), (None, "another text of its own kind with words", "c"), (None, "alone but without any id at all", "d"), (3001, long, "e"), (3002, long + " more", "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n string")
    got = sorted((r.doc_id, r.component_id) for r in jaccard.jaccard_components(df).collect() if r.doc_id is not None)
    assert got == sorted([(i, 0) for i in range(1500)] + [(3000, 3000)] * 2 + [(3001, 3001), (3002, 3001)])
    kept = sorted((str(r.doc_id), r.n) for r in jaccard.keep_one_each(df).collect())
    assert kept == [("0", "a"), ("3000", "a"), ("3001", "e"), ("None", "c"), ("None", "d")]
