import random
import sys
from array import array
from collections import Counter

import pytest

import corpus_pipeline
from contigo.llm import pii, toxicity
from contigo.llm.packing import word_tokenizer


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng, d = random.Random(6), str(tmp_path_factory.mktemp("corpus"))
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    words, rows, labels = [word() for _ in range(500)], [], []
    for i in range(500):
        ws = [rng.choice(words) for _ in range(rng.randint(8, 120))]
        if i % 9 == 0:
            for _ in range(4):
                ws.insert(rng.randrange(len(ws)), rng.choice(["zznasty", "qqvile", "xxbad"]))
        elif i > 20 and i % 10 == 1:
            ws = rows[-3][1].split()
            ws[0] = "changed"
        elif i % 10 == 2:
            ws.insert(3, f"me{i}@mail.example.com")
        rows.append((i, " ".join(ws), "en", f"s{i % 3}", None))
        labels.append((i, 1, int(bad(rows[-1][1]))))
    rows += [(900, None, None, None, None), (901, "", "en", "s0", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def bad(text):
    return any(w in text.split() for w in ("zznasty", "qqvile", "xxbad"))


def sets(text):
    ws = (text or "").lower().split()
    return {tuple(ws[i : i + 5]) for i in range(len(ws) - 4)} if len(ws) > 4 else {tuple(ws)} - {()}


def test_stages(spark, corpus, tmp_path):
    from tokenizers import Tokenizer

    docs, before = spark.read.parquet(f"{corpus}/documents.parquet"), None
    for k, (name, f) in enumerate(corpus_pipeline.STAGES):
        f(spark, docs, corpus).write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        old = {r.doc_id: r for r in docs.collect()}
        rows = out.collect()
        new = {r.doc_id: r for r in rows}
        if k < 4:
            assert out.columns == docs.columns
        if name == "toxicity":
            assert set(new) == {i for i, r in old.items() if not bad(r.text or "")} and all(new[i] == old[i] for i in new)
        elif name == "jaccard":
            up, ids, own = {i: i for i in old}, sorted(old), {i: sets(r.text) for i, r in old.items()}
            for a in ids:
                for b in ids:
                    if b < a and own[a] and own[b] and 4 * len(own[a] & own[b]) >= 3 * len(own[a] | own[b]):
                        x, y = a, b
                        while up[x] != x:
                            x = up[x]
                        while up[y] != y:
                            y = up[y]
                        up[max(x, y)] = min(x, y)
            assert set(new) == {i for i in ids if up[i] == i} and len(new) < len(old)
        elif name == "pii":
            assert set(new) == set(old)
            for i, r in new.items():
                assert r.text == (None if old[i].text is None else pii.surrogates(old[i].text, pii.Mapping(pii.DEMO_KEY))[0])
            assert any(new[i].text != old[i].text for i in new)
        elif name == "mixing":
            n = Counter(r.doc_id for r in rows)
            assert all(n[i] <= 2 and (i in n or old[i].text) for i in old) and all(r == old[r.doc_id] for r in rows)
            before = n
        else:
            t = Tokenizer.from_file(word_tokenizer())
            want, got = Counter(), Counter()
            for i, c in before.items():
                want.update([*t.encode(old[i].text or "", add_special_tokens=False).ids, 1] * c)
            for r in rows:
                got.update(r.ids)
            assert got == want and sum(r.length for r in rows) == sum(want.values())
        docs = out


def test_run_and_registration(spark, corpus):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"].__wrapped__ is corpus_pipeline.run and "pipeline" not in entry.oracle_sql()
    rows = corpus_pipeline.run(spark, corpus).collect()
    assert rows and {r.doc_id for r in rows} <= set(range(902)) and array("I", rows[0].ids)
    assert "contigo.llm" in sys.modules and toxicity.fold


def test_workers_give_memory_back(spark, monkeypatch):
    """Workers stay for the stages that follow, beside the heap of their executor: each stage's function gives freed memory back when a task ends, and surrogates come in small batches."""
    import numpy as np
    import pyarrow as pa

    from contigo.llm import common, packing, pii, toxicity

    df = spark.createDataFrame([(1, "a b", 3)], "doc_id long, text string, n_chars int")
    sent, given = [], []
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, *a, **b: sent.append(f) or self)
    monkeypatch.setattr(packing, "TaskContext", type("T", (), {"get": classmethod(lambda c: c), "partitionId": lambda: 0}))
    toxicity.keep_clean(df, toxicity.Model(np.zeros(0, np.uint64), np.zeros(0)))
    pii.with_surrogates(df, b"k")
    packing.pack_documents(df, packing.word_tokenizer())
    monkeypatch.setattr(common, "give_back", lambda: given.append(1), raising=False)
    batch = pa.RecordBatch.from_arrays([pa.array(range(2500)), pa.array(["call 555"] * 2500), pa.array([8] * 2500, pa.int32())], ["doc_id", "text", "n_chars"])
    out = [list(f(iter([batch][: f is sent[1]]))) for f in sent]
    assert len(sent) == len(given) == 3
    assert sum(b.num_rows for b in out[1]) == 2500 and max(b.num_rows for b in out[1]) <= 1000
    with_rest = sent[1](iter([batch]))
    next(with_rest)
    with_rest.close()  # a task that ends early, as below a limit
    assert len(given) == 4
