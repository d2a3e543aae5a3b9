import random
import zlib
from array import array

from contigo.llm.packing import Packer, pack_documents, word_tokenizer


def brute_choice(level, size, w):
    best = None
    for h in range(0, w - size + 1):
        if h and not level[h]:
            continue
        after = list(level)
        if h:
            after[h] -= 1
        if h + size < w:
            after[h + size] += 1
        cost = sum(x * x for x in after[1:w])
        if best is None or cost <= best[0]:
            best = (cost, h)
    return best[1]


def test_choice_is_sum_of_squares():
    rng, w = random.Random(1), 24
    packer = Packer(w)
    for k in range(400):
        size = rng.randint(1, w - 1)
        assert packer.choose(size) == brute_choice(packer.level, size, w)
        list(packer.add(k, 0, array("I", range(size)).tobytes()))


def test_every_id_once_little_padding():
    rng, w = random.Random(2), 64
    packer, docs, out = Packer(w, max_open=20), {}, []
    for k in range(300):
        docs[k] = array("I", [rng.randint(0, 9999) for _ in range(rng.choice([1, 3, 40, 63, 64, 65, 200]))])
        out += packer.add(k, 0, docs[k].tobytes())
    out += packer.finish()
    got = {}
    for pieces in out:
        n = sum(len(i) // 4 for _, _, i in pieces)
        assert n == w or n & (n - 1) == 0
        for k, start, ids in pieces:
            got.setdefault(k, []).append((start, ids))
    for k, ids in docs.items():
        assert b"".join(x for _, x in sorted(got[k])) == ids.tobytes()
        at = 0
        for s, x in sorted(got[k]):
            assert s == at
            at += len(x) // 4


def test_documents(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(word_tokenizer())
    texts = [None, "", "Hello  World's #1!", "a\x1cb \xa0 c  d", "x " * 5000, "<|endoftext|> it", "x " * 5000]
    df = spark.createDataFrame([(i, x, "k") for i, x in enumerate(texts)], "doc_id long, text string, sequence_id string")
    rows = pack_documents(df, word_tokenizer()).collect()
    for i, x in enumerate(texts):
        want = t.encode(x or "", add_special_tokens=False).ids + [1]
        own = sorted((r.start, r) for r in rows if r.doc_id == i)
        assert [y for _, r in own for y in r.ids] == want
        assert all(r.doc_tokens == len(want) and r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(array("I", r.ids).tobytes()) for _, r in own)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for o, n in sorted(pieces):
            assert o == at
            at += n
        assert at <= 2048
    assert pack_documents(df.limit(0), word_tokenizer()).count() == 0


def test_merging_by_rank_is_merging_by_pair():
    import json

    from contigo.llm.packing import WordTokens, _by_rank

    model = json.load(open(word_tokenizer()))["model"]
    rank = {tuple(m): k for k, m in enumerate(model["merges"])}
    assert len({a + b for a, b in rank}) == len(rank)
    for a, b in rank:  # every token's own text gives the token again, by pairs
        t = a + b
        end = t.endswith("</w>")
        parts = list(t.removesuffix("</w>"))
        if end:
            parts[-1] += "</w>"
        while len(parts) > 1:
            k = min(range(len(parts) - 1), key=lambda i: rank.get((parts[i], parts[i + 1]), 1 << 30))
            assert (parts[k], parts[k + 1]) in rank, t
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        assert parts == [t]
    tokens, rng = WordTokens(word_tokenizer()), random.Random(1)
    words = list({"".join(rng.choice("abcdefghijklmnopqrstuvwxyzßàéñöü") for _ in range(rng.randint(1, 14))) for _ in range(20000)})
    assert tokens._stem_ids(words) == tokens._ids(words)
