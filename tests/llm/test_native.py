import hashlib
import random
import re
from collections import Counter

from contigo.llm import chat, mixing, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_features(text):
    text = text or ""
    ws = WORD.findall(text)
    at = Counter(tuple(ws[i : i + 5]) for i in range(len(ws) - 4))
    covered = {i + k for i in range(len(ws) - 4) if at[tuple(ws[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_features(spark):
    rng = random.Random(3)
    texts = [None, "", " \n\t", "a b c d e a b c d e", "x\ny\nx\n\n\n#*", "é\x1cü ñ\x85z", "w " * 3000]
    for _ in range(60):
        texts.append("".join(rng.choice(["a", "b", "ü", " ", " ", "\n", "\r", "#"]) for _ in range(rng.randint(0, 120))))
    df = spark.createDataFrame([(i, t, 0, "z") for i, t in enumerate(texts)], "doc_id long, text string, n_words int, lines string")
    rows = quality_rules.quality_rules(df).collect()
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == brute_features(texts[r.doc_id]), texts[r.doc_id]
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert quality_rules.quality_rules(df.limit(0)).count() == 0


def test_chat_round_trip_and_mask(spark):
    nasty = ["", None, "<|im_end|>", "<\\|x", "<\\\\|<|", "a\nb", "<|im_start|>assistant\n", "\\", "<|im_end|>\n<|im_start|>"]
    roles = ["user", "assistant", "tool\n<|im_start|>", "a\\nb\\", "system", "\\b\\n"]
    rows = [(c, t, roles[(c + t) % len(roles)], nasty[(c * 3 + t) % len(nasty)], "x") for c in range(12) for t in range(9)] + [(None, 0, None, "hi", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    out = chat.read_chats(chat.render_chats(df)).collect()
    assert len(out) == 13
    for r in out:
        want = sorted((t, role or "user", text or "") for c, t, role, text, _ in rows if c == r.conv_id)
        assert [(x.role, x.text) for x in r.turns] == [w[1:] for w in want]
        assert r.formatted == "".join(s.text for s in r.segments)
    assert chat.render_chats(df.limit(0)).count() == 0


def test_events_fold(spark):
    log = [
        (1, 0, 0, "message", "user", "hi"), (1, 1, 1, "delta", "assistant", "He"), (1, 2, 1, "delta", None, "llo"),
        (1, 3, 2, "message", "user", "more"), (1, 4, 1, "regenerate", "assistant", None), (1, 5, 1, "delta", "assistant", "Good"),
        (1, 6, 1, "delta", None, " day"), (1, 7, 0, "edit", "user", "hello"), (1, 8, 2, None, "user", "next"),
    ]
    df = spark.createDataFrame(log, "conv_id long, seq long, turn long, op string, role string, text string")
    got = [(r.turn, r.role, r.text) for r in chat.fold_events(df).orderBy("turn").collect()]
    assert got == [(0, "user", "hello"), (1, "assistant", "Good day"), (2, "user", "next")]


def water(sizes, weights, share, most):
    total, left, target = sum(sizes) * share, set(range(len(sizes))), [0.0] * len(sizes)
    while True:
        free = total - sum(most * sizes[i] for i in range(len(sizes)) if i not in left)
        w = sum(weights[i] for i in left)
        over = {i for i in left if free * weights[i] / w > most * sizes[i]}
        if not over:
            break
        left -= over
    return [free * weights[i] / w if i in left else most * sizes[i] for i in range(len(sizes))]


def test_mixing(spark):
    rng = random.Random(5)
    rows, names = [], ["a", "b", "c", "d", "é", None]
    for i in range(3000):
        s = names[min(int(rng.expovariate(1)), 5)]
        rows.append((i, "w " * rng.randint(0, 300), s, 1))
    rows += [(7, None, None, 1), (7, "a b", "a", 1), (7, "a b", "a", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = mixing.mix_decisions(df).collect()
    assert len(got) == len(rows)
    size = Counter()
    for _, t, s, _ in rows:
        size[s] += len((t or "").split())
    sizes = [size[s] for s in names]
    want = water(sizes, [5, 2, 1, 5, 2, 1], 1.5, 2)
    taken, by_size = Counter(), {(r.source_size): r.target for r in got}
    for s, t in zip(sizes, want):
        assert abs(by_size[s] - t) < 1e-6 * t
    for r in got:
        assert 0 <= r.copies <= 2 and r.copies in (int(r.target / r.source_size), int(r.target / r.source_size) + 1, 1)
        taken[r.source_size] += r.copies * r.size
    for s, t in zip(sizes, want):
        assert abs(taken[s] - t) <= 300
    key = lambda r: (r.doc_id, r.size, r.copies)
    assert sorted(map(key, got)) == sorted(map(key, mixing.mix_decisions(df.repartition(7)).collect()))
    out = mixing.repeat_documents(df, mixing.mix_decisions(df)).collect()
    assert len(out) == sum(r.copies for r in got) and out[0].asDict().keys() == dict(zip(df.columns, df.columns)).keys()
    assert mixing.mix_decisions(df.limit(0)).count() == 0


def test_chat_digest(spark, tmp_path):
    spark.createDataFrame([(0, 0, "assistant", "a<|b")], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    r = {x.conv_id: x for x in chat.op7_chat_formatting(spark, str(tmp_path)).collect()}
    assert r[0].loss_sha256 == hashlib.sha256(b"a<|b").hexdigest() and r[0].loss_chars == 4
    assert r[-1].n_turns == 2


def test_chat_query_folds_its_events(spark, tmp_path, monkeypatch):
    rows = [(c % 3 if c % 4 else None, t % 4, ["user", None, "assistant"][t % 3], ["b", None, "<|x", "a"][(c + t) % 4]) for c in range(8) for t in range(9)]
    rows += rows[:5]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    folded, fold = [], chat.fold_events
    monkeypatch.setattr(chat, "fold_events", lambda log: folded.append(log) or fold(log))
    out = {x.conv_id: x for x in chat.op7_chat_formatting(spark, str(tmp_path)).collect()}
    assert len(folded) == 1 and folded[0].count() == len(rows) + 2
    assert out.keys() == {None, -1, 0, 1, 2}
    for c in (None, 0, 1, 2):
        want = sorted((t, role or "user", text or "") for x, t, role, text in rows if x == c)
        assert out[c].n_turns == len(want)
        assert out[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in want).encode()).hexdigest()
        assert out[c].loss_sha256 == hashlib.sha256("".join(t for _, r, t in want if r == "assistant").encode()).hexdigest()
