"""Packing documents into fixed windows of tokens by the online sum-of-squares rule.

``pack_documents`` tokenises each document, appends an end token and places it:

* a document of W tokens or more first fills whole windows of its own;
* what remains (under W tokens) goes to the fill level h for which the sum over levels of
  N(h)**2 grows least, N(h) being the number of open windows filled up to h. The level array
  holds N, one stack per level holds the windows; h = 0 opens a window. Ties go to the fuller
  window. This is the online rule of Csirik, Johnson, Kenyon, Orlin, Shor and Weber.

Each input partition is a packing block of its own, so nothing is shuffled and a lost task
is simply run again with the same result. When a block ends (or holds too many open windows)
the windows still open are closed by cutting: the emptiest are poured into the fullest. The
last one is cut along the powers of two of its length, as such sequences need no padding.

Memory of a task: the open windows (``max_open`` at most) and a bounded cache of words. Both go when the task ends, as its
worker stays for later tasks and stages, several to an executor.

Edge cases: null or empty text is the end token alone; repeated rows are packed each; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import gc
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .common import lean, read_table, text_docs

WINDOW = 2048
END_ID = 1
MAX_OPEN = 4096
#: Words, and words without case and marks, whose ids a worker remembers; at these numbers it forgets all and starts again.
CACHE_WORDS = 600_000
CACHE_STEMS = 500_000
#: Texts that are tokenised together.
GROUP = 64
_FEW = "\x1c\x1d\x1e\x1f"
_MARKS = ".,!?;:#$%&*|"
_LETTERS = re.compile("[a-zß-öø-ÿ]+").fullmatch


def _by_rank(path: str):
    """The file's merges for a faster library that merges bytes by the rank of what they give, with the id of each
    rank and whether it ends a word. Words end in a zero byte, which joins the byte before it first, as the file's
    ``</w>`` is part of a word's last symbol from the start. As every token of the file comes from one merge only,
    and its own text gives it again, merging by result and merging by pair are the same."""
    import json

    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in printable)}
    ends = {b: c + "</w>" for c, b in byte_of.items()}
    raw = lambda t: bytes(byte_of[c] for c in t.removesuffix("</w>")) + b"\0" * t.endswith("</w>")
    order = [(bytes([b]), next_) for b, next_ in sorted((b, c) for c, b in byte_of.items())]
    order += [(bytes([b, 0]), ends[b]) for b in range(1, 256)]
    order += [(raw(a + b), a + b) for a, b in model["merges"]]
    to_id = np.array([model["vocab"].get(t, 0) for _, t in order], "<u4")
    bpe = tiktoken.Encoding("ranks", pat_str="[^\1]+", mergeable_ranks={b: k for k, (b, _) in enumerate(order)}, special_tokens={})
    return bpe, to_id, np.array([b[-1:] == b"\0" and len(b) > 1 for b, _ in order])


def _plain(text: str) -> bool:
    """Whether Python's lower case is the tokenizer's: Latin-1 text without special tokens, whose case counts."""
    if not text.isascii():
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
    return "<|" not in text


class WordTokens:
    """Token ids of a text, as little-endian unsigned 32-bit numbers.

    The tokenizer drops white space and never merges across it, so a text's ids are those of
    its white-space-separated parts in turn; the ids of a part are remembered. A part that
    is new and made of lower- or upper-case Latin-1 letters, with marks after them or not, is
    two pieces to the tokenizer: the letters in lower case, and the marks. Such letters are
    encoded many at a time by ``_by_rank``; the token that ends each word tells the words' ids apart.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.known, self.stems = Tokenizer.from_file(path), {}, {}
        self.bpe, self.to_id, self.ends_word = _by_rank(path)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. Call it with many texts at once."""
        split = [(t.lower() if _plain(t) else t).split() for t in texts]
        known = self.known
        ids = [list(map(known.get, parts)) for parts in split]
        missing: set[str] = set()
        for parts, got in zip(split, ids):
            if None in got:
                missing.update([w for w, x in zip(parts, got) if x is None])
        if missing:
            self._learn(missing)
        out = [b"".join(map(known.__getitem__, parts) if None in got else got) for parts, got in zip(split, ids)]
        for k, text in enumerate(texts):
            if any(c in text for c in _FEW):  # split() takes these as white space, the tokenizer does not
                out[k] = self._ids([text])[0]
        if len(known) > CACHE_WORDS:
            known.clear()
        return out

    def _learn(self, words: set[str]) -> None:
        known, stems, split, other = self.known, self.stems, [], []
        if len(stems) > CACHE_STEMS:
            stems.clear()
        new, marks = set(), {""}
        for w in words:
            low = w.lower()
            stem = low.rstrip(_MARKS)
            if stem.isalpha() and (stem.isascii() or _LETTERS(stem)):
                mark = low[len(stem) :]
                split.append((w, stem, mark))
                if stem not in stems:
                    new.add(stem)
                marks.add(mark)
            else:
                other.append(w)
        new = list(new)
        stems.update(zip(new, self._stem_ids(new)))
        marks = [m for m in marks if m not in stems]
        stems.update(zip(marks, self._ids(marks)))
        for w, stem, mark in split:
            known[w] = stems[stem] + stems[mark] if mark else stems[stem]
        if other:
            known.update(zip(other, self._ids(other)))

    def _stem_ids(self, words: list[str]) -> list[bytes]:
        if not words:
            return []
        ranks = np.array(self.bpe.encode_ordinary("\0\1".join(words) + "\0"))
        ids, ends = self.to_id[ranks], np.flatnonzero(self.ends_word[ranks]) + 1
        if len(ends) != len(words):
            return self._ids(words)
        whole, at = ids.tobytes(), [0, *(4 * ends).tolist()]
        return [whole[a:b] for a, b in zip(at, at[1:])]

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class Packer:
    """Sum-of-squares packing of (key, start, ids) pieces; closed windows come out as lists of pieces."""

    def __init__(self, window: int = WINDOW, max_open: int = MAX_OPEN):
        self.window, self.max_open = window, max_open
        self.level = np.zeros(window + 1, np.int64)  # N(h); N(0) and N(window) stay 0
        self.stacks: dict[int, list[list]] = {}
        self.n_open = 0

    def choose(self, size: int) -> int:
        """Fill level to place a piece of so many tokens in."""
        n, w = self.level, self.window
        grow = 2 * n[size : w + 1] + 1  # level h + size gains a window,
        grow[-1] = 0  # but full windows don't count
        shrink = np.where(n[: w - size + 1] > 0, 1 - 2 * n[: w - size + 1], 1 << 60)  # and level h loses one
        shrink[0] = 0
        cost = grow + shrink
        return len(cost) - 1 - int(np.argmin(cost[::-1]))

    def add(self, key, start: int, ids: bytes) -> Iterator[list]:
        """Place a document; yields the windows that became full."""
        w = self.window
        whole = len(ids) // (4 * w) * 4 * w
        for at in range(0, whole, 4 * w):
            yield [(key, start + at // 4, ids[at : at + 4 * w])]
        rest = ids[whole:]
        if not rest:
            return
        size = len(rest) // 4
        h = self.choose(size)
        if h:
            pieces = self.stacks[h].pop()
            self.level[h] -= 1
            self.n_open -= 1
        else:
            pieces = []
        pieces.append((key, start + whole // 4, rest))
        if h + size == w:
            yield pieces
            return
        self.stacks.setdefault(h + size, []).append(pieces)
        self.level[h + size] += 1
        self.n_open += 1
        if self.n_open > self.max_open:
            yield from self._pour(last=False)

    def _pour(self, last: bool) -> Iterator[list]:
        """Close the open windows by pouring the emptiest into the fullest; what is left over stays open, or ends in powers of two."""
        w = self.window
        windows = [(h, p) for h in sorted(self.stacks, reverse=True) for p in self.stacks[h]]
        self.stacks, self.n_open = {}, 0
        self.level[:] = 0
        i, j, spare = 0, len(windows) - 1, []  # spare: pieces of the window being poured out, last first
        while i <= j or spare:
            if i <= j:
                fill, pieces = windows[i]
                i += 1
            else:
                fill, pieces = 0, []
            while fill < w and (spare or i <= j):
                if not spare:
                    spare = windows[j][1][::-1]
                    j -= 1
                key, start, ids = spare.pop()
                take = min(w - fill, len(ids) // 4)
                pieces.append((key, start, ids[: 4 * take]))
                fill += take
                if 4 * take < len(ids):
                    spare.append((key, start + take, ids[4 * take :]))
            if fill == w:
                yield pieces
            elif last:
                yield from _powers(pieces, fill)
            else:
                self.stacks[fill], self.n_open = [pieces], 1
                self.level[fill] = 1

    def finish(self) -> Iterator[list]:
        yield from self._pour(last=True)


def _powers(pieces: list, fill: int) -> Iterator[list]:
    """Cut a window along the powers of two of its length, largest first."""
    pieces = pieces[::-1]
    while fill:
        room = size = 1 << (fill.bit_length() - 1)
        out = []
        while room:
            key, start, ids = pieces.pop()
            take = min(room, len(ids) // 4)
            out.append((key, start, ids[: 4 * take]))
            room -= take
            if 4 * take < len(ids):
                pieces.append((key, start + take, ids[4 * take :]))
        fill -= size
        yield out


def _packed(path: str, window: int, end_id: int, with_ids: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        was = gc.isenabled()
        gc.disable()  # the caches hold no cycles, and walking them costs a tenth of the time
        try:
            yield from pack(batches)
        finally:  # the worker may run other tasks
            if was:
                gc.enable()
            gc.collect()  # else what cycles hold would stay until after lean() has given memory back

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = WordTokens(path)
        end, block = array("I", [end_id]).tobytes(), TaskContext.get().partitionId() << 32
        packer, rows, local = Packer(window), [], 0

        def note(pieces: list) -> None:
            nonlocal local
            offset = 0
            for (doc_id, total), start, ids in pieces:
                rows.append((doc_id, start, len(ids) // 4, zlib.crc32(ids), total, block + local, offset, ids if with_ids else None))
                offset += len(ids) // 4
            local += 1

        def flush() -> pa.RecordBatch:
            cols = list(zip(*rows))
            rows.clear()
            arrays = [pa.array(c, pa.int64()) for c in cols[:7]]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in cols[7]])]).astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(cols[7]), np.uint32).astype(np.int32))))
                names.append("ids")
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            for at in range(0, batch.num_rows, GROUP):
                part = batch.slice(at, GROUP)
                for doc_id, ids in zip(part.column(0).to_pylist(), tokens.encode(part.column(1).to_pylist())):
                    ids += end
                    for pieces in packer.add((doc_id, len(ids) // 4), 0, ids):
                        note(pieces)
                    if len(rows) >= (2000 if with_ids else 20_000):
                        yield flush()
        for pieces in packer.finish():
            note(pieces)
        if rows:
            yield flush()

    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """Pieces of packed sequences: one row per piece, with the sequence, the offset there and (with_ids) the token ids."""
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * with_ids
    return text_docs(docs).mapInArrow(lean(_packed(tokenizer_path, window, end_id, with_ids)), schema)


def word_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"), word_tokenizer(), with_ids=False)
