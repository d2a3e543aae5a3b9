"""Removal of long byte strings that occur more than once, in one text or in several.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else. Sorting
every suffix of the corpus would move LENGTH bytes for each byte of input, so suffixes are
first thinned by their leading tokens, without losing a match:

1. Heads. The head of a suffix is its first LENGTH bytes; its leading token is the least hash
   of a ``GRAM``-byte string in the head. Equal heads have equal leading tokens. Neighbouring
   suffixes mostly share theirs, so a text has a run of suffixes about every 170 bytes; only
   (token, document, first and last start) of each run is kept.
2. Runs whose token occurs in one run only can hold no repeat, unless the token occurs twice
   within the run; all others go. What is left fetches its bytes from the texts, equal runs
   of bytes of one task once.
3. ``repartitionByRange`` on (token, bytes) samples splitters and deals the runs to buckets in
   order. Each bucket sorts the heads of its suffixes by token, then by multikey quicksort over
   their bytes, eight at a time: groups whose next eight bytes differ are parted, all at once, and
   heads alone in their group are done. Heads still together after LENGTH bytes are repeats.
4. Tokens that touch a bucket's edge, or have too many runs for one task's memory, are compared
   across buckets: heads that are single so far, and one each of those that repeat, are dealt by
   token and digest in parts of some ``PART_HEADS``, and equal ones in a part are repeats.

Within a bucket bytes are compared; across buckets 128-bit BLAKE2 digests of the heads under one
token stand for them. No task holds more than a bounded number of runs; a token with any number
of runs is counted by the shuffle of step 4. What the buckets found is written to the shared
folder, as the lazy result reads it.

Edge cases: null text is empty; texts under LENGTH bytes keep all; very long texts are hashed
whole, as ranges of their own; repeated rows are repeats of each other (rows with one doc_id too:
give rows unique ids, spans are by doc_id); rows with a null doc_id keep
all their bytes and aren't compared, as spans are by doc_id; ties don't matter, as spans don't depend on the order of rows; an
empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Staging, free_shuffles, read_table, text_docs

LENGTH = 400
GRAM = 64
#: Bytes hashed at once, runs compared at once, and runs of one token above which it is counted by a shuffle.
CHUNK_BYTES = 400_000
CHUNK_RUNS = 2_000
MOST_RUNS = 4_000
PART_HEADS = 20_000

_rng = np.random.default_rng(10)
_BYTE = _rng.integers(0, 1 << 64, 256, np.uint64, endpoint=False)
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE ** i and its inverse, modulo 2 ** 64, for i < n."""
    if len(_powers[0]) < n:
        for k, b in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(max(n, 2 * CHUNK_BYTES), b, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p)
    return _powers[0][:n], _powers[1][:n]


def _sums(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power(len(data))[0], out=out[1:])
    return out


def _hashes(sums: np.ndarray, width: int) -> np.ndarray:
    """A hash of the string of that width at each position."""
    n = len(sums) - width
    x = (sums[width:] - sums[:n]) * _power(n)[1]
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """min(x[j : j + w]) for each j."""
    n = len(x)
    pad = np.full(-(-n // w) * w, np.iinfo(x.dtype).max, x.dtype)
    pad[:n] = x
    rows = pad.reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


def _groups(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts of about so many bytes; one long text is a range of its own."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, to
        at = to


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string or binary column without nulls."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    return offsets, np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)


def _runs(length: int, gram: int):
    """Step 1: (token, doc_id, first, last, twice) of the runs of suffixes."""
    w = length - gram + 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            offsets, data = _buffers(batch.column(1))
            for a, b in _groups(offsets, CHUNK_BYTES):
                lo, hi = int(offsets[a]), int(offsets[b])
                if hi - lo < length:
                    continue
                at = (offsets[a : b + 1] - lo).astype(np.int64)
                h = _hashes(_sums(data[lo:hi]), gram)
                m = _sliding_min(h, w)
                n = len(m)  # heads in the chunk; those that cross into the next text don't count
                doc = np.repeat(np.arange(b - a), np.diff(at))[:n]
                valid = np.arange(n) + length <= at[1:][doc]
                same = (m[1:] == m[:-1]) & (doc[1:] == doc[:-1]) & valid[1:] & valid[:-1]
                first = np.flatnonzero(valid & np.concatenate([[True], ~same]))
                last = np.flatnonzero(valid & np.concatenate([~same, [True]]))
                if not len(first):
                    continue
                # the token's string leaves at the left, and the token stays: it occurs twice in the run
                again = np.flatnonzero((h[: n - 1] == m[:-1]) & same)
                twice = np.zeros(len(first), bool)
                twice[np.searchsorted(first, again, "right") - 1] = True
                d = doc[first]
                yield pa.RecordBatch.from_arrays([pa.array(m[first].view(np.int64)), pa.array(ids[a + d]), pa.array((first - at[d]).astype(np.int32)), pa.array((last - at[d]).astype(np.int32)), pa.array(twice)], ["token", "doc_id", "first", "last", "twice"])

    return run


def _bytes_of_runs(length: int):
    """Step 2: the bytes of each run of a text, equal ones of a task once: (token, mark, bytes, docs, firsts)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, bytes], list] = {}

        def flush() -> pa.RecordBatch:
            rows = [(t, int.from_bytes(mark, "little", signed=True), *x) for (t, mark), x in held.items()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int64()))], ["token", "mark", "bytes", "docs", "firsts", "n"])

        size = 0
        for batch in batches:
            for doc_id, text, runs in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                data = text.as_buffer().to_pybytes()
                flat = runs.values
                for token, first, last, n in zip(*(flat.field(k).to_pylist() for k in range(4))):
                    part = data[first : last + length]
                    key = (token, hashlib.blake2b(part, digest_size=8).digest())
                    if (x := held.get(key)) is None:
                        held[key] = [part, [doc_id], [first], n]
                        size += len(part) + 200
                    else:
                        x[1].append(doc_id)
                        x[2].append(first)
                        size += 16
            if size > 16_000_000:
                yield flush()
                size = 0
        if held:
            yield flush()

    return run


def _union(starts: np.ndarray, length: int) -> tuple[list[int], list[int]]:
    """The spans that strings at these sorted starts cover."""
    cut = np.flatnonzero(np.diff(starts) > length)
    return starts[np.concatenate([[0], cut + 1])].tolist(), (starts[np.concatenate([cut, [len(starts) - 1]])] + length).tolist()


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number, in their order; zeros follow the last byte."""
    wide = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data),), ">u8", wide, strides=(1,)).astype(np.uint64)


def equal_heads(words: np.ndarray, at: np.ndarray, token: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Heads (indices into at) that equal another under their token over so many bytes, in order, and where each group of equal ones begins.

    Multikey quicksort, eight bytes a step: only groups whose next bytes differ are sorted further.
    """
    order = np.lexsort((words[at], token))
    key, new = words[at[order]], np.ones(len(at), bool)
    new[1:] = (key[1:] != key[:-1]) | (token[order][1:] != token[order][:-1])
    starts = np.flatnonzero(new)
    depth = 0
    while True:
        sizes = np.diff(np.append(starts, len(order)))
        keep = sizes > 1  # those alone are done
        if not keep.all():
            order, sizes = order[np.repeat(keep, sizes)], sizes[keep]
            starts = np.cumsum(sizes) - sizes
        if not len(order) or depth + 8 >= length:
            return order, starts
        depth = min(depth + 8, length - 8)
        key = words[at[order] + depth]
        split = np.logical_or.reduceat(key != np.repeat(key[starts], sizes), starts)
        if split.any():
            some = np.flatnonzero(np.repeat(split, sizes))
            group = np.repeat(np.arange(len(starts)), sizes)
            inner = np.lexsort((key[some], group[some]))
            order[some], key[some] = order[some][inner], key[some][inner]
            new = np.zeros(len(order), bool)
            new[starts] = True
            new[1:] |= key[1:] != key[:-1]
            starts = np.flatnonzero(new)


_OUT = "token long, mark long, part int, heads array<long>, marks array<long>, ats array<int>, docs array<long>, firsts array<int>, starts array<int>, ends array<int>"
_LONGS, _INTS = pa.list_(pa.int64()), pa.list_(pa.int32())
_OUT_TYPES = [pa.int64(), pa.int64(), pa.int32(), _LONGS, _LONGS, _INTS, _LONGS, _INTS, _INTS, _INTS]
_OUT_NAMES = [x.split()[0] for x in _OUT.split(", ")]


def _part_bits(runs: int, part_heads: int) -> int:
    """Bits of a head's fingerprint that deal the heads of a token with so many runs, for some part_heads in each part."""
    return max(0, int(runs * 170 // part_heads).bit_length())


def _compare(length: int, most_runs: int, part_heads: int):
    """Step 3, over a bucket in order of token. Rows out: (docs, firsts, starts, ends) of repeats found here;
    and for step 4 (token, mark, docs, firsts) of runs and (token, part, heads, marks, ats) of their heads."""

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _OUT_TYPES)], _OUT_NAMES)

    def local(rows: list[tuple], all_here: bool = True) -> Iterator[pa.RecordBatch]:
        """rows: all runs of some tokens, or (not all_here) some runs of one token, which others may hold too."""
        sizes = np.array([len(r[2]) for r in rows])
        ends = np.cumsum(sizes)
        data = b"".join(r[2] for r in rows)
        run = np.repeat(np.arange(len(rows)), np.maximum(sizes - length + 1, 0))
        at = np.arange(len(run)) - np.searchsorted(run, np.arange(len(rows)))[run]  # heads of a run stand side by side
        place = at + (ends - sizes)[run]
        token, n = np.array([r[0] for r in rows]), np.array([len(r[3]) for r in rows])
        group, starts = equal_heads(_words(np.frombuffer(data, np.uint8)), place, token[run], length)
        again = n[run] > 1
        again[group] = True
        out, bounds = [], np.searchsorted(run, np.arange(len(rows) + 1))
        some = np.add.reduceat(again, bounds[:-1]) > 0
        for k in np.flatnonzero(some):
            s, e = _union(at[bounds[k] : bounds[k + 1]][again[bounds[k] : bounds[k + 1]]], length)
            out.append((None, None, None, None, None, None, rows[k][3], rows[k][4], s, e))
        if out:
            yield batch_of(out)
        if all_here:
            return
        # for step 4: heads that are single so far, with their runs, and repeats found here once each, with place -1
        alone_here = again.copy()
        alone_here[group] = False  # its copies are rows of one run
        known, single = np.concatenate([group[starts], np.flatnonzero(alone_here)]), np.flatnonzero(~again)
        alone = [rows[k] for k in np.unique(run[single])]
        if alone:
            yield batch_of([(r[0], r[1], None, None, None, None, r[3], r[4], None, None) for r in alone])
        marks, bits = np.array([r[1] for r in rows], np.int64), _part_bits(rows[0][5], part_heads)
        pick = np.concatenate([single, known])
        place = np.concatenate([at[single], np.full(len(known), -1)])
        view = memoryview(data)
        h = np.frombuffer(b"".join([hashlib.blake2b(view[a : a + length], digest_size=16).digest() for a in (at[pick] + (ends - sizes)[run[pick]]).tolist()]), np.uint64).reshape(-1, 2)
        part = (h[:, 0] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(pick), np.int64)
        order = np.argsort(part, kind="stable")
        pick, place, part, h = pick[order], place[order].astype(np.int32), part[order], h[order]
        cuts = np.flatnonzero(np.diff(part, prepend=-1))
        stops = np.append(cuts, len(part)).astype(np.int32)
        lists = lambda x, wide=1: pa.ListArray.from_arrays(pa.array(stops * wide), pa.array(x))
        m = len(cuts)
        if m:
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m, rows[0][0])), pa.nulls(m, pa.int64()), pa.array(part[cuts].astype(np.int32)), lists(h.view(np.int64).ravel(), 2), lists(marks[run[pick]]), lists(place), *[pa.nulls(m, t) for t in _OUT_TYPES[6:]]], _OUT_NAMES)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []  # whole tokens
        last: list[tuple] = []  # runs of the token that comes last so far
        first_token, sent = None, None  # sent: a token whose runs go abroad
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if first_token is None:
                    first_token = sent = row[0]
                if last and last[-1][0] != row[0]:
                    if last[0][0] == sent:
                        yield from local(last, False)
                    else:
                        done += last
                    last = []
                last.append(row)
                if len(last) > most_runs:
                    sent = row[0]
                    yield from local(last, False)
                    last = []
                if len(done) > CHUNK_RUNS:
                    yield from local(done)
                    done = []
        if done:
            yield from local(done)
        if last:
            yield from local(last, False)

    return run


def _across(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 4: rows (token, part, heads, marks, ats) in order of (token, part) to (token, mark, ats) of heads that repeat."""

    def repeats(token: int, rows: list) -> Iterator[pa.RecordBatch]:
        head, mark, at = (np.concatenate([r[k] for r in rows]) for k in range(3))
        head = head.reshape(-1, 2)
        order = np.lexsort((head[:, 1], head[:, 0]))
        head, mark, at = head[order], mark[order], at[order]
        same = (head[1:] == head[:-1]).all(axis=1)
        again = (np.append(same, False) | np.append(False, same)) & (at >= 0)
        if again.any():
            mark, at = mark[again], at[again]
            order = np.argsort(mark, kind="stable")
            mark, at = mark[order], at[order]
            cuts = np.flatnonzero(np.concatenate([[True], mark[1:] != mark[:-1]]))
            ats = pa.ListArray.from_arrays(pa.array(np.append(cuts, len(at)).astype(np.int32)), pa.array(at))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cuts), token)), pa.array(mark[cuts]), ats], ["token", "mark", "ats"])

    group, rows = None, []
    for batch in batches:
        lists = [(c.offsets.to_numpy(), c.values.to_numpy()) for c in (batch.column(k) for k in (2, 3, 4))]
        for k, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            if key != group:
                if rows:
                    yield from repeats(group[0], rows)
                group, rows = key, []
            rows.append([v[o[k] : o[k + 1]] for o, v in lists])
    if rows:
        yield from repeats(group[0], rows)


def repeat_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most_runs: int = MOST_RUNS, part_heads: int = PART_HEADS) -> DataFrame:
    """doc_id, spans array<struct<start, end>> of bytes that repeats cover (not merged, not in order); documents without any have no row."""
    spark, texts = docs.sparkSession, text_docs(docs).where("doc_id IS NOT NULL")
    # Tables that are read twice here are kept on the executors' disks; what a lost executor held is made again from the texts.
    keep = lambda df: df.persist(StorageLevel.DISK_ONLY)
    runs = keep(texts.mapInArrow(_runs(length, gram), "token long, doc_id long, first int, last int, twice boolean"))
    again = runs.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.max("twice").alias("twice")).where("n > 1 OR twice").select("token", "n")
    kept = runs.join(again, "token").groupBy("doc_id").agg(F.collect_list(F.struct("token", "first", "last", "n")).alias("runs"))
    fetched = texts.join(kept.hint("merge"), "doc_id").select("doc_id", F.col("text").cast("binary").alias("text"), "runs")
    parts = keep(fetched.mapInArrow(_bytes_of_runs(length), "token long, mark long, bytes binary, docs array<long>, firsts array<int>, n long"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = parts.repartitionByRange(n, "token", "mark").sortWithinPartitions("token")  # samples the parts, so they are made here
    found = Staging(spark, "repeats").write(buckets.mapInArrow(_compare(length, most_runs, part_heads), _OUT), "found")
    runs.unpersist()
    parts.unpersist()
    del runs, again, kept, fetched, parts, buckets
    free_shuffles(spark)

    here = found.where("token IS NULL").select(F.arrays_zip("docs", "firsts").alias("m"), F.arrays_zip("starts", "ends").alias("s"))
    heads = found.where("part IS NOT NULL").select("token", "part", "heads", "marks", "ats").repartition("token", "part").sortWithinPartitions("token", "part")
    across = heads.mapInArrow(_across, "token long, mark long, ats array<int>").groupBy("token", "mark").agg(F.flatten(F.collect_list("ats")).alias("ats"))
    members = found.where("token IS NOT NULL AND part IS NULL").select("token", "mark", F.arrays_zip("docs", "firsts").alias("m"))
    across = members.join(across, ["token", "mark"]).select("m", F.transform("ats", lambda x: F.struct(x.alias("starts"), (x + length).alias("ends"))).alias("s"))
    each = here.unionByName(across).select(F.explode("m").alias("m"), "s")
    shift = F.transform("s", lambda x: F.struct((x["starts"] + F.col("m.firsts")).alias("start"), (x["ends"] + F.col("m.firsts")).alias("end")))
    return each.select(F.col("m.docs").alias("doc_id"), shift.alias("spans")).groupBy("doc_id").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def merge_spans(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["start"], s["end"]) for s in spans or ()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _removed(keep_bytes: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                data = text.as_buffer()
                n, digest, at, kept = data.size, hashlib.sha256(), 0, []
                merged = merge_spans(spans)
                view = memoryview(data)
                for a, b in [*merged, (n, n)]:
                    digest.update(view[at:a])
                    if keep_bytes:
                        kept.append(bytes(view[at:a]))
                    at = b
                rows.append((doc_id, n, sum(b - a for a, b in merged), len(merged), digest.hexdigest(), b"".join(kept) if keep_bytes else None))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            if rows:
                m = 6 if keep_bytes else 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows))[:m], types)], names[:m])

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, keep_bytes: bool = True, most_runs: int = MOST_RUNS, part_heads: int = PART_HEADS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and (keep_bytes) kept: the bytes that stay."""
    spans = repeat_spans(docs, length, most_runs=most_runs, part_heads=part_heads)
    both = text_docs(docs).join(spans, "doc_id", "left").select("doc_id", F.col("text").cast("binary").alias("text"), "spans")
    return both.mapInArrow(_removed(keep_bytes), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_bytes)


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"), keep_bytes=False)
