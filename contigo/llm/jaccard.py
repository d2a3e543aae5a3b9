"""Join of documents whose sets of 5-word shingles have a Jaccard similarity of 0.75 or more.

Words are runs of other characters than ASCII white space, A-Z in lower case. Shingles are
64-bit hashes of five words. The join runs in tiles of documents of like size:

1. Signatures. Each document gets the size of its set, a 1024-bit hashed bitmap of it, and 64
   tile keys: every key hashes four bins of a 256-bin min-wise sketch (fast similarity
   sketching), so two documents at similarity 0.75 share none of the 64 with a chance of
   about (1 - 0.75**4)**64 = 3e-11, far less above it. In the exact mode the keys are the least
   quarter of the set's hashes and one more: of two similar sets both quarters hold a common
   element, so no link can be lost, but a passage that many documents share makes large tiles.
   Documents with equal sets are one set from here on; the least doc_id stands for it.
2. Stars. Each set is held against one other: the least set of the tile it shares most keys
   with. Bit counts bound the overlap from above: each bit of x that y lacks is an element y
   lacks. What passes is decided by intersecting the sorted shingle arrays. Links make
   components. Then sets are held against the least sets of their other tiles, where those
   are of other components. This settles groups of near copies of any size with a few
   comparisons a copy.
3. Tiles. Where a tile still holds several components, its sets are laid out by size band (a
   factor of 4/3, each set also visits the next band) and blocks of at most some ``BLOCK``
   sets; in each pair of blocks, sets of different components are compared by size and bit
   counts, and what passes by the exact intersection: for ``BEST_ROUNDS`` rounds each set's
   likeliest partner only, then, among the components that are left, all. Pairs within a
   component are never made. Two sets that share many tiles are paired in the first ``SHARED``
   of them, not in each: 16 bits of each key tell what tiles they share, and a pair is left to
   earlier tiles only if that many keys agree there, which different keys do with a chance of
   about 3e-14. The exact mode pairs them in every tile.
4. Components of all links; every document gets the least doc_id of its component. Sets with more
   than a thousandth of all documents, a thousand at most, are told to their documents by a
   broadcast, so that no task gets all copies of one text.

Nothing is capped: large tiles become more blocks. Tables between steps are written to the
shared folder.

Edge cases: null, empty and wordless texts have empty sets and link with nothing; a text with
fewer words than five has one shingle, the whole sequence; repeated rows have equal sets and
link; very long texts are whole sets as all others; ties (equal sets, equally good partners) go to
the least doc_id. Rows with a null doc_id link with equal sets only and have no component of their
own. Rows that share a doc_id should be one document: any of them stands for all. An empty table
gives no rows; other columns aren't read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Staging, lean, read_table, text_docs
from .repeats import CHUNK_BYTES, _buffers, _groups, _power, _sums

WORDS = 5
BINS, PER_KEY, BITS = 256, 4, 1024
KEYS = BINS // PER_KEY
#: Rounds in which an element picks its bin; in the next ones, bins not yet filled take the least of all elements.
ROUNDS = 48
BLOCK = 2048
#: Rounds in which a set of a mixed tile is held against its likeliest partner only, before all are.
BEST_ROUNDS = 1
#: Tiles, in order of their keys, in which sets that share more of them are paired.
SHARED = 4
#: Sets of more than this part of all documents (and a thousand of them) count as hot.
HOT_SETS = 1000

_rng = np.random.default_rng(5)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_PLACE = _rng.integers(1, 1 << 63, WORDS, np.uint64) * np.uint64(2) + np.uint64(1)
_ROUND = _rng.integers(0, 1 << 63, ROUNDS, np.uint64)
_FILL = _rng.integers(0, 1 << 63, BINS, np.uint64)
_GROUP = _rng.integers(0, 1 << 63, BINS, np.uint64) | np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def shingle_sets(offsets: np.ndarray, data: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; texts are data[offsets[k] : offsets[k + 1]]."""
    at = (offsets - offsets[0]).astype(np.int64)
    low = _LOWER[data[offsets[0] : offsets[-1]]]
    n = len(low)
    if not n:
        return [np.zeros(0, np.uint64) for _ in at[1:]]
    word = ~_SPACE[low]
    edge = np.zeros(n + 1, bool)  # a text begins here
    edge[at] = True
    before = np.concatenate([[False], word[:-1]])
    after = np.concatenate([word[1:], [False]])
    first = np.flatnonzero(word & (~before | edge[:-1]))
    last = np.flatnonzero(word & (~after | edge[1:])) + 1
    sums = _sums(low)
    words = _mix((sums[last] - sums[first]) * _power(n)[1][first])
    of = np.searchsorted(first, at)
    m = max(len(words) - WORDS + 1, 0)
    grams = np.zeros(m, np.uint64)
    for k in range(WORDS):
        grams += words[k : m + k] * _PLACE[k]
    grams = _mix(grams)
    out = []
    for a, b in zip(of[:-1].tolist(), of[1:].tolist()):
        if b - a >= WORDS:
            out.append(np.unique(grams[a : b - WORDS + 1]))
        elif b > a:
            whole = words[a:b] * _PLACE[: b - a]
            out.append(_mix(np.array([whole.sum(dtype=np.uint64) + np.uint64(b - a)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def sketches(elements: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Min-wise sketch (sets x BINS) of non-empty sets; set k begins at elements[starts[k]]."""
    n, none = len(starts), np.iinfo(np.uint64).max
    flat = np.full(n * BINS, none, np.uint64)
    of = np.repeat(np.arange(n), np.diff(np.append(starts, len(elements))))
    left, own = elements, of
    for k in range(ROUNDS):
        v = _mix(left ^ _ROUND[k])
        np.minimum.at(flat, own * BINS + (v >> np.uint64(56)).astype(np.int64), (np.uint64(k) << np.uint64(48)) | (v & np.uint64((1 << 48) - 1)))
        open_ = (flat.reshape(n, BINS) == none).any(axis=1)[own]
        if not open_.all():
            left, own = left[open_], own[open_]
        if not len(left):
            return flat.reshape(n, BINS)
    out = flat.reshape(n, BINS)
    sets, begin = np.unique(own, return_index=True)
    for a in range(0, len(sets), 2000):  # few elements are left: small sets
        lo, hi = begin[a], begin[a + 2000] if a + 2000 < len(sets) else len(own)
        v = _mix(left[lo:hi, None] ^ _FILL[None, :]) & np.uint64((1 << 48) - 1)
        least = np.minimum.reduceat(v, begin[a : a + 2000] - lo, axis=0) | (np.uint64(ROUNDS) << np.uint64(48))
        some = out[sets[a : a + 2000]]
        out[sets[a : a + 2000]] = np.where(some == none, least, some)
    return out


def _signatures(exact: bool, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        offsets, data = _buffers(batch.column(1))
        for a, b in _groups(offsets, CHUNK_BYTES):
            sets = shingle_sets(offsets[a : b + 1], data)
            sizes = np.array([len(s) for s in sets], np.int64)
            some = np.flatnonzero(sizes)
            id1, id2 = np.zeros(b - a, np.uint64), np.zeros(b - a, np.uint64)
            keys, bits = np.zeros((b - a, KEYS), np.uint64), np.zeros((b - a, BITS // 64), np.int64)
            if len(some):
                elements = np.concatenate([sets[k] for k in some])
                starts = np.concatenate([[0], np.cumsum(sizes[some])[:-1]])
                id1[some] = np.add.reduceat(_mix(elements ^ np.uint64(1)), starts)
                id2[some] = np.add.reduceat(_mix(elements ^ np.uint64(2)), starts)
                if not exact:
                    parts = (sketches(elements, starts) * _GROUP).reshape(len(some), KEYS, PER_KEY).sum(axis=2, dtype=np.uint64)
                    keys[some] = _mix(parts + np.arange(KEYS, dtype=np.uint64))
                marked = np.zeros(len(some) * BITS, bool)
                marked[np.repeat(np.arange(len(some)), sizes[some]) * BITS + (elements >> np.uint64(54)).astype(np.int64)] = True
                bits[some] = np.packbits(marked.reshape(len(some), BITS), axis=1).view(np.int64)
            lists = lambda x: pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1, dtype=np.int32) * x.shape[1]), pa.array(x.view(np.int64).ravel()))  # noqa: B023, E731
            own = lists(keys)
            if exact:  # sets are in order of hash: n - ceil(3 n / 4) + 1 of them
                own = pa.array([x[: len(x) - (3 * len(x) + 3) // 4 + 1].view(np.int64) if len(x) else [] for x in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), pa.array(sizes), pa.array(id1.view(np.int64)), pa.array(id2.view(np.int64)), own, lists(bits)], ["doc_id", "n", "id1", "id2", "keys", "bits"])


def _arrays(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rep, text, head) to (rep, head, shingles)."""
    for batch in batches:
        offsets, data = _buffers(batch.column(1))
        for a, b in _groups(offsets, CHUNK_BYTES):
            sets = shingle_sets(offsets[a : b + 1], data)
            ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            shingles = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), shingles], ["rep", "head", "shingles"])


def _linked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, x, y) to the (a, b) whose sorted arrays x and y are similar enough."""
    for batch in batches:
        x, y = batch.column(2), batch.column(3)
        (xo, xd), (yo, yd) = ((c.offsets.to_numpy(), c.values.to_numpy()) for c in (x, y))
        keep = np.zeros(batch.num_rows, bool)
        for k in range(batch.num_rows):
            p, q = xd[xo[k] : xo[k + 1]], yd[yo[k] : yo[k + 1]]
            both = np.concatenate([p, q]).view(np.uint64)
            both.sort(kind="stable")  # a merge: either part is sorted
            shared = int(np.count_nonzero(both[1:] == both[:-1]))
            keep[k] = 7 * shared >= 3 * (len(p) + len(q))  # shared / union >= 3 / 4
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep))


def _tiles(best_only: bool):
    """Rows (key, band, i, j, rep, n, c, own, second, bits, marks) in order of (key, band, i, j) to pairs (a, b)
    of different components that bit counts can't rule out; best_only: for each set, its likeliest partner in the tile.
    marks: the upper 16 bits of each of a set's keys; where they are empty, a pair comes from every tile that it shares."""

    def pairs(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        tile = rows.combine_chunks().to_batches()[0]
        i, j = (tile.column(k)[0].as_py() for k in (2, 3))
        rep, n, c, own, second = (tile.column(k).to_numpy(zero_copy_only=False) for k in range(4, 9))
        bits = tile.column(9).flatten().to_numpy().view(np.uint64).reshape(len(rep), -1)  # bits of signed numbers would be counted without their sign
        marks = tile.column(10).flatten().to_numpy()
        marks, here = marks.reshape(len(rep), -1) if len(marks) else None, tile.column(0)[0].as_py() >> 48
        left = np.arange(len(rep)) if i == j else np.flatnonzero(~second)
        right = left if i == j else np.flatnonzero(second)
        best = np.zeros(len(rep), np.int64)
        for k in range(0, len(left), 64):
            p = left[k : k + 64]
            ok = (c[p][:, None] != c[right]) & (own[p][:, None] | own[right])
            ok &= 4 * np.minimum(n[p][:, None], n[right]) >= 3 * np.maximum(n[p][:, None], n[right])
            if i == j:
                ok &= rep[p][:, None] < rep[right]
            u, v = np.nonzero(ok)
            for at in range(0, len(u), 20_000):
                a, b = p[u[at : at + 20_000]], right[v[at : at + 20_000]]
                only_a = np.bitwise_count(bits[a] & ~bits[b]).sum(axis=1, dtype=np.int64)
                only_b = np.bitwise_count(bits[b] & ~bits[a]).sum(axis=1, dtype=np.int64)
                most = np.minimum(n[a] - only_a, n[b] - only_b)
                good = 7 * most >= 3 * (n[a] + n[b])
                a, b, most = a[good], b[good], most[good]
                if marks is not None:
                    same = marks[a] == marks[b]
                    tile_at = (same & (marks[a] == here)).argmax(axis=1)  # this tile's place among the keys, or one before it
                    new = np.cumsum(same, axis=1)[np.arange(len(a)), tile_at] <= SHARED
                    a, b, most = a[new], b[new], most[new]
                if best_only:
                    rate = (most << 20) // (n[a] + n[b]) << 32
                    np.maximum.at(best, a, rate | b)
                    np.maximum.at(best, b, rate | a)
                elif len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(rep[a], rep[b])), pa.array(np.maximum(rep[a], rep[b]))], ["a", "b"])
        if best_only and best.any():
            a = np.flatnonzero(best)
            b = best[a] & ((1 << 32) - 1)
            both = np.unique(np.stack([np.minimum(rep[a], rep[b]), np.maximum(rep[a], rep[b])]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], ["a", "b"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.stack([batch.column(k).to_numpy() for k in range(4)])
            cuts = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            if held and tuple(held[-1].column(k)[0].as_py() for k in range(4)) != tuple(marks[:, 0].tolist()):
                yield from pairs(pa.Table.from_batches(held))
                held = []
            for a, b in zip(cuts[:-2], cuts[1:-1]):
                yield from pairs(pa.Table.from_batches([*held, batch.slice(a, b - a)]))
                held = []
            held.append(batch.slice(cuts[-2]))
        if held:
            yield from pairs(pa.Table.from_batches(held))

    return run


def components(stage: Staging, links: DataFrame, name: str) -> DataFrame:
    """(v, c): the least vertex that each vertex of links (a, b) reaches. Labels take their neighbours' least, then their label's label, until nothing changes."""
    both = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))  # one pass over the links
    edges = stage.write(links.select(both.alias("e")).select("e.*").distinct(), f"{name}-edges", few=True)
    labels = stage.write(edges.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("c")), f"{name}-labels0", few=True)
    k = 0
    while True:
        k += 1
        near = edges.join(labels.withColumnsRenamed({"v": "b"}), "b").groupBy(F.col("a").alias("v")).agg(F.min("c").alias("m"))
        step = labels.join(near, "v").select("v", "c", F.least("c", "m").alias("m"))
        jump = labels.select(F.col("v").alias("m"), F.col("c").alias("up"))
        new = stage.write(step.join(jump, "m", "left").select("v", F.coalesce("up", "m").alias("c"), (F.coalesce("up", "m") != F.col("c")).alias("moved")), f"{name}-labels{k}", few=True)
        moved = new.where("moved").limit(1).count()
        stage.drop(f"{name}-labels{k - 1}")
        labels = new.drop("moved")
        if not moved:
            return labels


def _bound(a: str, b: str) -> F.Column:
    """Whether bit counts leave it open that sets a and b are similar enough."""
    ones = lambda x, y: sum((F.bit_count(F.get(f"{x}.bits", k).bitwiseAND(F.bitwise_not(F.get(f"{y}.bits", k)))) for k in range(BITS // 64)), F.lit(0))
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    most = F.least(na - ones(a, b), nb - ones(b, a))
    return (4 * F.least(na, nb) >= 3 * F.greatest(na, nb)) & (7 * most >= 3 * (na + nb))


def _mixed(stage: Staging, tiles: DataFrame, sets: DataFrame, k: int, marked: bool) -> DataFrame:
    """The rows for ``_tiles``: sets of tiles (key, rep, n, c) with several components, by size band and pair of blocks. marked: with marks of their keys."""
    tiles = stage.write(tiles, f"tiles{k}", few=True)
    mixed = tiles.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo != hi").select("key")
    rows = tiles.join(mixed, "key", "left_semi")
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(4 / 3)) + 1e-9).cast("int")
    rows = rows.withColumn("band", band).select("*", F.explode(F.array(F.lit(True), F.lit(False))).alias("own"))
    rows = stage.write(rows.withColumn("band", F.when(F.col("own"), F.col("band")).otherwise(F.col("band") + 1)), f"rows{k}", few=True)
    held = rows.groupBy("key", "band").agg(F.count(F.lit(1)).alias("m"), F.max("own").alias("some"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("m > 1 AND some AND lo != hi")
    blocks = rows.join(held.select("key", "band", F.ceil(F.col("m") / BLOCK).cast("int").alias("nb")), ["key", "band"]).withColumn("blk", F.pmod(F.xxhash64("rep"), F.col("nb")).cast("int"))
    marks = F.transform("keys", lambda x: F.shiftright(x, 48).cast("short")) if marked else F.array().cast("array<short>")
    blocks = blocks.join(sets.select("rep", "bits", marks.alias("marks")), "rep").select("*", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("o"))
    i, j = F.least("blk", "o"), F.greatest("blk", "o")
    blocks = blocks.select("key", "band", i.alias("i"), j.alias("j"), "rep", "n", "c", "own", (F.col("blk") == j).alias("second"), "bits", "marks")
    return blocks.repartition("key", "band", "i", "j").sortWithinPartitions("key", "band", "i", "j")


def jaccard_components(docs: DataFrame, exact: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id. exact: no link is lost by chance."""
    spark, texts = docs.sparkSession, text_docs(docs)
    stage = Staging(spark, "jaccard")
    signed = stage.write(texts.mapInArrow(lean(functools.partial(_signatures, exact)), "doc_id long, n long, id1 long, id2 long, keys array<long>, bits array<long>"), "signed")
    ids = stage.write(signed.select("doc_id", "n", "id1", "id2"), "ids", few=True)
    reps = ids.where("n > 0").groupBy("id1", "id2", "n").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    sets = stage.write(signed.join(reps.select(F.col("rep").alias("doc_id")).distinct().hint("merge"), "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(F.col("doc_id").alias("rep"), "n", "keys", "bits"), "sets", free=True)
    stage.drop("signed")

    # tiles with two sets or more
    each = sets.select("rep", "n", F.explode("keys").alias("key"))
    shared = each.groupBy("key").agg(F.count(F.lit(1)).alias("sets"), F.min(F.struct("rep", "n")).alias("least")).where("sets > 1").select("key", "least")
    tiles = stage.write(each.join(shared, "key").select("key", "rep", "n", F.col("least.rep").alias("head"), F.col("least.n").alias("head_n")), "tiles", free=True)
    # stars: of the sets that are least in a tile, the one met most often
    fits = (F.col("rep") != F.col("head")) & (4 * F.least("n", "head_n") >= 3 * F.greatest("n", "head_n"))
    met = stage.write(tiles.groupBy("rep", "head").agg(F.count(F.lit(1)).alias("met"), F.first(fits).alias("fits")), "met", few=True)
    best = met.groupBy("rep").agg(F.max(F.struct("fits", "met", (-F.col("head")).alias("head"))).alias("best"))
    best = best.select(F.col("rep").alias("doc_id"), F.when(F.col("best.fits"), -F.col("best.head")).alias("head"))
    known = texts.join(best.hint("merge"), "doc_id").select("doc_id", "text", "head")
    arrays = stage.write(known.mapInArrow(lean(_arrays), "rep long, head long, shingles array<long>"), "arrays", free=True)
    star = arrays.where("head IS NOT NULL").alias("x").join(arrays.select(F.col("rep").alias("to"), F.col("shingles").alias("other")).alias("y"), F.col("x.head") == F.col("y.to"))
    star = star.select(F.least("rep", "to").alias("a"), F.greatest("rep", "to").alias("b"), "shingles", "other")
    links = star.mapInArrow(lean(_linked), "a long, b long")
    every = met.select("rep").distinct()
    label = components(stage, links, "star")
    label = stage.write(every.join(label.toDF("rep", "c"), "rep", "left").select("rep", F.coalesce("c", "rep").alias("c")), "label0", few=True)

    # what tiles still hold of several components
    def held_against(label: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
        """The components that the pairs that are similar enough make of the labelled ones."""
        pairs = stage.write(pairs.distinct(), f"pairs{k}", free=True, few=True)
        some = arrays.select("rep", "shingles").join(pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), "rep", "left_semi")
        both = pairs.join(some.toDF("a", "x"), "a").join(some.toDF("b", "y"), "b").select("a", "b", "x", "y")
        new = both.mapInArrow(lean(_linked), "a long, b long").join(label.toDF("a", "ca"), "a").join(label.toDF("b", "cb"), "b")
        edges = stage.write(new.where("ca != cb").select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct(), f"new{k}", free=True, few=True)
        if not edges.limit(1).count():
            return label
        up = components(stage, edges, f"joined{k}")
        return stage.write(label.join(up.toDF("c", "up"), "c", "left").select("rep", F.coalesce("up", "c").alias("c")), f"label{k}", few=True)

    far = met.where("fits").select("rep", "head").join(label, "rep").join(label.toDF("head", "d"), "head").where("c != d")
    far = far.join(sets.select(F.col("rep"), F.struct("n", "bits").alias("x")), "rep").join(sets.select(F.col("rep").alias("head"), F.struct("n", "bits").alias("y")), "head").where(_bound("x", "y"))
    label = held_against(label, far.select(F.least("rep", "head").alias("a"), F.greatest("rep", "head").alias("b")), 1)
    for k in range(2, 2 + BEST_ROUNDS + 1):
        best_only = k < 2 + BEST_ROUNDS
        rows = _mixed(stage, tiles.select("key", "rep", "n").join(label, "rep"), sets, k, not best_only and not exact)
        label = held_against(label, rows.mapInArrow(lean(_tiles(best_only)), "a long, b long"), k)
    stage.drop("tiles", "arrays", "met", "sets")
    found = label.toDF("v", "c")

    member = reps.join(found.withColumnRenamed("v", "rep"), "rep", "left").select("id1", "id2", "n", F.coalesce("c", "rep").alias("c"), "copies")
    member = stage.write(member, "member", few=True)
    equal = ["id1", "id2", "n"]
    hot = member.where(F.col("copies") > max(1000, ids.count() // HOT_SETS)).drop("copies")  # HOT_SETS rows at most
    out = ids.join(member.drop("copies"), equal, "left")
    if hot.limit(1).count():
        out = ids.join(F.broadcast(hot), equal).unionByName(ids.join(F.broadcast(hot), equal, "left_anti").join(member.drop("copies"), equal, "left"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("c", "doc_id").alias("component_id"))


def keep_one_each(docs: DataFrame) -> DataFrame:
    """The rows of docs that come first, by doc_id, in their component; of rows that share that doc_id the least by all columns. Rows with a null doc_id stay."""
    stage = Staging(docs.sparkSession, "kept")
    kept = stage.write(jaccard_components(docs).where("doc_id = component_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")), "ids", few=True)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    out = docs.join(kept.where("rows = 1").select("doc_id"), "doc_id", "left_semi").select(*columns).unionByName(docs.where("doc_id IS NULL"))
    if not kept.where("rows > 1").limit(1).count():
        return out
    same = docs.join(kept.where("rows > 1").select("doc_id"), "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*columns)).alias("row"))
    return out.unionByName(same.select("row.*"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN ws ELSE ws[i:i+4] END AS g FROM w, unnest(range(1, greatest(len(ws) - 3, 2))) t(i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 75 * (x.n + y.n - i)),
u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(v, c) AS (SELECT a, a FROM u UNION SELECT u.b, r.c FROM r JOIN u ON u.a = r.v)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce((SELECT min(c) FROM r WHERE v = doc_id), doc_id) AS component_id FROM documents LEFT JOIN n USING (doc_id)
"""
