"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame operations only.

``source_targets``: the words each source should give: its weight's part of ``share`` times
all words, at most ``most`` times its own size, the excess reshared by weight until no source
is above (water filling, solved in one pass over the sorted sources).

``mix_decisions``: every document of a source should be taken c = target / size times on
average. floor(c) copies are certain, the fractional rest is rounded by the pivotal method:
two fractional documents are paired and words of probability mass move from one to the other,
in a random direction that leaves each expectation as it was, until one of them is integral;
the other meets the next. The words of the pair stay the same, so a source's taken words
differ from its target by part of the one document that is left over at most.

Distributed: documents are dealt to blocks of about ``BLOCK`` by a hash of their id, each
block is folded in hash order by one SQL ``aggregate``, and what is left over in each block
(one document at most) is folded again with others, in a tree of some log(n) / log(BLOCK)
levels, until a source has one left, which is rounded to the nearer side; a document of the root
that has about the words of that rounding then changes sides against it. Blocks are small
whatever the source's share of the rows, random numbers are hashes of ids: reruns agree.

Edge cases: null or empty text has size 0 and is taken 0 words (and kept once by
``repeat_documents``); very long texts are one document each; null is a source of its own, the
last; repeated rows, and rows with equal or null ids, are rounded each (equal ids as one random
number); ties between hashes don't matter; an empty table gives no rows; other columns, whatever
their names, go along in ``repeat_documents`` and aren't read otherwise.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Staging, read_table, words_of

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
BLOCK = 64
SEED = 8
#: Mass below this counts as none.
TINY = 1e-9


def _uniform(*cols: Column) -> Column:
    """A number in [0, 1) that only depends on the columns."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") * F.lit(2.0**-53)


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """sid, source, n, source_size, target of each source. The windows run over sources, one row each."""
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    by = by.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    by = by.withColumn("weight", weight).withColumn("most", F.col("source_size") * most)
    every = Window.partitionBy()
    before = Window.orderBy(F.col("most") / F.col("weight"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(every) * share - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    by = by.withColumn("rate", left / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    by = by.withColumn("full", F.col("rate") * F.col("weight") >= F.col("most"))
    rate = F.max(F.when(~F.col("full"), F.col("rate"))).over(every)  # rates only fall after the first source that isn't full
    return by.select("sid", "source", "n", "source_size", F.when(F.col("full"), F.col("most")).otherwise(rate * F.col("weight")).alias("target"))


#: One step of the fold: carry (i, p, s) meets x (i, p, s, u); ones: those that became 1.
_MEET = f"""
transform(array(named_struct(
  'a', least((1 - acc.p) * acc.s, x.p * x.s), 'b', least(acc.p * acc.s, (1 - x.p) * x.s),
  'r1', (1 - acc.p) * acc.s <= x.p * x.s, 'r0', acc.p * acc.s <= (1 - x.p) * x.s)), t ->
  transform(array(CASE
    WHEN x.u * (t.a + t.b) < t.b AND t.r1 THEN named_struct('i', x.i, 'p', x.p - t.a / x.s, 's', x.s, 'one', array(acc.i))
    WHEN x.u * (t.a + t.b) < t.b THEN named_struct('i', acc.i, 'p', acc.p + t.a / acc.s, 's', acc.s, 'one', cast(array() AS array<int>))
    WHEN t.r0 THEN named_struct('i', x.i, 'p', x.p + t.b / x.s, 's', x.s, 'one', cast(array() AS array<int>))
    ELSE named_struct('i', acc.i, 'p', acc.p - t.b / acc.s, 's', acc.s, 'one', array(x.i)) END), y ->
    CASE WHEN y.p < {TINY} THEN named_struct('i', -1, 'p', 0D, 's', 0D, 'ones', concat(acc.ones, y.one))
         WHEN y.p > 1 - {TINY} THEN named_struct('i', -1, 'p', 0D, 's', 0D, 'ones', concat(acc.ones, y.one, array(y.i)))
         ELSE named_struct('i', y.i, 'p', y.p, 's', y.s, 'ones', concat(acc.ones, y.one)) END)[0])[0]
"""
_FOLD = f"""
aggregate(transform(items, (e, k) -> named_struct('i', k, 'p', e.p, 's', e.s, 'u', e.u)),
  named_struct('i', -1, 'p', 0D, 's', 0D, 'ones', cast(array() AS array<int>)),
  (acc, x) -> CASE WHEN acc.i < 0 THEN named_struct('i', x.i, 'p', x.p, 's', x.s, 'ones', acc.ones) ELSE {_MEET} END)
"""


def _folded(rows: DataFrame, last: bool) -> DataFrame:
    """rows: sid, n (so many of the source), h, key, p, s. One row a block: sid, blk, items, left (i, p, s, ones)."""
    n = F.greatest(F.ceil(F.col("n") / F.lit(BLOCK)), F.lit(1)) if not last else F.lit(1)
    item = F.struct("h", "key", "p", "s", _uniform(F.col("h"), F.lit(SEED + 1)).alias("u"))
    blocks = rows.withColumn("blk", F.pmod(F.shiftright("h", 8), n)).groupBy("sid", "blk").agg(F.sort_array(F.collect_list(item)).alias("items"), F.first("n").alias("n"))
    return blocks.withColumn("left", F.expr(_FOLD))


def _rounded(roots: DataFrame) -> DataFrame:
    """The roots with v, what becomes of the document that is left, and ones, in which one document of about the words
    that this rounding adds or takes has changed sides, if that brings the source nearer to its target."""
    roots = roots.withColumn("v", F.when(F.col("left.p") >= 0.5, 1).otherwise(0))
    roots = roots.withColumn("e", F.when(F.col("left.i") >= 0, (F.col("v") - F.col("left.p")) * F.col("left.s")).otherwise(F.lit(0.0)))
    others = F.filter(F.transform("items", lambda x, k: F.struct(F.abs(F.abs("e") - x["s"]).alias("d"), k.alias("k"))), lambda c: (c["k"] != F.col("left.i")) & (F.array_contains("left.ones", c["k"]) == (F.col("e") > 0)))
    roots = roots.withColumn("best", F.array_min(others))
    flip = F.when(F.col("best.d") < F.abs("e"), F.col("best.k"))
    ones = F.when(flip.isNull(), F.col("left.ones")).when(F.col("e") > 0, F.array_except("left.ones", F.array(flip))).otherwise(F.concat("left.ones", F.array(flip)))
    return roots.withColumn("ones", ones)


def mix_decisions(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """doc_id, size, source_size, target, copies of each row."""
    spark = docs.sparkSession
    stage = Staging(spark, "mix")
    sizes = stage.write(docs.select("doc_id", "source", F.size(words_of(F.col("text"))).cast("long").alias("size")), "sizes")
    sources = stage.write(source_targets(sizes, weights, share, most).coalesce(1), "sources")  # its file size tells Spark whether to broadcast it
    named = sizes.withColumnRenamed("source", "of").join(sources, F.col("of").eqNullSafe(F.col("source"))).drop("of", "source")
    named = named.withColumn("c", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0)))
    named = named.withColumn("sure", F.floor(F.col("c") + TINY)).withColumn("p", F.col("c") - F.col("sure"))
    whole = (F.col("p") < TINY) | (F.col("size") == 0)
    certain = named.where(whole).select("doc_id", "size", "source_size", "target", F.when(F.col("size") == 0, F.lit(1)).otherwise(F.col("sure")).cast("long").alias("copies"))

    rows = named.where(~whole).withColumn("h", F.xxhash64("doc_id", F.lit(SEED))).select("sid", "n", "h", F.struct("doc_id", "size", "source_size", "target", "sure").alias("key"), "p", F.col("size").cast("double").alias("s"))
    most_rows = sources.agg(F.max("n")).first()[0] or 0
    levels = max(1, math.ceil(math.log(max(most_rows, 1)) / math.log(BLOCK) - 0.05))
    up: list[DataFrame] = []
    for level in range(levels):
        blocks = stage.write(_folded(rows, level == levels - 1), f"level{level}")
        up.append(blocks)
        rows = blocks.where("left.i >= 0").select("sid", F.ceil(F.col("n") / F.lit(BLOCK)).alias("n"), F.xxhash64("blk", F.lit(level), F.lit(SEED)).alias("h"), F.struct("blk").alias("key"), F.col("left.p").alias("p"), F.col("left.s").alias("s"))

    above = None  # sid, blk, v: what became of the block's left document
    for blocks in reversed(up):
        if above is None:
            known = _rounded(blocks)
        else:
            known = blocks.join(above, ["sid", "blk"], "left").withColumn("ones", F.col("left.ones"))
        each = known.select("sid", F.col("left.i").alias("li"), "ones", "v", F.posexplode("items").alias("i", "item"))
        got = F.when(F.col("i") == F.col("li"), F.col("v")).otherwise(F.array_contains("ones", F.col("i")).cast("int"))
        above = each.select("sid", F.col("item.key.*"), got.alias("v"))
    rounded = above.select("doc_id", "size", "source_size", "target", (F.col("sure") + F.col("v")).cast("long").alias("copies"))
    return rounded.unionByName(certain)


def repeat_documents(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows of docs, each as often as decided. Rows that share a doc_id, null too, take its decisions in the order of their sizes."""
    left = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.size(words_of(F.col("text"))).cast("long").alias("size"), "doc_id")
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("size"))
    left = left.withColumn("nth", nth)
    right = decisions.select(F.col("doc_id").alias("of"), "size", "copies").withColumn("k", F.row_number().over(Window.partitionBy("of").orderBy("size"))).drop("size")
    out = left.join(right, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("nth") == F.col("k"))).where("copies > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix_decisions(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
