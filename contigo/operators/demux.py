"""Barcodes, lanes and trimming routes: which output each read belongs to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.quality import trim_at_low
from ..functions.sequence import hamming

#: Up to this number of barcodes each read is held against all of them; beyond it, against those that share a piece with it.
MOST_BARCODES = 10_000


def with_barcode(reads: DataFrame, barcodes: DataFrame, key: list[str], seq: str, mismatches: int = 1, partial: int = 0, at_end: bool = False) -> DataFrame:
    """The reads with ident, distance: the barcode (ord, ident, barcode) with the fewest mismatches at the read's start (or end), the first one on ties; null beyond the limit.

    partial: barcodes may also have lost up to so many bases at the read's edge, each counted as a mismatch. key names a read where the table of barcodes is large.
    """
    part = F.right if at_end else F.left
    code = F.left if at_end else F.right
    if barcodes.limit(MOST_BARCODES + 1).count() > MOST_BARCODES:
        best = _by_equal_pieces(reads.select(*key, F.col(seq).alias("__s")), barcodes, key, mismatches, partial, part, code)
        return reads.join(best, key, "left")
    table = barcodes.agg(F.collect_list(F.struct("ord", "ident", "barcode")).alias("__codes"))  # one row of at most MOST_BARCODES

    def cost(c: Column) -> Column:
        size = F.char_length(c["barcode"])
        costs = [hamming(part(F.col(seq), size - k), code(c["barcode"], size - k)) + k for k in range(partial + 1)]
        return F.struct((F.least(*costs) if partial else costs[0]).alias("distance"), c["ord"].alias("ord"), c["ident"].alias("ident"))

    best = reads.crossJoin(F.broadcast(table)).withColumn("__best", F.array_min(F.transform("__codes", cost)))
    ok = F.col("__best.distance") <= mismatches
    return best.withColumn("ident", F.when(ok, F.col("__best.ident"))).withColumn("distance", F.when(ok, F.col("__best.distance"))).drop("__codes", "__best")


def _by_equal_pieces(reads: DataFrame, barcodes: DataFrame, key: list[str], mismatches: int, partial: int, part, code) -> DataFrame:
    """key, ident, distance of reads with a barcode within the limit: of mismatches + 1 pieces of a barcode one must be equal, so pieces are the keys of an equi-join."""
    n = mismatches + 1
    kinds = [barcodes.select("ord", "ident", code(F.col("barcode"), F.char_length("barcode") - k).alias("text"), F.lit(k).alias("lost")) for k in range(min(partial, mismatches) + 1)]
    codes = kinds[0]
    for more in kinds[1:]:
        codes = codes.unionByName(more)
    codes = codes.withColumn("size", F.char_length("text"))

    def pieces(text: Column) -> Column:
        cut = lambda j: F.floor(F.col("size") * j / n).cast("int")
        return F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.substring(text, cut(j) + 1, cut(j + 1) - cut(j)).alias("piece")) for j in range(n)]))

    sizes = codes.select("size").distinct()  # a row for each length of a barcode
    rows = reads.crossJoin(F.broadcast(sizes)).withColumn("__s", part(F.col("__s"), F.col("size")))
    rows = rows.select(*key, "__s", "size", pieces(F.col("__s")).alias("p")).select(*key, "__s", "size", "p.*")
    near = rows.join(codes.select("ord", "ident", "text", "lost", "size", pieces(F.col("text")).alias("p")).select("ord", "ident", "text", "lost", "size", "p.*"), ["size", "j", "piece"])
    near = near.withColumn("distance", hamming(F.col("__s"), F.col("text")) + F.col("lost")).where(F.col("distance") <= mismatches)
    return near.groupBy(*key).agg(F.min(F.struct("distance", "ord", "ident")).alias("b")).select(*key, "b.ident", "b.distance")


def best_barcode(reads: DataFrame, barcodes: DataFrame, key: list[str], seq: str, **options) -> DataFrame:
    """key, ident, distance of with_barcode."""
    return with_barcode(reads.select(*key, seq), barcodes, key, seq, **options).select(*key, "ident", "distance")


def demux(reads: DataFrame, barcodes: DataFrame, key: list[str], seq: str, **options) -> DataFrame:
    """The reads with ident, 'unmatched' where no barcode fits, and distance: write it partitioned by ident."""
    return with_barcode(reads, barcodes, key, seq, **options).withColumn("ident", F.coalesce("ident", F.lit("unmatched")))


def demux_counts(matched: DataFrame) -> DataFrame:
    """ident, n, and the grand total in a row 'total'."""
    return matched.groupBy("ident").agg(F.count(F.lit(1)).alias("n")).unionByName(matched.agg(F.lit("total").alias("ident"), F.count(F.lit(1)).alias("n")))


def demux_pairs(pairs: DataFrame, barcodes: DataFrame, key: str, seq1: str, seq2: str, spacer: int = 2, **options) -> DataFrame:
    """The pairs with ident1, ident2, state ('unmatched', 'paired', 'unpaired', 'mispaired'), matched reads clipped by barcode and spacer."""
    both = pairs
    for k, s in ((1, seq1), (2, seq2)):
        both = with_barcode(both, barcodes, [key], s, **options).withColumnRenamed("ident", f"ident{k}").drop("distance")
    state = F.when(F.col("ident1").isNull() & F.col("ident2").isNull(), "unmatched").when(F.col("ident1") == F.col("ident2"), "paired").when(F.col("ident1").isNull() | F.col("ident2").isNull(), "unpaired").otherwise("mispaired")
    cut = barcodes.agg(F.max(F.char_length("barcode")).alias("__cut"))
    both = both.withColumn("state", state).crossJoin(F.broadcast(cut))  # one row
    clip = lambda s, i: F.when(F.col(i).isNotNull(), F.expr(f"substring({s}, __cut + {spacer + 1})")).otherwise(F.col(s)).alias(s)
    rest = [c for c in pairs.columns if c not in (seq1, seq2)]
    return both.select(*rest, clip(seq1, "ident1"), clip(seq2, "ident2"), "ident1", "ident2", "state")


def lane_and_mate(header: Column) -> Column:
    """lane, index, mate of an Illumina header: five colon fields with '#index/mate', or Casava 1.8 with a second part 'mate:filter:control:index'."""
    first, second = F.regexp_extract(header, r"^@?(\S+)", 1), F.regexp_extract(header, r"^\S+\s+(\S+)", 1)
    casava = second != ""
    n = F.size(F.split(first, ":"))
    lane = F.when(casava & (n >= 4), F.get(F.split(first, ":"), F.lit(3))).otherwise(F.get(F.split(first, ":"), F.lit(1)))
    index = F.when(casava, F.substring_index(second, ":", -1)).otherwise(F.regexp_extract(first, r"#([^/]*)", 1))
    mate = F.when(casava, F.substring_index(second, ":", 1)).otherwise(F.regexp_extract(first, r"/([12])$", 1))
    return F.struct(lane.try_cast("int").alias("lane"), index.alias("index"), mate.try_cast("int").alias("mate"))


def trim_route(seq: Column, qual: Column, least: int, k: int, offset: int = 33) -> Column:
    """seq, route: 'hq' (no base below the limit), 'trimmed' (at least k bases before the first), 'lq'."""
    kept = trim_at_low(seq, qual, least, offset)
    n = F.char_length(kept)
    return F.struct(kept.alias("seq"), F.when(n == F.char_length(seq), "hq").when(n >= k, "trimmed").otherwise("lq").alias("route"))


def pair_route(route1: Column, route2: Column) -> Column:
    """Which of nine outputs a pair goes to: both routes, in the order of the mates."""
    return F.concat_ws("_", route1, route2)


def alphabet_repair(seq: Column, flag: int, most_n: int, window: int) -> Column:
    """flag 1: null if any base isn't A, C, G or T; 0: other bases become A, or null if a window of that width holds more than most_n of them; 2: as it is."""
    other = F.regexp_replace(F.upper(seq), "[^ACGT]", "A")
    clean = F.upper(seq).rlike("^[ACGT]*$")
    if flag == 2:
        return seq
    if flag == 1:
        return F.when(clean, seq)
    starts = F.sequence(F.lit(1), F.greatest(F.char_length(seq) - window + 1, F.lit(1)))
    dense = F.exists(starts, lambda i: F.char_length(F.regexp_replace(F.upper(F.substring(seq, i, F.lit(window))), "[ACGT]", "")) > most_n)
    return F.when(clean, F.upper(seq)).when(~dense, other)


def contaminant(sam: DataFrame, least: int = 40, keep_matches: bool = False) -> DataFrame:
    """Reads that match a contaminant with fewer than so many aligned bases (keep_matches: with that many)."""
    from ..functions.alignment import cigar_length

    hit = F.coalesce(cigar_length(F.col("cigar")), F.lit(0)) >= least
    return sam.where(hit if keep_matches else ~hit)
