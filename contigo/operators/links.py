"""Links between contigs: from read pairs to weighted, oriented edges; insert sizes; libraries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .moments import trimmed_mean


def mates(sam: DataFrame) -> DataFrame:
    """qname and both mates (ctg, pos, rev, len, mapq with suffixes 1 and 2), the one further left on the lesser contig first; only names with two mapped records."""
    from ..functions.alignment import cigar_length, is_reverse

    row = F.struct(F.col("rname").alias("ctg"), F.col("pos"), is_reverse(F.col("flag")).alias("rev"), cigar_length(F.col("cigar")).alias("len"), F.col("mapq"))
    mapped = sam.where("rname != '*' AND pos > 0 AND cigar LIKE '%M%'")
    both = mapped.groupBy("qname").agg(F.sort_array(F.collect_list(row)).alias("m")).where(F.size("m") == 2)
    return both.select("qname", *[F.col("m")[k][c].alias(f"{c}{k + 1}") for k in (0, 1) for c in ("ctg", "pos", "rev", "len", "mapq")])


def insert_sizes(pairs: DataFrame) -> DataFrame:
    """Pairs on one contig, with insert and inward."""
    return pairs.where("ctg1 = ctg2").withColumn("insert", F.col("pos2") - F.col("pos1") + F.col("len2")).withColumn("inward", ~F.col("rev1") & F.col("rev2"))


def orientation_vote(pairs: DataFrame) -> DataFrame:
    """One row: inward, outward, same, orientation (0 inward, 1 outward), mixed (the lesser of both over a tenth)."""
    c = pairs.agg(F.count_if(F.expr("NOT rev1 AND rev2")).alias("inward"), F.count_if(F.expr("rev1 AND NOT rev2")).alias("outward"), F.count_if(F.expr("rev1 = rev2")).alias("same"))
    return c.withColumn("orientation", F.when(F.col("inward") > F.col("outward"), 0).otherwise(1)).withColumn("mixed", F.least("inward", "outward") * 10 > F.col("inward") + F.col("outward"))


def library_estimate(pairs: DataFrame, expected: int) -> DataFrame:
    """One row: n, mean, sd (middle 80 % of inserts), err = min(6 sd / mean, 0.95), enough: at least max(1000, min(4000, a quarter of expected)) pairs."""
    s = trimmed_mean(insert_sizes(pairs), "insert", [])
    return s.withColumn("err", F.least(6 * F.col("sd") / F.col("mean"), F.lit(0.95))).withColumn("enough", F.col("n") >= max(1000, min(4000, expected // 4)))


def contig_links(pairs: DataFrame, insert: float) -> DataFrame:
    """src, src_strand, dst, dst_strand, links, gaps: each pair on two contigs as an edge in both directions, strands f or r in the
    direction of reading on; gap: what the insert leaves after both reads' way to the contigs' ends. pairs need len1, len2, clen1, clen2
    (contig lengths), and distinct read positions (equal pairs count once)."""
    rows = pairs.where("ctg1 != ctg2").dropDuplicates(["ctg1", "pos1", "rev1", "ctg2", "pos2", "rev2"])
    to_end = lambda k: F.when(F.col(f"rev{k}"), F.col(f"pos{k}") + F.col(f"len{k}") - 1).otherwise(F.col(f"clen{k}") - F.col(f"pos{k}") + 1)
    rows = rows.withColumn("gap", F.lit(insert) - to_end(1) - to_end(2))
    strand = lambda k, forward: F.when(F.col(f"rev{k}") == F.lit(not forward), "f").otherwise("r")
    there = rows.select(F.col("ctg1").alias("src"), strand(1, True).alias("src_strand"), F.col("ctg2").alias("dst"), strand(2, False).alias("dst_strand"), "gap")
    back = rows.select(F.col("ctg2").alias("src"), strand(2, True).alias("src_strand"), F.col("ctg1").alias("dst"), strand(1, False).alias("dst_strand"), "gap")
    return there.unionByName(back).groupBy("src", "src_strand", "dst", "dst_strand").agg(F.count(F.lit(1)).alias("links"), F.sum("gap").alias("gaps"))


def mean_distance(links: DataFrame) -> DataFrame:
    """The links with the whole-number mean gap."""
    return links.withColumn("distance", F.expr("cast(gaps AS bigint) div links"))


def degrees(links: DataFrame) -> DataFrame:
    """contig, neighbours (other contigs), self_links."""
    return links.groupBy(F.col("src").alias("contig")).agg(F.count_distinct(F.when(F.col("src") != F.col("dst"), F.col("dst"))).alias("neighbours"), F.count_if(F.expr("src = dst")).alias("self_links"))


def pair_states(pairs: DataFrame, insert: float, err: float) -> DataFrame:
    """One row: satisfied, wrong_distance, wrong_orientation, between: how pairs keep to their library."""
    ins = F.col("pos2") - F.col("pos1") + F.col("len2")
    one, right = F.col("ctg1") == F.col("ctg2"), ~F.col("rev1") & F.col("rev2")
    near = F.abs(ins - insert) <= insert * err
    return pairs.agg(F.count_if(one & right & near).alias("satisfied"), F.count_if(one & right & ~near).alias("wrong_distance"), F.count_if(one & ~right).alias("wrong_orientation"), F.count_if(~one).alias("between"))


def repeat_contigs(links: DataFrame, least: int) -> DataFrame:
    """contig, strand: contigs with links of that weight to two contigs or more on one side that don't link each other: repeats that scaffolds shouldn't run through."""
    strong = links.where(F.col("links") >= least)
    fan = strong.groupBy("src", "src_strand").agg(F.count_distinct("dst").alias("d")).where("d > 1").select("src", "src_strand")
    two = strong.join(fan, ["src", "src_strand"], "left_semi").select("src", "src_strand", "dst")
    apart = two.toDF("src", "src_strand", "x").join(two.toDF("src", "src_strand", "y"), ["src", "src_strand"]).where("x < y")
    apart = apart.join(strong.select(F.col("src").alias("x"), F.col("dst").alias("y")).distinct(), ["x", "y"], "left_anti")
    return apart.select(F.col("src").alias("contig"), F.col("src_strand").alias("strand")).distinct()


def terminal(links: DataFrame, contigs: DataFrame, ctg: str, pos: str, reach: int, read: int) -> DataFrame:
    """The rows with terminal: -1 near the contig's start, 1 near its end, 0 inside. contigs: name, len."""
    rows = links.join(contigs.select(F.col("name").alias(ctg), F.col("len").alias("__len")), ctg)
    return rows.withColumn("terminal", F.when(F.col(pos) <= reach, -1).when(F.col(pos) + read - 1 > F.col("__len") - reach, 1).otherwise(0)).drop("__len")


def expected_pairs(reads: float, insert: float, genome: float) -> float:
    return reads * insert / genome


def systematic_sample(df: DataFrame, ordinal: str, step: int, handful: int) -> DataFrame:
    """The first handful rows of every step, by ordinal."""
    return df.where(F.pmod(F.col(ordinal), F.lit(step)) < handful)


def first_and_last(df: DataFrame, ordinal: str, each: int) -> DataFrame:
    """The first and the last so many rows, by ordinals from 0 without gaps."""
    last = df.agg(F.max(ordinal).alias("__last"))
    return df.crossJoin(F.broadcast(last)).where((F.col(ordinal) < each) | (F.col(ordinal) > F.col("__last") - each)).drop("__last")  # one row


def ends_of_contigs(contigs: DataFrame, name: str, seq: str, reach: int) -> DataFrame:
    """name, side, seq: only the ends that an insert can reach from; contigs shorter than both ends stay whole."""
    n = F.char_length(seq)
    short = contigs.where(n <= 2 * reach).select(name, F.lit("whole").alias("side"), F.col(seq))
    long = contigs.where(n > 2 * reach).select(name, F.explode(F.array(F.struct(F.lit("start").alias("side"), F.left(F.col(seq), F.lit(reach)).alias(seq)), F.struct(F.lit("end").alias("side"), F.right(F.col(seq), F.lit(reach)).alias(seq)))).alias("e"))
    return short.unionByName(long.select(name, "e.side", f"e.{seq}"))


def ranked(df: DataFrame, by: list[str], order: list[str], name: str = "rank") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
