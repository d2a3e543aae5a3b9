"""Whole workflows from the operators: cleaning, contigs, scaffolds, misassembly checks, reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quality import lead_trail, phred, sliding_window_cut, trim_tail
from ..operators import cluster, coverage, graph, kmers, lengths, links, moments, scaffold


@dataclass
class Cleaning:
    """Trim and filter settings of the cleaning stage."""

    leading: int = 3
    trailing: int = 3
    window: int = 4
    window_least: int = 15
    least_length: int = 36
    tail: int = 25
    least_good: int = 20
    offset: int = 33


def clean_reads(reads: DataFrame, c: Cleaning = Cleaning()) -> DataFrame:
    """The reads (seq, qual) trimmed at both ends, at the first poor window, and at the tail; those too short, or with a mean quality below least_good, go."""
    rows = reads.withColumn("__q", phred(F.col("qual"), c.offset))
    ends = lead_trail(F.col("__q"), max(c.leading, c.trailing))
    rows = rows.withColumn("__e", ends).withColumn("__n", F.greatest(F.col("__e.last") - F.col("__e.first") + 1, F.lit(0)))
    cut = lambda n: [F.expr(f"substring({x}, __e.first, {n})") for x in ("seq", "qual")]
    s, q = cut("__n")
    rows = rows.withColumn("seq", s).withColumn("qual", q).withColumn("__q", F.expr("slice(__q, __e.first, __n)"))
    keep = F.least(sliding_window_cut(F.col("__q"), c.window, c.window_least), trim_tail(F.col("__q"), c.tail))
    rows = rows.withColumn("__k", keep).withColumn("seq", F.expr("left(seq, __k)")).withColumn("qual", F.expr("left(qual, __k)")).withColumn("__q", F.expr("slice(__q, 1, __k)"))
    mean = F.aggregate("__q", F.lit(0), lambda a, x: a + x) / F.nullif(F.size("__q"), F.lit(0))
    return rows.where((F.char_length("seq") >= c.least_length) & (mean >= c.least_good)).drop("__q", "__e", "__n", "__k")


def assemble_contigs(reads: DataFrame, ks: list[int], least: int = 2, least_length: int = 0) -> DataFrame:
    """seq, kmers, total, coverage: contigs of reads (read, seq) with growing k: each round cleans its graph (tips, bubbles, low coverage) and hands its contigs to the next as reads."""
    rows = reads.select("read", "seq")
    tigs = None
    for k in ks:
        counts = kmers.kmer_counts(rows, "seq", k, least=least if tigs is None else 1)
        if tigs is not None:  # the contigs so far support their k-mers once; reads decide with least
            solid = kmers.kmer_counts(reads, "seq", k, least=least)
            counts = counts.join(solid.select("kmer"), "kmer", "left_semi").unionByName(counts.join(solid.select("kmer"), "kmer", "left_anti").join(kmers.kmer_counts(tigs.select("seq"), "seq", k).select("kmer"), "kmer", "left_semi"))
        cleaned = graph.pop_bubbles(graph.remove_tips(graph.kept(counts), k, k), k)
        tigs = graph.kept(graph.unitigs(cleaned, k))
        rows = reads.select("read", "seq").unionByName(tigs.select(F.sha2("seq", 256).alias("read"), "seq"))
    return tigs.where(F.char_length("seq") >= least_length)


def insert_model(pairs: DataFrame, libraries: int) -> list[tuple[float, float]]:
    """Ranges of insert sizes that belong to the libraries, from a mixture fitted to the histogram."""
    inserts = links.insert_sizes(pairs).select("insert")
    return cluster.signal_clusters(cluster.best_mixture(inserts, "insert"), libraries)


def misassemblies(pairs: DataFrame, contigs: DataFrame, ranges: list[tuple[float, float]], read: int, least_span: int = 1000) -> DataFrame:
    """ctg1, ctg2, cluster and its box: dense groups of pairs that no library explains: pairs outside all insert ranges, clustered in the plane of their two contigs."""
    odd = pairs.where(F.col("ctg1") != F.col("ctg2"))
    same = pairs.where(F.col("ctg1") == F.col("ctg2")).withColumn("__i", F.col("pos2") - F.col("pos1") + F.col("len2"))
    for lo, hi in ranges:
        same = same.where(~F.col("__i").between(lo, hi))
    odd = odd.unionByName(same.drop("__i"))
    tally = coverage.window_tally(odd, coverage.concatenated_offsets(contigs.select(F.col("name").alias("ctg1"), "len"), "ctg1", "len"), "ctg1", "pos1", 1000)
    p = cluster.density_from_windows(tally, 1000).first()
    chance = min(max(p.p or 1e-4, 1e-6), 0.5)
    import math

    eps = max(read, math.log(1e-4) / math.log1p(-chance) - 1)
    least = max(2, int(chance * 2 * eps))
    found = cluster.dbscan(odd.select("ctg1", "ctg2", "qname", "pos1", "pos2"), ["ctg1", "ctg2"], "qname", "pos1", "pos2", eps, least)
    boxes = cluster.bounding_boxes(odd.join(found, ["ctg1", "ctg2", "qname"]), ["ctg1", "ctg2"], "cluster", "pos1", "pos2")
    near_end = lambda c, lo, hi: (F.col(lo) > least_span) & (F.col(hi) < F.col(c) - least_span)
    sized = boxes.join(contigs.select(F.col("name").alias("ctg1"), F.col("len").alias("len1")), "ctg1").join(contigs.select(F.col("name").alias("ctg2"), F.col("len").alias("len2")), "ctg2")
    return sized.where(near_end("len1", "xmin", "xmax") | near_end("len2", "ymin", "ymax")).drop("len1", "len2")


def scaffold_library(contigs: DataFrame, pairs: DataFrame, insert: float, least: int = 5, ratio: float = 0.7) -> DataFrame:
    """name, seq, len: contigs joined by one library's pairs (ctg, pos, rev, len per mate)."""
    sizes = contigs.select("name", "len")
    rows = pairs.join(sizes.toDF("ctg1", "clen1"), "ctg1").join(sizes.toDF("ctg2", "clen2"), "ctg2")
    layout = scaffold.greedy_layout(sizes, links.contig_links(rows, insert), least, ratio)
    out = scaffold.join_layout(layout, contigs)
    return out.select(F.concat(F.lit("scaffold"), (F.col("scaffold") + 1).cast("string")).alias("name"), "seq", F.char_length("seq").alias("len"))


def scaffold_all(contigs: DataFrame, libraries: list[tuple[DataFrame, float]], place) -> DataFrame:
    """Libraries by ascending insert size, each on the last one's scaffolds; place(contigs, reads) maps a library's reads anew."""
    for reads, insert in sorted(libraries, key=lambda x: x[1]):
        contigs = scaffold_library(contigs, place(contigs, reads), insert)
    return contigs


def report(scaffolds: DataFrame, reads: DataFrame, pileup: DataFrame) -> DataFrame:
    """One row: sequences, bases, longest, mean and N50 of scaffolds (len); reads and read bases (seq); median and 10th percentile depth of covered sites."""
    s = lengths.length_summary(scaffolds, "len", [])
    r = reads.agg(F.count(F.lit(1)).alias("reads"), F.sum(F.char_length("seq")).alias("read_bases"), F.max(F.char_length("seq")).alias("longest_read"))
    d = moments.nearest_rank(pileup.where("depth > 0"), "depth", [], [0.5, 0.1]).toDF("median_depth", "depth_10")
    return s.crossJoin(r).crossJoin(d)  # one row each
