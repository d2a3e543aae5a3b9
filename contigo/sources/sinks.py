"""Text formats out: each function gives a table with one column, value, and an order to write it in; ``write_lines`` writes it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.sequence import revcomp, wrap


def write_lines(lines: DataFrame, path: str, by: list[str] | None = None, most_records: int | None = None) -> None:
    """Text files of the column value: one folder per value of the columns by (a demultiplexed set), files of at most so many rows."""
    out = lines.write.mode("overwrite")
    if most_records:
        out = out.option("maxRecordsPerFile", most_records)
    if by:
        out = out.partitionBy(*by)
    out.text(path)


def to_fasta(df: DataFrame, name: Column, seq: str, width: int | None = None, keep: list[str] | None = None) -> DataFrame:
    body = wrap(F.col(seq), width) if width else F.col(seq)
    return df.select(*(keep or []), F.concat(F.lit(">"), name, F.lit("\n"), body).alias("value"))


def to_fastq(df: DataFrame, name: Column, seq: str, qual: str | None = None, keep: list[str] | None = None, quality: str = "I") -> DataFrame:
    """Without qualities, every base gets the same."""
    q = F.col(qual) if qual else F.expr(f"repeat('{quality}', char_length({seq}))")
    return df.select(*(keep or []), F.concat(F.lit("@"), name, F.lit("\n"), F.col(seq), F.lit("\n+\n"), q).alias("value"))


def fastq_to_fasta(reads: DataFrame, no_n: bool = False, pair: str | None = None) -> DataFrame:
    """FASTA lines of reads (name, seq); no_n: reads with an N go, and their mates with them if pair names the column that mates share."""
    if no_n and pair:
        bad = reads.where(F.col("seq").rlike("[Nn]")).select(pair).distinct()
        reads = reads.join(bad, pair, "left_anti")
    elif no_n:
        reads = reads.where(~F.col("seq").rlike("[Nn]"))
    return to_fasta(reads, F.col("name"), "seq")


def number_mates(df: DataFrame, header: str, order: str) -> DataFrame:
    """The rows with name: header/1 for the first of a header, header/2 for the others."""
    rn = F.row_number().over(Window.partitionBy(header).orderBy(order))
    return df.withColumn("name", F.concat(F.col(header), F.when(rn == 1, "/1").otherwise("/2")))


def with_length(name: Column, seq: Column) -> Column:
    return F.concat(name, F.lit("|size"), F.char_length(seq).cast("string"))


def with_label(name: Column, label: str) -> Column:
    return F.concat(F.lit(label + "|"), name)


def without_size(name: Column) -> Column:
    return F.regexp_replace(name, r"\|size.*$", "")


def position_pairs(sam: DataFrame, one: str, other: str) -> DataFrame:
    """pos1, pos2 of pairs that join two contigs, whichever mate is on which."""
    from ..operators.links import mates

    m = mates(sam)
    there = m.where((F.col("ctg1") == one) & (F.col("ctg2") == other)).select("pos1", "pos2")
    back = m.where((F.col("ctg1") == other) & (F.col("ctg2") == one) & F.lit(one != other)).select(F.col("pos2").alias("pos1"), F.col("pos1").alias("pos2"))
    return there.unionByName(back)


def maf_to_mfa(maf: DataFrame) -> DataFrame:
    """species, seq: every species' rows joined in block order."""
    return maf.groupBy("species").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "ord", "aln"))), lambda x: x["aln"]), "").alias("seq"))


def mapped_pairs_to_fastq(a: DataFrame, b: DataFrame, cigar: str, tag: str, interleaved: bool = True) -> DataFrame:
    """FASTQ records of reads whose both mates (rows of two SAM tables) have that CIGAR and tag; interleaved: reverse reads are turned back, qualities as they are."""
    ok = lambda d: d.where((F.col("cigar") == cigar) & F.array_contains("tags", tag)).select("qname", "flag", "seq", "qual")
    both = ok(a).toDF("qname", "flag1", "seq1", "qual1").join(ok(b).toDF("qname", "flag2", "seq2", "qual2"), "qname")
    seq = lambda k: F.when((F.col(f"flag{k}") == 16) & F.lit(interleaved), revcomp(F.col(f"seq{k}"))).otherwise(F.col(f"seq{k}"))
    rec = lambda k: F.concat(F.lit("@"), F.col("qname"), F.lit(f"/{k}\n"), seq(k), F.lit("\n+\n"), F.col(f"qual{k}"))
    return both.select(rec(1).alias("value1"), rec(2).alias("value2"))


def stats_line(stats: DataFrame, columns: list[str]) -> DataFrame:
    return stats.select(F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in columns]).alias("value"))


def synteny_maps(points: DataFrame, contig: str, pos: str) -> DataFrame:
    """contig, rank, value: a contig's distinct positions as numbered map lines."""
    rows = points.select(contig, F.col(pos).alias("pos")).distinct()
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(contig).orderBy("pos")))
    return rows.select(contig, "rank", F.concat_ws("\t", F.concat_ws("_", F.col(contig).cast("string"), F.col("pos").cast("string")), F.lit("1")).alias("value"))


def synteny_matches(points: DataFrame, contig1: str, pos1: str, contig2: str, pos2: str, score: str) -> DataFrame:
    """contig1, contig2, value: match lines between the names of synteny_maps, one a pair of positions with its best score."""
    end = lambda c, p: F.concat_ws("_", F.col(c).cast("string"), F.col(p).cast("string"))
    best = points.groupBy(contig1, pos1, contig2, pos2).agg(F.max(score).alias("__best"))
    return best.select(F.col(contig1).alias("contig1"), F.col(contig2).alias("contig2"), F.concat_ws("\t", end(contig1, pos1), end(contig2, pos2), F.col("__best").cast("string")).alias("value"))


def synteny_control(spark: SparkSession, maps: list[tuple[int, str]], matches: list[tuple[int, int, str]]) -> DataFrame:
    """value: the lines of a control file that names map and match files, in order."""
    lines = ["-maps", *(f"{c}\t{path}" for c, path in maps), "end", "-matches", *(f"{a}\t{b}\t{path}" for a, b, path in matches), "end"]
    return spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1)


def sorted_by_length(df: DataFrame, seq: str, key: str) -> DataFrame:
    return df.orderBy(F.char_length(seq).desc(), key)
