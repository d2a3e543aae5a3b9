"""k-mer tables: counts, edge masks, spectra, shared sets, seed alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sequence import canonical, kmers, pieces, revcomp

#: Bit of each base in an edge mask. Fixed values.
BASE_BITS = {"A": 1, "C": 2, "G": 4, "T": 8}


def explode_kmers(df: DataFrame, seq: str, k: int, keep: list[str] | None = None, letters: str | None = "ACGT") -> DataFrame:
    """keep, pos (0-based), kmer; k-mers with other letters are left out (letters None: all stay)."""
    rows = df.select(*(keep or []), F.posexplode(kmers(F.col(seq), k)).alias("pos", "kmer"))
    return rows.where(F.translate(F.col("kmer"), letters, "") == "") if letters else rows


def kmer_counts(df: DataFrame, seq: str, k: int, strands: bool = True, least: int = 1, letters: str | None = "ACGT", by: list[str] | None = None) -> DataFrame:
    """by, kmer, n: strands: a k-mer and its reverse complement count as one. Counts are added up before the shuffle."""
    if not strands:
        return explode_kmers(df, seq, k, by, letters).groupBy(*(by or []), "kmer").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    # both strands of a piece are made once; a k-mer and its complement are then substrings at mirrored places
    cut = df.select(*(by or []), F.explode(pieces(F.col(seq), k)).alias("__s"))
    clean = F.translate("__s", letters, "") == "" if letters else F.lit(True)
    both = cut.select(*(by or []), "__s", revcomp(F.col("__s")).alias("__r"), clean.alias("__clean"))
    n = F.char_length("__s") - k + 1
    pick = lambda i: F.least(F.substring("__s", i, F.lit(k)), F.substring("__r", n - i + 1, F.lit(k)))
    places = F.when(n > 0, F.transform(F.sequence(F.lit(1), n), pick)).otherwise(F.array().cast("array<string>"))
    rows = both.select(*(by or []), "__clean", F.explode(places).alias("kmer"))
    if letters:
        rows = rows.where(F.col("__clean") | (F.translate("kmer", letters, "") == ""))
    return rows.groupBy(*(by or []), "kmer").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def _bit(base) -> F.Column:
    out = F.lit(0)
    for letter, bit in BASE_BITS.items():
        out = F.when(base == letter, bit).otherwise(out)
    return out


def kmer_graph(df: DataFrame, seq: str, k: int, least: int = 1) -> DataFrame:
    """kmer, n, out_mask, in_mask of canonical k-mers: the bases seen after and before each, on its own strand; a palindrome has both in both."""
    wide = df.select(F.concat(F.lit("$"), F.upper(F.col(seq)), F.lit("$")).alias("s"))
    rows = wide.select(F.explode(kmers(F.col("s"), k + 2)).alias("w")).select(F.substring("w", 1, 1).alias("before"), F.expr(f"substring(w, 2, {k})").alias("kmer"), F.substring("w", -1, 1).alias("after"))
    rows = rows.where(F.translate("kmer", "ACGT", "") == "")
    forward = rows.select("kmer", _bit(F.col("before")).alias("i"), _bit(F.col("after")).alias("o"))
    turned = rows.select(revcomp(F.col("kmer")).alias("kmer"), _bit(revcomp(F.col("after"))).alias("i"), _bit(revcomp(F.col("before"))).alias("o"))
    both = forward.where(F.col("kmer") <= revcomp(F.col("kmer"))).withColumn("one", F.lit(1)).unionByName(turned.where(F.col("kmer") <= revcomp(F.col("kmer"))).withColumn("one", (F.col("kmer") != revcomp(F.col("kmer"))).cast("int")))
    return both.groupBy("kmer").agg(F.sum("one").alias("n"), F.bit_or("o").alias("out_mask"), F.bit_or("i").alias("in_mask")).where(F.col("n") >= least)


def refresh_edges(graph: DataFrame, k: int) -> DataFrame:
    """The graph with masks that only name k-mers of the graph: an equi-join on the neighbours."""
    letters = F.array(*[F.lit(b) for b in BASE_BITS])
    bits = F.create_map(*[x for b, v in BASE_BITS.items() for x in (F.lit(b), F.lit(v))])
    out = graph.select("kmer", F.explode(letters).alias("b")).join(graph.select("kmer", "out_mask"), "kmer").where(F.col("out_mask").bitwiseAND(bits[F.col("b")]) != 0).select("kmer", "b", F.lit(1).alias("side"), canonical(F.concat(F.expr(f"right(kmer, {k - 1})"), F.col("b"))).alias("other"))
    into = graph.select("kmer", F.explode(letters).alias("b")).join(graph.select("kmer", "in_mask"), "kmer").where(F.col("in_mask").bitwiseAND(bits[F.col("b")]) != 0).select("kmer", "b", F.lit(0).alias("side"), canonical(F.concat(F.col("b"), F.expr(f"left(kmer, {k - 1})"))).alias("other"))
    held = out.unionByName(into).join(graph.select(F.col("kmer").alias("other")), "other", "left_semi")
    masks = held.groupBy("kmer").agg(F.bit_or(F.when(F.col("side") == 1, bits[F.col("b")]).otherwise(0)).alias("out_mask"), F.bit_or(F.when(F.col("side") == 0, bits[F.col("b")]).otherwise(0)).alias("in_mask"))
    return graph.select("kmer", "n").join(masks, "kmer", "left").select("kmer", "n", F.coalesce("out_mask", F.lit(0)).alias("out_mask"), F.coalesce("in_mask", F.lit(0)).alias("in_mask"))


def spectrum(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """by, multiplicity, kmers: how many k-mers occur so often."""
    return counts.groupBy(*(by or []), F.col("n").alias("multiplicity")).agg(F.count(F.lit(1)).alias("kmers"))


def rescue_between(reads: DataFrame, seq: str, key: str, k: int, solid: DataFrame) -> DataFrame:
    """kmer, n of k-mers that aren't solid themselves but lie in a read between solid ones."""
    from pyspark.sql import Window

    rows = explode_kmers(reads, seq, k, [key]).withColumn("canon", canonical(F.col("kmer"))).join(solid.select(F.col("kmer").alias("canon"), F.lit(1).alias("solid")), "canon", "left")
    w = Window.partitionBy(key).orderBy("pos")
    before = F.max("solid").over(w.rowsBetween(Window.unboundedPreceding, -1))
    after = F.max("solid").over(w.rowsBetween(1, Window.unboundedFollowing))
    rows = rows.withColumn("in", before.isNotNull() & after.isNotNull())
    return rows.where("solid IS NULL AND in").groupBy(F.col("canon").alias("kmer")).agg(F.count(F.lit(1)).alias("n"))


def next_k(reads: DataFrame, seq: str, key: str, k: int, step: int, solid: DataFrame, least: int = 1) -> DataFrame:
    """kmer, n of (k + step)-mers of reads all of whose k-mers are solid: longer k-mers for the next round of assembly."""
    from pyspark.sql import Window

    rows = explode_kmers(reads, seq, k, [key]).withColumn("canon", canonical(F.col("kmer"))).join(solid.select(F.col("kmer").alias("canon"), F.lit(1).alias("solid")), "canon", "left")
    w = Window.partitionBy(key).orderBy("pos").rowsBetween(0, step)
    full = rows.withColumn("held", F.sum(F.coalesce("solid", F.lit(0))).over(w)).where(F.col("held") == step + 1).select(key, "pos")
    longer = explode_kmers(reads, seq, k + step, [key]).join(full, [key, "pos"], "left_semi")
    return longer.groupBy(canonical(F.col("kmer")).alias("kmer")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def seed_align(reads: DataFrame, contigs: DataFrame, k: int, step: int = 1, least_match: float = 0.95, unique: bool = True) -> DataFrame:
    """read, contig, strand, offset (0-based place of the read's first base on the contig), matches, length: ungapped placements by shared k-mers.

    reads: (read, seq); contigs: (contig, seq). Seeds join on the k-mer, read seeds every step bases;
    placements that reach past the contig's ends or match less than a part of the bases are dropped;
    unique: reads with several best placements are dropped.
    """
    both = reads.select("read", F.upper("seq").alias("seq"), F.lit(1).alias("strand")).unionByName(reads.select("read", revcomp(F.upper("seq")).alias("seq"), F.lit(-1).alias("strand")))
    seeds = explode_kmers(both, "seq", k, ["read", "strand"]).where(F.col("pos") % step == 0)
    index = explode_kmers(contigs.withColumn("seq", F.upper("seq")), "seq", k, ["contig"])
    places = seeds.join(index.select("contig", F.col("pos").alias("at"), "kmer"), "kmer").select("read", "strand", "contig", (F.col("at") - F.col("pos")).alias("offset")).distinct()
    placed = places.join(both, ["read", "strand"]).join(contigs.select("contig", F.upper("seq").alias("target")), "contig")
    placed = placed.where((F.col("offset") >= 0) & (F.col("offset") + F.char_length("seq") <= F.char_length("target")))
    part = F.substring("target", F.col("offset") + 1, F.char_length("seq"))
    same = F.aggregate(F.zip_with(F.split("seq", ""), F.split(part, ""), lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda n, x: n + x)
    placed = placed.select("read", "contig", "strand", "offset", same.alias("matches"), F.char_length("seq").alias("length")).where(F.col("matches") >= least_match * F.col("length"))
    if not unique:
        return placed
    best = placed.groupBy("read").agg(F.max("matches").alias("top"))
    top = placed.join(best, "read").where("matches = top").drop("top")
    return top.join(top.groupBy("read").agg(F.count(F.lit(1)).alias("c")).where("c = 1").select("read"), "read", "left_semi")


def base_votes(placed: DataFrame, reads: DataFrame) -> DataFrame:
    """contig, pos, base, votes of aligned reads at each contig position (0-based)."""
    rows = placed.join(reads.select("read", F.upper("seq").alias("seq")), "read")
    seq = F.when(F.col("strand") < 0, revcomp(F.col("seq"))).otherwise(F.col("seq"))
    each = rows.select("contig", "offset", F.posexplode(F.filter(F.split(seq, ""), lambda c: c != "")).alias("k", "base"))
    return each.groupBy("contig", (F.col("offset") + F.col("k")).alias("pos"), "base").agg(F.count(F.lit(1)).alias("votes"))


def consensus(votes: DataFrame, least: int = 1, ratio: float = 4.0) -> DataFrame:
    """contig, pos, base: the base with the most votes, where it has at least so many and more than ratio times the second."""
    ranked = votes.groupBy("contig", "pos").agg(F.sort_array(F.collect_list(F.struct("votes", "base")), asc=False).alias("v"))
    second = F.coalesce(F.get("v", F.lit(1))["votes"], F.lit(0))
    return ranked.where((F.get("v", F.lit(0))["votes"] >= least) & (F.get("v", F.lit(0))["votes"] > ratio * second)).select("contig", "pos", F.get("v", F.lit(0))["base"].alias("base"))


def correct_reads(reads: DataFrame, placed: DataFrame, agreed: DataFrame, most_changes: int = 3) -> DataFrame:
    """read, seq: placed reads with each base as the consensus has it, if all their positions have one and at most so many change; other reads as they are."""
    rows = placed.join(reads.select("read", F.upper("seq").alias("seq")), "read")
    seq = F.when(F.col("strand") < 0, revcomp(F.col("seq"))).otherwise(F.col("seq"))
    each = rows.select("read", "strand", "contig", "offset", F.posexplode(F.filter(F.split(seq, ""), lambda c: c != "")).alias("k", "old"))
    each = each.withColumn("pos", F.col("offset") + F.col("k")).join(agreed, ["contig", "pos"], "left")
    new = each.groupBy("read", "strand").agg(
        F.sort_array(F.collect_list(F.struct("k", F.coalesce("base", "old").alias("b")))).alias("l"), F.sum((F.col("base") != F.col("old")).cast("int")).alias("changes"), F.sum(F.col("base").isNull().cast("int")).alias("open")
    )
    fixed = F.array_join(F.transform("l", lambda x: x["b"]), "")
    new = new.where((F.col("open") == 0) & (F.col("changes") <= most_changes)).select("read", F.when(F.col("strand") < 0, revcomp(fixed)).otherwise(fixed).alias("fixed"))
    return reads.join(new, "read", "left").select("read", F.coalesce("fixed", "seq").alias("seq"))
