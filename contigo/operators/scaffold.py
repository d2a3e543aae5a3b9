"""Scaffolds: layouts from links, gaps and merges, splits, AGP tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import overlap_length, revcomp
from .coverage import concatenated_offsets
from .graph import components
from .staging import kept


def split_at_n(scaffolds: DataFrame, name: str, seq: str, least: int = 1) -> DataFrame:
    """name, part (1-based), start (1-based), seq: pieces between runs of at least so many N's, without them at the ends."""
    run = rf"[Nn]{{{least},}}"
    pieces = F.split(F.col(seq), run)
    gaps = F.regexp_extract_all(F.col(seq), F.lit(f"({run})"), 1)
    rows = scaffolds.select(name, F.posexplode(F.arrays_zip(pieces.alias("p"), gaps.alias("g"))).alias("k", "x")).select(name, "k", F.col("x.p").alias("p"), F.coalesce(F.char_length("x.g"), F.lit(0)).alias("g")).where("p IS NOT NULL")
    before = F.coalesce(F.sum(F.char_length("p") + F.col("g")).over(Window.partitionBy(name).orderBy("k").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("start", before + 1).where("p != ''")
    return rows.select(name, F.row_number().over(Window.partitionBy(name).orderBy("k")).alias("part"), F.col("start").cast("int").alias("start"), F.col("p").alias(seq))


def agp(scaffolds: DataFrame, name: str, seq: str, least_gap: int = 10, least_piece: int = 200) -> DataFrame:
    """object, object_beg, object_end, part, type, and columns 6 to 9: W lines of pieces and N lines of the gaps between them.

    Runs of N of at least least_gap part pieces; shorter pieces than least_piece count as gap; N's at the ends of an object are cut off;
    objects with fewer known bases than least_piece are left out.
    """
    pieces = split_at_n(scaffolds, name, seq, least_gap).withColumn("len", F.char_length(seq)).where(F.col("len") >= least_piece)
    w = Window.partitionBy(name).orderBy("start")
    first = F.min("start").over(Window.partitionBy(name))
    pieces = pieces.withColumn("beg", F.col("start") - first + 1).withColumn("end", F.col("beg") + F.col("len") - 1).withColumn("k", F.row_number().over(w)).withColumn("prev", F.lag("end").over(w))
    contig = F.concat(F.col(name), F.lit("_c"), F.col("k").cast("string"))
    text = lambda c: c.cast("string")
    lines = pieces.select(name, F.col("beg").alias("object_beg"), F.col("end").alias("object_end"), (2 * F.col("k") - 1).alias("part"), F.lit("W").alias("type"), contig.alias("c6"), F.lit("1").alias("c7"), text(F.col("len")).alias("c8"), F.lit("+").alias("c9"))
    gaps = pieces.where("prev IS NOT NULL").select(name, (F.col("prev") + 1).alias("object_beg"), (F.col("beg") - 1).alias("object_end"), (2 * F.col("k") - 2).alias("part"), F.lit("N").alias("type"), text(F.col("beg") - F.col("prev") - 1).alias("c6"), F.lit("scaffold").alias("c7"), F.lit("yes").alias("c8"), F.lit("paired-ends").alias("c9"))
    return lines.unionByName(gaps).withColumnRenamed(name, "object")


def single_pieces(parts: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Parts of scaffolds of one part, and of several."""
    n = parts.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(name)))
    return n.where("__n = 1").drop("__n"), n.where("__n > 1").drop("__n")


def break_at(scaffolds: DataFrame, name: str, seq: str, cuts: DataFrame) -> DataFrame:
    """name, part, start, seq: scaffolds cut at (name, left, right): a piece ends at left and the next begins at right; what lies between goes. Scaffolds without cuts stay whole."""
    ends = scaffolds.select(name, F.lit(1).cast("long").alias("beg")).unionByName(cuts.select(name, F.col("right").cast("long").alias("beg")))
    stops = cuts.select(name, F.col("left").cast("long").alias("end")).unionByName(scaffolds.select(name, F.char_length(seq).cast("long").alias("end")))
    number = lambda df, c: df.withColumn("part", F.row_number().over(Window.partitionBy(name).orderBy(c)))
    return number(ends, "beg").join(number(stops, "end"), [name, "part"]).join(scaffolds.select(name, seq), name).where("end >= beg").select(name, "part", F.col("beg").alias("start"), F.substring(F.col(seq), F.col("beg").cast("int"), (F.col("end") - F.col("beg") + 1).cast("int")).alias(seq))


def greedy_layout(contigs: DataFrame, links: DataFrame, least: int = 5, ratio: float = 0.7) -> DataFrame:
    """scaffold (0 is the one with the longest seed), place, contig, strand, links, gap: the longest contig first, extended at both ends by the best supported link.

    A step needs at least so many links; where there are rivals, the second best must have less than a part ratio of the best's links.
    No step leaves a component of such links, so components are walked apart, one in one task; contigs without links need no walk.
    """
    schema = "seed string, size long, place int, contig string, strand string, links long, gap double"
    turn = {"f": "r", "r": "f"}

    def walk(edges: pd.DataFrame, named: pd.DataFrame) -> pd.DataFrame:
        out: dict = {}
        for src, strand, dst, turned, n, gap in zip(edges["src"], edges["src_strand"], edges["dst"], edges["dst_strand"], edges["links"], edges["gap"]):
            out.setdefault((src, strand), []).append((n, dst, turned, gap))
        sizes, used, rows = dict(zip(named["name"], named["len"])), set(), []

        def extend(contig: str, strand: str) -> list:
            path = []
            while True:
                free = sorted((x for x in out.get((contig, strand), []) if x[1] not in used), key=lambda x: (-x[0], x[1]))
                if not free or len(free) > 1 and free[1][0] >= ratio * free[0][0]:
                    return path
                n, contig, strand, gap = free[0]
                used.add(contig)
                path.append((contig, strand, n, gap))

        for seed in sorted(sizes, key=lambda c: (-sizes[c], c)):
            if seed in used:
                continue
            used.add(seed)
            ahead = extend(seed, "f")
            behind = extend(seed, "r")
            line = [(c, turn[s]) for c, s, _, _ in reversed(behind)] + [(seed, "f")] + [(c, s) for c, s, _, _ in ahead]
            steps = [(n, g) for _, _, n, g in reversed(behind)] + [(n, g) for _, _, n, g in ahead]
            rows += [(seed, sizes[seed], p, c, s, *(steps[p] if p < len(steps) else (None, None))) for p, (c, s) in enumerate(line)]
        return pd.DataFrame(rows, columns=["seed", "size", "place", "contig", "strand", "links", "gap"]).astype({"links": "Int64", "gap": "Float64"})

    strong = kept(links.where(F.col("links") >= least).select("src", "src_strand", "dst", "dst_strand", "links", (F.col("gaps") / F.col("links")).alias("gap")))
    of = kept(components(strong, "src", "dst").toDF("name", "component"))
    sized = contigs.select("name", F.col("len").cast("long").alias("len")).join(of.toDF("name", "among"), "name", "left")
    linked = strong.join(of.toDF("src", "component"), "src").groupBy("component").cogroup(sized.where("among IS NOT NULL").groupBy("among")).applyInPandas(walk, schema)
    alone = sized.where("among IS NULL").selectExpr("name AS seed", "len AS size", "0 AS place", "name AS contig", "'f' AS strand", "cast(NULL AS long) AS links", "cast(NULL AS double) AS gap")
    layout = kept(linked.unionByName(alone))
    seeds = concatenated_offsets(layout.select("seed", (-F.col("size")).alias("shortness"), F.lit(1).alias("one")).distinct(), "shortness", "one")
    return layout.join(seeds.select("seed", F.col("offset").alias("scaffold")), "seed").select("scaffold", "place", "contig", "strand", "links", "gap")


def join_layout(layout: DataFrame, contigs: DataFrame, least_overlap: int = 15, most_overlap: int = 50) -> DataFrame:
    """scaffold, seq: contigs (name, seq) of a layout in order; neighbours whose ends overlap exactly are merged, in lower case, others get N's for their gap (one n where it is not positive)."""
    rows = layout.join(contigs.select(F.col("name").alias("contig"), "seq"), "contig")
    rows = rows.withColumn("seq", F.when(F.col("strand") == "r", revcomp(F.col("seq"))).otherwise(F.col("seq")))
    w = Window.partitionBy("scaffold").orderBy("place")
    rows = rows.withColumn("next", F.lead("seq").over(w)).withColumn("o", overlap_length(F.upper("seq"), F.upper(F.coalesce("next", F.lit(""))), least_overlap, most_overlap))
    rows = rows.withColumn("cut", F.coalesce(F.lag("o").over(w), F.lit(0)))
    filler = F.when(F.col("next").isNull() | (F.col("o") > 0), "").when(F.col("gap") >= 1, F.expr("repeat('N', cast(round(gap) AS int))")).otherwise("n")
    body = F.expr("substring(seq, cut + 1, char_length(seq) - cut - o)")
    shared = F.when(F.col("o") > 0, F.lower(F.expr("right(seq, o)"))).otherwise("")
    rows = rows.withColumn("piece", F.concat(body, shared, filler))
    return rows.groupBy("scaffold").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "piece"))), lambda x: x["piece"]), "").alias("seq"))


def extend_contig(reads: list[str], contig: str, least_overlap: int = 16, least: int = 2, ratio: float = 0.9, most: int = 1000) -> str:
    """A contig extended at its right end by votes of reads that overlap it: stops at fewer than least votes, below a part ratio of them for the best base, or at a tie."""
    index: dict[str, list[tuple[str, int]]] = {}
    for r in reads:
        for i in range(len(r) - least_overlap):
            index.setdefault(r[i : i + least_overlap], []).append((r, i + least_overlap))
    grown = contig
    while len(grown) - len(contig) < most:
        votes: dict[str, int] = {}
        for r, at in index.get(grown[-least_overlap:], []):
            if grown.endswith(r[:at]) or r[:at].endswith(grown[-at:]):
                votes[r[at]] = votes.get(r[at], 0) + 1
        ranked = sorted(votes.items(), key=lambda x: (-x[1], x[0]))
        total = sum(votes.values())
        if not ranked or ranked[0][1] < least or ranked[0][1] / total < ratio or (len(ranked) > 1 and ranked[0][1] == ranked[1][1]):
            break
        grown += ranked[0][0]
    return grown


def extend_contigs(recruited: DataFrame, **options) -> DataFrame:
    """contig, seq of (contig, seq, read): each contig with the reads recruited to its ends, one contig at a time."""
    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        reads = [r for r in pdf["read"] if isinstance(r, str)]
        return pd.DataFrame({"contig": [pdf["contig"].iloc[0]], "seq": [extend_contig(reads, pdf["seq"].iloc[0], **options)]})

    return recruited.groupBy("contig").applyInPandas(one, "contig string, seq string")


def local_assembly(recruited: DataFrame, least_k: int = 21, step: int = 10, most_k: int = 51) -> DataFrame:
    """contig_end, seq: the reads recruited to each contig end assembled on their own, with growing k, until one contig is left or the reads are too short."""
    def turned(s: str) -> str:
        return s[::-1].translate(str.maketrans("ACGT", "TGCA"))

    def assemble(reads: list[str], k: int) -> list[str]:
        n: dict[str, int] = {}
        for r in reads:
            for s in (r, turned(r)):
                for i in range(len(s) - k + 1):
                    n[s[i : i + k]] = n.get(s[i : i + k], 0) + 1
        after = lambda x: [x[1:] + b for b in "ACGT" if x[1:] + b in n]
        before = lambda x: [b + x[:-1] for b in "ACGT" if b + x[:-1] in n]
        seen, out = set(), []
        for start in sorted(n):
            if start in seen:
                continue
            path = [start]
            seen |= {start, turned(start)}
            for forward in (True, False):
                while True:
                    end = path[-1] if forward else path[0]
                    nxt = after(end) if forward else before(end)
                    if len(nxt) != 1 or nxt[0] in seen or len(before(nxt[0]) if forward else after(nxt[0])) != 1:
                        break
                    seen |= {nxt[0], turned(nxt[0])}
                    path = [*path, nxt[0]] if forward else [nxt[0], *path]
            out.append(path[0] + "".join(x[-1] for x in path[1:]))
        return out

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        reads, best = [r for r in pdf["read"] if isinstance(r, str)], []
        for k in range(least_k, most_k + 1, step):
            got = assemble(reads, k)
            if not got:
                break
            best = got
            if len(got) == 1:
                break
            reads = reads + got
        return pd.DataFrame({"contig_end": [pdf["contig_end"].iloc[0]] * len(best), "seq": best})

    return recruited.groupBy("contig_end").applyInPandas(one, "contig_end string, seq string")
