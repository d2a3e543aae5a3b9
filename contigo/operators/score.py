"""Scoring assemblies against references: substitutions, gaps, precision, coverage, rank agreement."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .islands import gaps as uncovered


def aligned_columns(df: DataFrame, a: str, b: str, keep: list[str] | None = None) -> DataFrame:
    """keep, pos, x, y: the columns of two aligned rows of text, over their common length."""
    cells = F.arrays_zip(F.split(F.col(a), "").alias("x"), F.split(F.col(b), "").alias("y"))
    each = df.select(*(keep or []), F.posexplode(cells).alias("pos", "c"))
    return each.select(*(keep or []), "pos", F.col("c.x").alias("x"), F.col("c.y").alias("y")).where("x IS NOT NULL AND y IS NOT NULL AND x != '' AND y != ''")


def substitution_matrix(df: DataFrame, a: str, b: str, letters: str = "ACGT", by: list[str] | None = None) -> DataFrame:
    """by, x, y, n: aligned pairs of letters; gaps and other characters are skipped."""
    inside = [F.col(c).isin(list(letters)) for c in ("x", "y")]
    return aligned_columns(df, a, b, by).where(inside[0] & inside[1]).groupBy(*(by or []), "x", "y").agg(F.count(F.lit(1)).alias("n"))


def gap_lengths(df: DataFrame, seq: str, by: list[str] | None = None) -> DataFrame:
    """by, length, n of runs of '-', those at the ends too."""
    runs = df.select(*(by or []), F.explode(F.regexp_extract_all(F.col(seq), F.lit("(-+)"), 1)).alias("r"))
    return runs.groupBy(*(by or []), F.char_length("r").alias("length")).agg(F.count(F.lit(1)).alias("n"))


def call_bias(matrix: DataFrame) -> DataFrame:
    """x, y, ratio: of miscalls of x, the part that is y, over an even split among the other letters."""
    wrong = matrix.where("x != y")
    per = wrong.groupBy("x").agg(F.sum("n").alias("t"), F.count(F.lit(1)).alias("k"))
    return wrong.join(per, "x").select("x", "y", (F.col("n") / F.col("t") * F.col("k")).alias("ratio"))


def precision_recall(scores: DataFrame, assembled: str, reference: str, miscalled: str, uncalled: str, extra: str, missed: str) -> DataFrame:
    """The rows with precision and recall of called bases."""
    a, r, m, u, e, s = (F.col(c).cast("double") for c in (assembled, reference, miscalled, uncalled, extra, missed))
    return scores.withColumn("precision", (a - m - u - e) / F.nullif(a, F.lit(0.0))).withColumn("recall", (r - m - u - s) / F.nullif(r, F.lit(0.0)))


def confusion(df: DataFrame, truth: str, call: str) -> DataFrame:
    """One row: tp, fp, fn, tn, precision, recall of two 0/1 columns."""
    c = df.agg(*[F.count_if((F.col(truth) == t) & (F.col(call) == p)).alias(n) for n, t, p in (("tp", 1, 1), ("fp", 0, 1), ("fn", 1, 0), ("tn", 0, 0))])
    return c.withColumn("precision", F.col("tp") / F.nullif(F.col("tp") + F.col("fp"), F.lit(0))).withColumn("recall", F.col("tp") / F.nullif(F.col("tp") + F.col("fn"), F.lit(0)))


def reference_coverage(blocks: DataFrame, references: DataFrame, least_gap: int = 1) -> tuple[DataFrame, DataFrame]:
    """(ref, covered, length, part) and (ref, gap_start, gap_end): blocks: (ref, start, end) 1-based inclusive; references: (ref, length)."""
    rows = blocks.join(references, "ref")
    open_ = uncovered(rows, ["ref"], "start", "end", F.lit(1), F.col("length"), 1)
    missing = open_.groupBy("ref").agg(F.sum(F.col("gap_end") - F.col("gap_start") + 1).alias("open"))
    hit = rows.select("ref").distinct().withColumn("hit", F.lit(True))
    cover = references.join(hit, "ref", "left").join(missing, "ref", "left")
    covered = F.when(F.col("hit"), F.col("length") - F.coalesce("open", F.lit(0))).otherwise(0)
    whole = references.join(rows.select("ref"), "ref", "left_anti").select("ref", F.lit(1).alias("gap_start"), F.col("length").alias("gap_end"))
    found = open_.unionByName(whole).where(F.col("gap_end") - F.col("gap_start") + 1 >= least_gap)
    return cover.select("ref", covered.alias("covered"), "length", (covered / F.col("length")).alias("part")), found


def accepted(hits: DataFrame, similarity: float, least: int, local: bool = False) -> DataFrame:
    """Hits (match, qlen, qfrom, qto) that match a part of the query (local: of the aligned stretch) and are long enough."""
    span = F.col("qto") - F.col("qfrom")
    return hits.where((F.col("match") >= similarity * (span if local else F.col("qlen"))) & (span >= least))


def kendall(df: DataFrame, x: str, y: str, by: str) -> DataFrame:
    """by, n, tau, z of two rankings; tied pairs count -1. Pairs are counted in numpy, one group at a time: groups are the blocks of a contig."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        a, b = pdf[x].to_numpy(float), pdf[y].to_numpy(float)
        n, s = len(a), 0
        for k in range(n - 1):
            s += int(np.where((a[k + 1 :] - a[k]) * (b[k + 1 :] - b[k]) > 0, 1, -1).sum())
        pairs = n * (n - 1) / 2
        tau = s / pairs if pairs else float("nan")
        z = 3 * tau * np.sqrt(n * (n - 1)) / np.sqrt(2 * (2 * n + 5)) if n > 1 else float("nan")
        return pd.DataFrame({by: [pdf[by].iloc[0]], "n": [n], "tau": [tau], "z": [z]})

    kind = dict(df.dtypes)[by]
    return df.groupBy(by).applyInPandas(one, f"{by} {kind}, n long, tau double, z double")


def weighted_chain(hits: DataFrame, by: str, most_overlap: int = 0) -> DataFrame:
    """by, hits, span: the chain of hits (qstart, qend, rstart, rend) in order on both sides with the greatest total query span. One group (a query) at a time, O(n^2)."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values(["qend", "rend"], kind="stable")[["qstart", "qend", "rstart", "rend"]].to_numpy()
        best, count = [], []
        for i, (qs, qe, rs, re_) in enumerate(rows):
            top, n = 0, 0
            for j in range(i):
                if rows[j][1] - most_overlap < qs and rows[j][3] - most_overlap < rs and best[j] > top:
                    top, n = best[j], count[j]
            best.append(top + qe - qs + 1)
            count.append(n + 1)
        k = max(range(len(best)), key=best.__getitem__)
        return pd.DataFrame({by: [pdf[by].iloc[0]], "hits": [count[k]], "span": [int(best[k])]})

    return hits.groupBy(by).applyInPandas(one, f"{by} {dict(hits.dtypes)[by]}, hits long, span long")


def concatenate_summaries(tables: list[DataFrame], order: str) -> DataFrame:
    """The last row, by order, of each table."""
    last = [t.groupBy().agg(F.max_by(F.struct(*[F.col(c) for c in t.columns]), order).alias("r")).select("r.*") for t in tables]
    out = last[0]
    for t in last[1:]:
        out = out.unionByName(t)
    return out


def dense_ranks(df: DataFrame, by: list[str], column: str, name: str) -> DataFrame:
    return df.withColumn(name, F.dense_rank().over(Window.partitionBy(*by).orderBy(column)))
