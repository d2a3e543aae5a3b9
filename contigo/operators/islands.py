"""Runs and intervals: gaps and islands, merging, cutting, overlap joins, range exclusion."""

from __future__ import annotations


import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def runs(df: DataFrame, by: list[str], pos: str) -> DataFrame:
    """by, first, last, n: maximal runs of consecutive whole positions (distinct ones)."""
    rows = df.select(*by, F.col(pos).alias("pos")).distinct()
    rows = rows.withColumn("g", F.col("pos") - F.row_number().over(Window.partitionBy(*by).orderBy("pos")))
    return rows.groupBy(*by, "g").agg(F.min("pos").alias("first"), F.max("pos").alias("last"), F.count(F.lit(1)).alias("n")).drop("g")


def sessions(df: DataFrame, by: list[str], order: list[str], is_new: Column) -> DataFrame:
    """The rows with island: a number that grows where is_new (over the row and lags) is true."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("island", F.sum(F.coalesce(is_new.cast("int"), F.lit(1))).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def merge_overlapping(df: DataFrame, by: list[str], start: str, end: str, slack: float = 0) -> DataFrame:
    """by, start, end, n: intervals that overlap (or lie within slack) merged. Nulls sort last, as in SQL: rows without a start count in the last one."""
    w = Window.partitionBy(*by).orderBy(F.col(start).asc_nulls_last(), F.col(end).asc_nulls_last())
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = df.withColumn("__new", (reach.isNull() | (F.col(start) > reach + slack)).cast("int"))
    rows = rows.withColumn("__g", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(*by, "__g").agg(F.min(start).alias(start), F.max(end).alias(end), F.count(F.lit(1)).alias("n")).drop("__g")


def merge_ranges_in_order(df: DataFrame, by: list[str], centre: str, low: str, high: str, most_ratio: float = 2.0) -> DataFrame:
    """by, group, n, low, high: rows in order of centre, joined to the one before if the ranges overlap and the centres differ by a ratio of at most so much."""
    w = Window.partitionBy(*by).orderBy(centre, low, high)
    apart = (F.col(low) > F.lag(high).over(w)) | (F.col(centre) > most_ratio * F.lag(centre).over(w))
    rows = sessions(df, by, [centre, low, high], apart)
    return rows.groupBy(*by, F.col("island").alias("group")).agg(F.count(F.lit(1)).alias("n"), F.min(low).alias("low"), F.max(high).alias("high"))


def gaps(df: DataFrame, by: list[str], start: str, end: str, whole_start: Column, whole_end: Column, least: int = 1) -> DataFrame:
    """by, gap_start, gap_end of stretches of [whole_start, whole_end] (whole, inclusive) that no interval covers, at least so long.
    whole_start and whole_end: columns of df that are equal within a group."""
    merged = df.groupBy(*by, start, end).agg(F.first(whole_start).alias("__a"), F.first(whole_end).alias("__b"))
    w = Window.partitionBy(*by).orderBy(start, end)
    reach = F.coalesce(F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.col("__a") - 1)
    inner = merged.select(*by, (reach + 1).alias("gap_start"), (F.col(start) - 1).alias("gap_end"))
    tail = merged.groupBy(*by).agg((F.max(end) + 1).alias("gap_start"), F.first("__b").alias("gap_end"))
    return inner.unionByName(tail).where(F.col("gap_end") - F.col("gap_start") + 1 >= least)


def outside_ranges(df: DataFrame, value: str, ranges: DataFrame, low: str, high: str, inclusive: bool = True, bins: float | None = None) -> DataFrame:
    """Rows whose value is in none of the ranges. bins: a bin width that turns the test into an equi-join on bins; without it the ranges are few (a library each)."""
    inside = (F.col("__v") >= F.col("__lo")) & (F.col("__v") <= F.col("__hi")) if inclusive else (F.col("__v") > F.col("__lo")) & (F.col("__v") < F.col("__hi"))
    r = ranges.select(F.col(low).alias("__lo"), F.col(high).alias("__hi"))
    rows = df.withColumn("__v", F.col(value))
    if bins is None:
        return rows.join(r, inside, "left_anti").drop("__v")
    r = r.withColumn("__bin", F.explode(F.sequence(F.floor(F.col("__lo") / bins), F.floor(F.col("__hi") / bins))))
    rows = rows.withColumn("__bin", F.floor(F.col("__v") / bins))
    return rows.join(r, (rows["__bin"] == r["__bin"]) & inside, "left_anti").drop("__v", "__bin")


def overlap_join(a: DataFrame, b: DataFrame, by: list[str], width: int) -> DataFrame:
    """Rows of a (a_start, a_end) with those of b (b_start, b_end) that they overlap (inclusive), as an equi-join on bins of a width; each pair once."""
    x = a.withColumn("__bin", F.explode(F.sequence(F.floor(F.col("a_start") / width), F.floor(F.col("a_end") / width))))
    y = b.withColumn("__bin", F.explode(F.sequence(F.floor(F.col("b_start") / width), F.floor(F.col("b_end") / width))))
    hit = x.join(y, [*by, "__bin"]).where("a_start <= b_end AND b_start <= a_end")
    return hit.where(F.col("__bin") == F.floor(F.greatest("a_start", "b_start") / width)).drop("__bin")  # where the overlap begins


def drop_similar_neighbours(df: DataFrame, by: str, start: str, end: str, most: float = 0.5) -> DataFrame:
    """Rows in order of end, walked one by one: where two neighbours' overlap is more than a part of their union, both go. Order matters, so each group is walked in Python; groups are a contig's blocks."""

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([end, start], kind="stable").reset_index(drop=True)
        keep, k = [], 0
        while k < len(pdf):
            if k + 1 < len(pdf):
                a0, a1, b0, b1 = pdf[start][k], pdf[end][k], pdf[start][k + 1], pdf[end][k + 1]
                both = min(a1, b1) - max(a0, b0) + 1
                if both > 0 and both / (max(a1, b1) - min(a0, b0) + 1) > most:
                    k += 2
                    continue
            keep.append(k)
            k += 1
        return pdf.iloc[keep]

    return df.groupBy(by).applyInPandas(walk, df.schema)


def cut_between_neighbours(df: DataFrame, by: list[str], start: str, end: str, nearest: int) -> DataFrame:
    """by, left, right: where neighbouring intervals lie closer than so much, the place to cut: the middle of their overlap (right = left + 1) or the gap between them."""
    w = Window.partitionBy(*by).orderBy(start, end)
    rows = df.withColumn("__next", F.lead(start).over(w)).where(F.col("__next").isNotNull() & (F.col("__next") - F.col(end) < nearest))
    middle = F.floor((F.col(end) + F.col("__next")) / 2)
    return rows.select(*by, F.when(F.col("__next") <= F.col(end), middle).otherwise(F.col(end)).alias("left"), F.when(F.col("__next") <= F.col(end), middle + 1).otherwise(F.col("__next")).alias("right"))


def fuzzy_merge(df: DataFrame, by: list[str], start: str, end: str, slack: int) -> DataFrame:
    """Regions that overlap or lie within slack, merged: a rule that doesn't depend on the order of rows."""
    return merge_overlapping(df, by, start, end, slack)


def near_points(df: DataFrame, by: list[str], key: str, x: str, y: str, eps: float) -> DataFrame:
    """by, key, other: pairs of points with both coordinates within eps, by a join on cells of that size and their neighbours.

    Differences of a float column are held against eps as a float, which may be a little more than eps; cells are wider by more than that and by what rounding adds.
    """
    kinds = dict(df.dtypes)
    near = lambda c, one, other: F.abs(F.col(one) - F.col(other)) <= (F.lit(eps).cast("float") if kinds[c] == "float" else F.lit(eps))
    at = lambda c: F.floor(F.col(c) / F.lit(eps * (1 + 1e-6)))
    cell = df.select(*by, F.col(key).alias("a"), F.col(x).alias("ax"), F.col(y).alias("ay"), at(x).alias("__i"), at(y).alias("__j"))
    around = df.select(*by, F.col(key).alias("b"), F.col(x).alias("bx"), F.col(y).alias("by_"), at(x).alias("__ci"), at(y).alias("__cj"))
    around = around.withColumn("__di", F.explode(F.array(*[F.lit(k) for k in (-1, 0, 1)]))).withColumn("__dj", F.explode(F.array(*[F.lit(k) for k in (-1, 0, 1)])))
    around = around.select(*by, "b", "bx", "by_", (F.col("__ci") + F.col("__di")).alias("__i"), (F.col("__cj") + F.col("__dj")).alias("__j"))
    pairs = cell.join(around, [*by, "__i", "__j"]).where(near(x, "ax", "bx") & near(y, "ay", "by_") & (F.col("a") != F.col("b")))
    return pairs.select(*by, F.col("a").alias(key), F.col("b").alias("other"))
