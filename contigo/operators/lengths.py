"""Length statistics: histograms, N50 and its kin, summaries, accumulation curves.

Everything runs on a (length, count) histogram per group, so no window ever sees a row per
sequence: the shuffle carries one row per distinct length and group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def length_histogram(df: DataFrame, length: str, by: list[str]) -> DataFrame:
    """by, length, n. Null lengths don't count."""
    return df.where(F.col(length).isNotNull()).groupBy(*by, F.col(length).cast("long").alias("length")).agg(F.count(F.lit(1)).alias("n"))


def nxx(df: DataFrame, length: str, by: list[str], part: float = 0.5, rule: str = "gt") -> DataFrame:
    """by, nxx: the length at which the running total of lengths, longest first, crosses a part of the total.

    rule gt: exceeds it; ge: reaches it; next: the sequence after the one that exceeds it (the last one if there is none).
    """
    h = length_histogram(df, length, by)
    down = Window.partitionBy(*by).orderBy(F.col("length").desc())
    h = h.withColumn("cum", F.sum(F.col("length") * F.col("n")).over(down)).withColumn("total", F.sum(F.col("length") * F.col("n")).over(Window.partitionBy(*by)))
    h = h.withColumn("shorter", F.lead("length").over(down))
    goal = F.col("total") * F.lit(part)
    crossed = h.where(F.col("cum") >= goal if rule == "ge" else F.col("cum") > goal)
    if rule != "next":
        return crossed.groupBy(*by).agg(F.max("length").alias("nxx"))
    before = F.col("cum") - F.col("length") * F.col("n")
    nth = F.floor((goal - before) / F.col("length")) + 1  # the sequence of this length that crosses
    after = F.when(nth < F.col("n"), F.col("length")).otherwise(F.coalesce("shorter", "length"))
    return crossed.groupBy(*by).agg(F.max_by(after, "length").alias("nxx"))


def length_summary(df: DataFrame, length: str, by: list[str]) -> DataFrame:
    """by, n, total, longest, shortest, mean (whole number), n50."""
    h = length_histogram(df, length, by)
    s = h.groupBy(*by).agg(F.sum("n").alias("n"), F.sum(F.col("length") * F.col("n")).alias("total"), F.max("length").alias("longest"), F.min("length").alias("shortest"))
    s = s.withColumn("mean", F.expr("total div n"))
    n50 = nxx(df, length, by).withColumnRenamed("nxx", "n50")
    return s.join(n50, by, "left") if by else s.crossJoin(n50)  # without groups both sides are one row


def accumulation_curve(df: DataFrame, length: str, by: list[str]) -> DataFrame:
    """by, length, sequences, bases: how many sequences of at least that length there are, and their total."""
    down = Window.partitionBy(*by).orderBy(F.col("length").desc())
    h = length_histogram(df, length, by)
    return h.select(*by, "length", F.sum("n").over(down).alias("sequences"), F.sum(F.col("length") * F.col("n")).over(down).alias("bases"))


def ng_length(df: DataFrame, length: str, reference_length: int, part: float = 0.5) -> DataFrame:
    """nxx: as nxx with rule ge, of a part of a known reference length instead of the total; no row if the sequences fall short."""
    down = Window.orderBy(F.col("length").desc())
    h = length_histogram(df, length, []).withColumn("cum", F.sum(F.col("length") * F.col("n")).over(down))
    return h.where(F.col("cum") >= reference_length * part).agg(F.max("length").alias("nxx")).where("nxx IS NOT NULL")


def longer_than(df: DataFrame, length: str, least: int) -> DataFrame:
    return df.where(F.col(length) >= least)


def longest_first(df: DataFrame, length: str, key: str) -> DataFrame:
    """Longest first, equal lengths by key."""
    return df.orderBy(F.col(length).desc(), F.col(key))


def joined_longest_first(df: DataFrame, by: list[str], seq: str, key: str, between: str = "") -> DataFrame:
    """by, seq: the sequences of a group as one, longest first, equal lengths by key."""
    parts = F.array_sort(F.collect_list(F.struct((-F.char_length(seq)).alias("shortness"), F.col(key).alias("key"), F.col(seq).alias("seq"))))
    return df.groupBy(*by).agg(F.array_join(F.transform(parts, lambda p: p["seq"]), between).alias(seq))
