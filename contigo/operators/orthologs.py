"""Groups by taxa: presence and count matrices, pan and core sizes, singletons, co-occurrence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_matrix(members: DataFrame, group: str, taxon: str, taxa: list[str], presence: bool = False) -> DataFrame:
    """group and a column per taxon: members, or (presence) 1 or 0. The taxa are given, so the pivot needs no extra job."""
    out = members.groupBy(group).pivot(taxon, taxa).agg(F.count(F.lit(1)))
    cell = lambda t: F.coalesce(F.col(f"`{t}`"), F.lit(0))
    return out.select(group, *[(F.least(cell(t), F.lit(1)) if presence else cell(t)).alias(t) for t in taxa])


def pan_core(members: DataFrame, group: str, taxon: str) -> DataFrame:
    """a, b (a < b), pan, core, variable: groups of either taxon, of both, and the part of pan that isn't core."""
    own = members.select(group, F.col(taxon).alias("t")).distinct()
    size = own.groupBy("t").agg(F.count(F.lit(1)).alias("n"))
    both = own.toDF(group, "a").join(own.toDF(group, "b"), group).where("a < b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("core"))
    pairs = size.toDF("a", "na").join(size.toDF("b", "nb"), F.col("a") < F.col("b"))  # one row per pair of taxa
    out = pairs.join(both, ["a", "b"], "left").withColumn("core", F.coalesce("core", F.lit(0))).withColumn("pan", F.col("na") + F.col("nb") - F.col("core"))
    return out.select("a", "b", "pan", "core", ((F.col("pan") - F.col("core")) / F.col("pan")).alias("variable"))


def co_occurrence(members: DataFrame, group: str, taxon: str) -> DataFrame:
    """a, b (a <= b), n: pairs of taxa in one group; n counts groups, or for a = b the groups with two members or more."""
    per = members.groupBy(group, F.col(taxon).alias("t")).agg(F.count(F.lit(1)).alias("m"))
    pairs = per.select(group, F.col("t").alias("a"), "m").join(per.select(group, F.col("t").alias("b")), group).where("a < b OR (a = b AND m > 1)")
    return pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


def core_groups(members: DataFrame, group: str, taxon: str, taxa: int) -> DataFrame:
    """group of those with a member in every one of so many taxa."""
    return members.groupBy(group).agg(F.count_distinct(taxon).alias("t")).where(F.col("t") == taxa).select(group)


def parse_groups(lines: DataFrame, value: str = "value") -> DataFrame:
    """gid, taxon, tag of lines 'gid: taxon|tag taxon|tag ...'."""
    rows = lines.select(F.trim(F.substring_index(value, ":", 1)).alias("gid"), F.explode(F.split(F.trim(F.regexp_extract(value, r"^[^:]*:(.*)$", 1)), r"\s+")).alias("m"))
    return rows.where("m != ''").select("gid", F.substring_index("m", "|", 1).alias("taxon"), F.regexp_extract("m", r"^[^|]*\|(.*)$", 1).alias("tag"))
