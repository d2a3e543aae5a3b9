"""Coverage and composition along sequences: windows of rows, centred profiles, genome-wide coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def tumbling_windows(df: DataFrame, by: list[str], order: list[str], width: int, values: list[str]) -> DataFrame:
    """by, window, n, mean_<value>: consecutive windows of so many rows per group, the last one short; width -1: the whole group."""
    if width < 0:
        numbered = df.withColumn("window", F.lit(0).cast("long"))
    else:
        rn = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        numbered = df.withColumn("window", F.floor((rn - 1) / F.lit(width)))
    return numbered.groupBy(*by, "window").agg(F.count(F.lit(1)).alias("n"), *[F.avg(v).alias(f"mean_{v}") for v in values])


def centred_profile(df: DataFrame, by: list[str], order: list[str], width: int, value: str) -> DataFrame:
    """The rows with profile: the mean over a window of rows around each, of odd width, cut off at the ends."""
    half = width // 2
    return df.withColumn("profile", F.avg(value).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(-half, half)))


def base_profile(contigs: DataFrame, name: str, seq: str, width: int) -> DataFrame:
    """name, pos (1-based), base, gc: the GC fraction around each base."""
    each = contigs.select(name, F.posexplode(F.split(F.upper(seq), "")).alias("pos", "base")).where("base != ''").withColumn("pos", F.col("pos") + 1)
    each = each.withColumn("is_gc", F.col("base").isin("G", "C").cast("double"))
    return centred_profile(each, [name], ["pos"], width, "is_gc").select(name, "pos", "base", F.col("profile").alias("gc"))


def window_tally(points: DataFrame, offsets: DataFrame, name: str, pos: str, width: int) -> DataFrame:
    """window, n: points on concatenated contigs by windows of a fixed width; offsets: name, offset."""
    at = F.floor((F.col("offset") + F.col(pos) - 1) / F.lit(width))
    return points.join(offsets.select(name, "offset"), name).groupBy(at.alias("window")).agg(F.count(F.lit(1)).alias("n"))


def concatenated_offsets(contigs: DataFrame, order: str, length: str, buckets: int = 256) -> DataFrame:
    """The rows with offset: the total length of the contigs before each, in order (ties: by all the row's columns).

    The running sum is taken within buckets of a hash-free order (ranges of ``order``), whose
    totals, one row each, are summed first: no window holds all rows.
    """
    bounds = contigs.select(F.percentile_approx(order, [k / buckets for k in range(1, buckets)], 10000).alias("b"))
    bucketed = contigs.crossJoin(F.broadcast(bounds)).withColumn("__k", F.size(F.filter(F.array_distinct("b"), lambda x: x < F.col(order)))).drop("b")  # bounds is one row
    totals = bucketed.groupBy("__k").agg(F.sum(length).alias("__t"))
    before = Window.orderBy("__k").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("__k", F.coalesce(F.sum("__t").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("__k").orderBy(order, *[c for c in contigs.columns if c != order]).rowsBetween(Window.unboundedPreceding, -1)
    out = bucketed.join(F.broadcast(totals), "__k").withColumn("offset", F.col("__before") + F.coalesce(F.sum(length).over(inside), F.lit(0)))  # totals: one row a bucket
    return out.drop("__k", "__before")


def site_coverage(pileup: DataFrame, name: str, depth: str) -> DataFrame:
    """name, sites, coverage: mean depth of the sites that are listed."""
    return pileup.groupBy(name).agg(F.count(F.lit(1)).alias("sites"), F.avg(depth).alias("coverage"))


def merge_gc_and_depth(gc: DataFrame, pileup: DataFrame, name: str, pos: str, keep_all: bool = False) -> DataFrame:
    """name, pos, gc, depth of sites that either table lists; only those with a depth above 0 and a GC value, unless keep_all."""
    both = gc.select(name, pos, "gc").join(pileup.select(name, pos, "depth"), [name, pos], "full_outer")
    return both if keep_all else both.where("depth > 0 AND gc >= 0")


def split_by(df: DataFrame, condition, column: str = "part") -> DataFrame:
    """The rows with 'a' where the condition holds and 'b' elsewhere, for a partitioned write."""
    return df.withColumn(column, F.when(condition, "a").otherwise("b"))


def circular_depth(mappings: DataFrame, start: str, length: str, circle: int) -> DataFrame:
    """pos, depth over a circular sequence (1-based), from starts and lengths, by summing changes of depth."""
    a = F.pmod(F.col(start) - 1, F.lit(circle))
    rows = mappings.select(a.alias("a"), F.least(F.col(length), F.lit(circle)).alias("n"))
    parts = rows.select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.least(F.col("a") + F.col("n"), F.lit(circle)).alias("b")), F.struct(F.lit(0).cast("long").alias("a"), F.greatest(F.col("a") + F.col("n") - circle, F.lit(0)).cast("long").alias("b")))).alias("p")).select("p.*").where("b > a")
    each = parts.select(F.explode(F.sequence("a", F.col("b") - 1)).alias("pos"))
    return each.groupBy((F.col("pos") + 1).alias("pos")).agg(F.count(F.lit(1)).alias("depth"))
