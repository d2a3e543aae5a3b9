"""Means, spreads and quantiles: plain, weighted, trimmed, by nearest rank, from histograms."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sample_moments(df: DataFrame, x: str, y: str, by: list[str]) -> DataFrame:
    """Sample mean, variance, covariance, correlation and adjusted skewness (n - 1 denominators)."""
    n = F.count(x).cast("double")
    skew = F.when(n > 2, F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2))
    return df.groupBy(*by).agg(F.count(x).alias("n"), F.avg(x).alias("mean"), F.var_samp(x).alias("var"), F.covar_samp(x, y).alias("cov"), F.corr(x, y).alias("cor"), skew.alias("skew"))


def population_moments(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """mean_<x>, var_<x> and cov_<x>_<y> of each pair, with denominators n."""
    out = [F.avg(c).alias(f"mean_{c}") for c in columns] + [F.var_pop(c).alias(f"var_{c}") for c in columns]
    out += [F.covar_pop(a, b).alias(f"cov_{a}_{b}") for k, a in enumerate(columns) for b in columns[k + 1 :]]
    return df.groupBy(*by).agg(*out)


def weighted_moments(df: DataFrame, x: str, y: str, weight: str, by: list[str]) -> DataFrame:
    """Weighted mean, variance and covariance."""
    w, a, b = (F.col(c).cast("double") for c in (weight, x, y))
    sums = df.groupBy(*by).agg(F.sum(w).alias("w"), F.sum(w * a).alias("wx"), F.sum(w * b).alias("wy"), F.sum(w * a * a).alias("wxx"), F.sum(w * a * b).alias("wxy"))
    mx, my = F.col("wx") / F.col("w"), F.col("wy") / F.col("w")
    return sums.select(*by, mx.alias("mean"), (F.col("wxx") / F.col("w") - mx * mx).alias("var"), (F.col("wxy") / F.col("w") - mx * my).alias("cov"))


def _beside(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """a with b's other columns where the keys are equal, nulls too."""
    if not on:
        return a.crossJoin(F.broadcast(b))  # b is one row
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in on])
    return a.join(b.withColumnsRenamed({c: f"__{c}" for c in on}), same).drop(*[f"__{c}" for c in on])


def ranked_histogram(df: DataFrame, x: str, by: list[str], buckets: int = 64) -> DataFrame:
    """by, x, n, first (0-based rank of the first of that value), total: of numbers or times.

    A group's distinct values are parted into ranges of about equal size; ranks are running counts within a range, after the
    counts of the ranges before it. So no window holds all values of a group, however many of them are distinct.
    """
    h = df.where(F.col(x).isNotNull()).groupBy(*by, x).agg(F.count(F.lit(1)).alias("n"))
    bounds = h.groupBy(*by).agg(F.percentile_approx(x, [k / buckets for k in range(1, buckets)], 1000).alias("__bounds"))
    h = _beside(h, bounds, by).withColumn("__k", F.size(F.filter(F.array_distinct("__bounds"), lambda b: b < F.col(x)))).drop("__bounds")
    sums = h.groupBy(*by, "__k").agg(F.sum("n").alias("__n"))
    group = Window.partitionBy(*by)
    sums = sums.select(*by, "__k", (F.sum("__n").over(group.orderBy("__k")) - F.col("__n")).alias("__before"), F.sum("__n").over(group).alias("total"))  # a row a range
    inside = F.sum("n").over(Window.partitionBy(*by, "__k").orderBy(x)) - F.col("n")
    return _beside(h, sums, [*by, "__k"]).select(*by, x, "n", (F.col("__before") + inside).alias("first"), "total")


def nearest_rank(df: DataFrame, x: str, by: list[str], parts: list[float]) -> DataFrame:
    """by, p<percent>: the value of 0-based rank floor(n * part)."""
    h = ranked_histogram(df, x, by)
    at = lambda p: F.floor(F.col("total") * F.lit(p))
    return h.groupBy(*by).agg(*[F.max(F.when((F.col("first") <= at(p)) & (at(p) < F.col("first") + F.col("n")), F.col(x))).alias(f"p{round(p * 100)}") for p in parts])


def _within(low: Column, high: Column) -> Column:
    """How many of a value's rows have ranks in [low, high)."""
    return F.greatest(F.least(F.col("first") + F.col("n"), high) - F.greatest(F.col("first"), low), F.lit(0))


def trimmed_mean(df: DataFrame, x: str, by: list[str], low: float = 0.1, keep: float = 0.8) -> DataFrame:
    """by, n, mean, sd of the ranks from floor(n * low) on, floor(n * keep) of them."""
    start = F.floor(F.col("total") * F.lit(low))
    h = ranked_histogram(df, x, by).withColumn("w", _within(start, start + F.floor(F.col("total") * F.lit(keep))).cast("double"))
    v = F.col(x).cast("double")
    s = h.groupBy(*by).agg(F.sum("w").alias("n"), F.sum(F.col("w") * v).alias("s"), F.sum(F.col("w") * v * v).alias("ss"))
    var = (F.col("ss") - F.col("s") * F.col("s") / F.col("n")) / F.nullif(F.col("n") - 1, F.lit(0.0))
    return s.select(*by, F.col("n").cast("long").alias("n"), (F.col("s") / F.nullif("n", F.lit(0.0))).alias("mean"), F.sqrt(F.greatest(var, F.lit(0.0))).alias("sd"))


def drop_tails(df: DataFrame, x: str, by: list[str], alpha: float) -> DataFrame:
    """by, x, n: the histogram without alpha / 2 of the rows at either end, by rank."""
    cut = F.floor(F.col("total") * F.lit(alpha / 2))
    return ranked_histogram(df, x, by).withColumn("n", _within(cut, F.col("total") - cut)).where("n > 0").select(*by, x, "n")


def histogram_summary(df: DataFrame, x: str, by: list[str], trim: float = 0.0) -> DataFrame:
    """by, n, mean, variance (population), median: of whole buckets, after taking off buckets at both ends while they hold at most a part trim of all."""
    h = ranked_histogram(df, x, by)
    cut = F.col("total") * F.lit(trim)
    h = h.where((F.col("first") + F.col("n") > cut) & (F.col("total") - F.col("first") > cut)) if trim else h
    v, n = F.col(x).cast("double"), F.col("n").cast("double")
    h = _beside(h, h.groupBy(*by).agg(F.min("first").alias("__cut"), F.sum("n").alias("__kept")), by)
    reached = F.col("first") + F.col("n") - F.col("__cut") > F.col("__kept") * 0.5
    return h.groupBy(*by).agg(F.sum("n").alias("n"), (F.sum(v * n) / F.sum(n)).alias("mean"), (F.sum(v * v * n) / F.sum(n) - F.pow(F.sum(v * n) / F.sum(n), F.lit(2))).alias("variance"), F.min(F.when(reached, F.col(x))).alias("median"))


def near_mean(df: DataFrame, x: str, by: list[str], sds: float) -> DataFrame:
    """The rows within so many standard deviations of their group's mean."""
    stats = df.groupBy(*by).agg(F.avg(x).alias("__m"), F.stddev_samp(x).alias("__s"))
    return df.join(stats, by).where(F.abs(F.col(x) - F.col("__m")) <= sds * F.col("__s")).drop("__m", "__s")


def kernel_density(df: DataFrame, x: str, points: int = 64, bins: int = 1024, adjust: float = 1.0) -> DataFrame:
    """at, density: Gaussian kernel density at evenly spaced points, of values in at most so many bins, with Silverman's bandwidth."""
    s = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.stddev_samp(x).alias("sd"), F.count(x).alias("n"), F.expr(f"percentile_approx({x}, array(0.25, 0.75), 10000)").alias("q"))
    s = s.withColumn("bw", adjust * 0.9 * F.least("sd", (F.element_at("q", 2) - F.element_at("q", 1)) / 1.34) * F.pow(F.col("n"), F.lit(-0.2)))
    s = s.where("bw > 0").select("lo", "bw", "n", ((F.col("hi") - F.col("lo")) / bins).alias("w"), (F.col("lo") - 3 * F.col("bw")).alias("a"), (F.col("hi") + 3 * F.col("bw")).alias("b"))
    h = df.crossJoin(F.broadcast(s)).groupBy("lo", "bw", "n", "w", "a", "b", F.least(F.floor((F.col(x) - F.col("lo")) / F.col("w")), F.lit(bins - 1)).alias("bin")).agg(F.count(F.lit(1)).alias("c"))  # s is one row
    h = h.withColumn("v", F.col("lo") + (F.col("bin") + 0.5) * F.col("w")).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    at = F.col("a") + (F.col("b") - F.col("a")) * F.col("k") / (points - 1)
    z = (at - F.col("v")) / F.col("bw")
    return h.groupBy("k", at.alias("at")).agg((F.sum(F.col("c") * F.exp(-z * z / 2)) / F.first(F.col("n") * F.col("bw") * 2.5066282746310002)).alias("density")).drop("k")
