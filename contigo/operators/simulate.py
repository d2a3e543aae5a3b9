"""Sampling and simulation, by hashes of keys: the same rows whatever the partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.sequence import revcomp
from .staging import kept


def uniform(*cols) -> Column:
    """A number in [0, 1) that depends on the columns (or literals) only."""
    return F.shiftrightunsigned(F.xxhash64(*[c if isinstance(c, Column) else F.lit(c) for c in cols]), 11).cast("double") * F.lit(2.0**-53)


def normal(*cols) -> Column:
    """A standard normal number of the columns, by the Box-Muller formula."""
    return F.sqrt(-2 * F.log(1 - uniform(*cols, 1))) * F.cos(2 * 3.141592653589793 * uniform(*cols, 2))


def bernoulli(df: DataFrame, key: Column, p: float, seed: int = 0) -> DataFrame:
    """Each key with chance p; rows with one key (a pair of reads) stay or go together."""
    return df.where(uniform(key, seed) < p)


def systematic(df: DataFrame, ordinal: str, step: int) -> DataFrame:
    return df.where(F.col(ordinal) % step == 0)


def shuffled(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """The rows in a random order that only depends on the keys."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key)


def mutate(seq: Column, rate: float, *seeds) -> Column:
    """Substitutions at a rate: a base becomes one of the other three."""
    after = {"A": "CGT", "C": "AGT", "G": "ACT", "T": "ACG"}
    swap = F.create_map(*[x for b, o in after.items() for x in (F.lit(b), F.lit(o))])

    def base(c: Column, i: Column) -> Column:
        pick = F.substring(swap[c], F.floor(uniform(*seeds, 7, i) * 3).cast("int") + 1, F.lit(1))
        return F.when((uniform(*seeds, 3, i) < rate) & swap[c].isNotNull(), pick).otherwise(c)

    return F.array_join(F.transform(F.filter(F.split(seq, ""), lambda c: c != ""), base), "")


def simulate_pairs(contigs: DataFrame, n_per_base: float, read: int, insert: float, sd: float, error: float = 0.01, seed: int = 0) -> DataFrame:
    """name, mate, seq, contig, start (0-based), strand: pairs drawn evenly from contigs (name, seq), inserts normal, strands even, errors at a rate."""
    n = F.floor(F.char_length("seq") * n_per_base / (2 * read)).cast("int")
    pairs = contigs.where(n > 0).select(F.col("name").alias("contig"), F.upper("seq").alias("seq"), F.explode(F.sequence(F.lit(1), n)).alias("k"))
    size = F.greatest(F.round(normal(F.col("contig"), F.col("k"), seed) * sd + insert), F.lit(float(read))).cast("int")
    pairs = pairs.withColumn("size", size).where(F.col("size") <= F.char_length("seq"))
    pairs = pairs.withColumn("start", F.floor(uniform(F.col("contig"), F.col("k"), seed, 5) * (F.char_length("seq") - F.col("size") + 1)).cast("int")).withColumn("strand", F.when(uniform(F.col("contig"), F.col("k"), seed, 6) < 0.5, 1).otherwise(-1))
    piece = F.substring("seq", F.col("start") + 1, F.col("size"))
    piece = F.when(F.col("strand") < 0, revcomp(piece)).otherwise(piece)
    name = F.concat_ws("_", "contig", F.col("k").cast("string"))
    both = pairs.select(name.alias("name"), "contig", "start", "strand", "k", F.posexplode(F.array(F.left(piece, F.lit(read)), F.left(revcomp(piece), F.lit(read)))).alias("m", "seq"))
    return both.select("name", (F.col("m") + 1).alias("mate"), mutate(F.col("seq"), error, F.col("contig"), F.col("k"), F.col("m"), F.lit(seed)).alias("seq"), "contig", "start", "strand")


def one_of_many(mappings: DataFrame, read: str, order: list[str], seed: int = 0) -> DataFrame:
    """One random mapping of each read, by one aggregation."""
    pick = F.struct(F.xxhash64(F.col(read), *[F.col(c) for c in order], F.lit(seed)).alias("h"), *[F.col(c) for c in order])
    best = mappings.groupBy(read).agg(F.min_by(F.struct(*[F.col(c) for c in mappings.columns]), pick).alias("r"))
    return best.select("r.*")


def mate_pairs(singles: DataFrame, key: str, pos: str, insert: float, sd: float, circle: int, seed: int = 0, rounds: int = 20) -> DataFrame:
    """a, b: reads of one strand matched with the one nearest to a normal distance ahead on a circle, each at most once as either (nearest first read wins).

    Reads that lose their mate draw again among those that are left, until a round finds no pair or rounds are over. By bins of one standard deviation, not all pairs.
    """
    width = max(sd, 1.0)
    drawing = offered = singles.select(F.col(key).alias("key"), F.col(pos).alias("pos"))
    pairs = None
    for k in range(rounds):
        rows = drawing.select(F.col("key").alias("a"), F.pmod(F.col("pos") + F.round(normal(F.col("key"), seed + k) * sd + insert), F.lit(circle)).alias("goal"))
        rows = rows.withColumn("bin", F.explode(F.array(*[F.floor(F.col("goal") / width) + d for d in (-1, 0, 1)])))
        near = rows.join(offered.select(F.col("key").alias("b"), F.col("pos").alias("pb"), F.floor(F.col("pos") / width).alias("bin")), "bin").where("a != b").withColumn("d", F.abs(F.col("pb") - F.col("goal")))
        best = near.groupBy("a").agg(F.min_by("b", F.struct("d", "b")).alias("b"), F.min("d").alias("d"))
        new = kept(best.groupBy("b").agg(F.min_by("a", F.struct("d", "a")).alias("a")).select("a", "b"))
        pairs = new if pairs is None else pairs.unionByName(new)
        if not new.limit(1).count():
            break
        drawing = kept(drawing.join(new.select(F.col("a").alias("key")), "key", "left_anti"))
        offered = kept(offered.join(new.select(F.col("b").alias("key")), "key", "left_anti"))
    return pairs


def pick_by_weight(df: DataFrame, by: list[str], order: str, weight: str, seed: int = 0) -> DataFrame:
    """One row of each group, drawn by weight: the first whose running weight exceeds a uniform part of the group's total; groups of no weight have none."""
    w = Window.partitionBy(*by)
    rows = df.withColumn("__upto", F.sum(weight).over(w.orderBy(order).rowsBetween(Window.unboundedPreceding, 0))).withColumn("__all", F.sum(weight).over(w))
    hit = rows.where(F.col("__upto") > uniform(*[F.col(c) for c in by], seed) * F.col("__all"))
    first = hit.groupBy(*by).agg(F.min_by(F.struct(*[F.col(c) for c in df.columns]), order).alias("__r"))
    return first.select("__r.*")


def noise_points(pairs: DataFrame, key: list[str], n: int, xmax: str, ymax: str, seed: int = 0) -> DataFrame:
    """key, x, y: so many random points in each contig pair's plane."""
    return pairs.select(*key, xmax, ymax, F.explode(F.sequence(F.lit(1), F.lit(n))).alias("k")).select(*key, F.floor(uniform(*[F.col(c) for c in key], F.col("k"), seed, 1) * F.col(xmax)).alias("x"), F.floor(uniform(*[F.col(c) for c in key], F.col("k"), seed, 2) * F.col(ymax)).alias("y"))


def parameter_grid(spark: SparkSession, **values: list) -> DataFrame:
    """One row per combination of parameter values: the grid of a sweep of jobs."""
    rows = [()]
    for v in values.values():
        rows = [(*r, x) for r in rows for x in v]
    return spark.createDataFrame(rows, list(values))
