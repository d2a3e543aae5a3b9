"""Hit tables (search results): thresholds, best hits, reciprocal best hits, symmetric top-k, deduplication."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import revcomp, similarity

#: Keys of an array in similar_names, the tasks that share one of its groups, and those that share the names of a whole table.
CHUNK, SALTS, NAME_TASKS = 512, 8, 96


def threshold(df: DataFrame, at_least: dict[str, float] | None = None, at_most: dict[str, float] | None = None, inclusive: bool = True) -> DataFrame:
    """Rows within all bounds; inclusive: bounds themselves pass."""
    tests = [F.col(c) >= v if inclusive else F.col(c) > v for c, v in (at_least or {}).items()]
    tests += [F.col(c) <= v if inclusive else F.col(c) < v for c, v in (at_most or {}).items()]
    return df.where(reduce(lambda a, b: a & b, tests, F.lit(True)))


def self_hits(df: DataFrame, query: str = "query", subject: str = "subject") -> DataFrame:
    return df.where(F.col(query) == F.col(subject))


def palindromic_hits(df: DataFrame) -> DataFrame:
    """Self hits whose subject runs back over the query."""
    return self_hits(df).where("qstart = send AND qend = sstart")


def best_per(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """by, best: of each group the whole row that comes first when all of order are greatest, compared in turn. One aggregation, no window."""
    keys = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)])
    return df.groupBy(*by).agg(F.max_by(F.struct(*[F.col(c) for c in df.columns]), keys).alias("best"))


def reciprocal_best(df: DataFrame, left: str, right: str, order: list[Column]) -> DataFrame:
    """left, right: pairs that are each other's best. order ranks hits from either side; add a tie-break over both ids."""
    forth = best_per(df, [left], order).select(F.col(left), F.col(f"best.{right}").alias(right))
    back = best_per(df, [right], order).select(F.col(f"best.{left}").alias(left), F.col(right))
    return forth.join(back, [left, right])


def reciprocal_best_one_table(df: DataFrame, order: list[Column], query: str = "query", subject: str = "subject") -> DataFrame:
    """a, b (a < b): pairs of one hit table in which either is the other's best hit."""
    best = best_per(df.where(F.col(query) != F.col(subject)), [query], order).select(F.col(query).alias("a"), F.col(f"best.{subject}").alias("b"))
    return best.join(best.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"]).where("a < b")


def symmetric_top(df: DataFrame, left: str, right: str, score: Column, k: int) -> DataFrame:
    """Rows among the k best of their left or of their right side; ties by the other side's key."""
    by_left = F.row_number().over(Window.partitionBy(left).orderBy(score.desc(), right))
    by_right = F.row_number().over(Window.partitionBy(right).orderBy(score.desc(), left))
    return df.withColumn("__l", by_left).withColumn("__r", by_right).where((F.col("__l") <= k) | (F.col("__r") <= k)).drop("__l", "__r")


def first_wins(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Of rows with equal keys the first in order."""
    first = df.groupBy(*by).agg(F.min_by(F.struct(*[F.col(c) for c in df.columns]), F.struct(*order)).alias("__row"))
    return first.select("__row.*")


def distinct_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """Unordered pairs once: a <= b."""
    return df.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def distinct_sequence_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """a, b, n: pairs of sequences, those that are each other's reverse complement (with the mates changed over) counted as one, in the lesser form."""
    there, back = F.struct(F.col(a).alias("a"), F.col(b).alias("b")), F.struct(revcomp(F.col(b)).alias("a"), revcomp(F.col(a)).alias("b"))
    return df.select(F.least(there, back).alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("n")).select("p.a", "p.b", "n")


def merge_duplicate_scores(df: DataFrame, a: str, b: str, score: str, average: bool = False) -> DataFrame:
    """a, b, score of unordered pairs: the greatest, or the whole-number average."""
    pairs = df.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), F.col(score).alias("score"))
    return pairs.groupBy("a", "b").agg((F.expr("sum(score) div count(score)") if average else F.max("score")).alias("score"))


def in_lists(df: DataFrame, ids: DataFrame, key: str, keep: bool = True) -> DataFrame:
    """Rows whose key is (or is not) in a list."""
    return df.join(ids.select(key).distinct(), key, "left_semi" if keep else "left_anti")


def matches_all(df: DataFrame, text: Column, terms: list[str]) -> DataFrame:
    """Rows whose text holds every term, case apart; a term that begins with '-' must not be there."""
    return df.where(reduce(lambda a, b: a & b, [~text.rlike("(?i)" + t[1:]) if t.startswith("-") else text.rlike("(?i)" + t) for t in terms], F.lit(True)))


def similar_names(df: DataFrame, by: list[str], key: str, name: str, digits: int = 9, salts: int | None = None) -> DataFrame:
    """a, b (a < b), similarity: each two rows of a group, with the rounded similarity of their names.

    Worked out once for each two names of a group, however many rows have them: the keys of a name stand in arrays of at most CHUNK, and pairs of arrays
    become pairs of rows at the end. Pairs outnumber rows by far, so tasks don't follow the table's size, and a group is dealt over salts (SALTS) of them.
    """
    salts = salts or SALTS
    tasks = max(96, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sets = df.groupBy(*by, F.col(name).alias("x")).agg(F.collect_list(key).alias("all")).where(F.size("all") > 0)
    chunks = F.transform(F.sequence(F.lit(0), F.expr(f"(size(all) - 1) div {CHUNK}").cast("int")), lambda i: F.slice("all", i * CHUNK + 1, F.lit(CHUNK)))
    sets = sets.select(*by, "x", F.posexplode(chunks).alias("part", "keys")).withColumn("id", F.struct("x", "part"))
    one = sets.withColumn("salt", F.pmod(F.xxhash64("x", "part"), F.lit(salts)).cast("int")).repartition(tasks, *by, "salt")
    two = sets.select(*by, F.col("x").alias("y"), F.col("keys").alias("others"), F.col("id").alias("id2"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")).repartition(tasks, *by, "salt")
    pairs = one.hint("merge").join(two, [*by, "salt"]).where("id <= id2")
    pairs = pairs.select("keys", "others", (F.col("id") == F.col("id2")).alias("same"), F.round(similarity(F.col("x"), F.col("y")), digits).alias("similarity"))
    each = pairs.select("others", "same", "similarity", F.explode("keys").alias("k")).select("k", "same", "similarity", F.explode("others").alias("o"))
    return each.where("k < o OR (k > o AND NOT same)").select(F.least("k", "o").alias("a"), F.greatest("k", "o").alias("b"), "similarity")


def similar_classes(df: DataFrame, key: str, name: str, digits: int = 9) -> DataFrame:
    """a, b, x, y, similarity: each two names x and y of the table under their least keys a and b, and under a name's least key a every other row b of that name (x and y are equal, the similarity is 1).

    That is every two rows: those of two names are as similar as these, those of one name are equal. A key that two names have in common may stand on both sides.
    """
    rows = df.select(F.col(key).alias("b"), F.col(name).alias("y")).where("b IS NOT NULL")
    names = rows.groupBy("y").agg(F.min("b").alias("a"))
    pairs = similar_names(names.select(F.struct("a", "y").alias("key"), "y"), [], "key", "y", digits, NAME_TASKS)
    pairs = pairs.select("a.a", F.col("b.a").alias("b"), F.col("a.y").alias("x"), "b.y", "similarity").where("a < b OR x < y")
    copies = rows.join(names.withColumnRenamed("y", "x"), F.col("y").eqNullSafe(F.col("x"))).where("b <> a")
    return pairs.unionByName(copies.select("a", "b", "x", "y", F.when(F.col("x").isNotNull(), 1.0).alias("similarity")))
