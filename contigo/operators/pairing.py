"""Pairs of rows: re-pairing by key, by adjacency and by position; interleaving; renaming; set merges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def repair(df: DataFrame, key: list[str], mate: Column, order: str, values: list[str]) -> DataFrame:
    """key, <value>_1, <value>_2, state ('paired', 'first', 'second'): mates 1 and 2 of each key, the last of repeated ones. One aggregation in place of a full outer self-join."""
    row = F.struct(*[F.col(v) for v in values])
    by = df.groupBy(*key).agg(*[F.max_by(row, F.when(mate == m, F.col(order))).alias(f"r{m}") for m in (1, 2)], *[F.max((mate == m).cast("int")).alias(f"has{m}") for m in (1, 2)])
    state = F.when((F.col("has1") == 1) & (F.col("has2") == 1), "paired").when(F.col("has1") == 1, "first").when(F.col("has2") == 1, "second")
    out = [F.when(F.col(f"has{m}") == 1, F.col(f"r{m}.{v}")).alias(f"{v}_{m}") for v in values for m in (1, 2)]
    return by.where("has1 = 1 OR has2 = 1").select(*key, *out, state.alias("state"))


def adjacent_pairs(df: DataFrame, within: list[str], order: list[str], key: Column) -> DataFrame:
    """The rows with pair ('first', 'second', or null for rows that stay alone): neighbours with equal keys, paired from the first on."""
    w = Window.partitionBy(*within).orderBy(*order)
    new = F.coalesce((~key.eqNullSafe(F.lag(key).over(w))).cast("int"), F.lit(1))
    df = df.withColumn("__run", F.sum(new).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy(*within, "__run")
    df = df.withColumn("__k", F.row_number().over(run.orderBy(*order))).withColumn("__n", F.count(F.lit(1)).over(run))
    alone = (F.col("__k") == F.col("__n")) & (F.col("__n") % 2 == 1)
    return df.withColumn("pair", F.when(alone, F.lit(None)).when(F.col("__k") % 2 == 1, "first").otherwise("second")).drop("__run", "__k", "__n")


def zip_rows(left: DataFrame, right: DataFrame, ordinal: str) -> DataFrame:
    """Row i with row i, as far as the shorter goes; other columns get suffixes _1 and _2."""
    a = left.select(ordinal, *[F.col(c).alias(f"{c}_1") for c in left.columns if c != ordinal])
    b = right.select(ordinal, *[F.col(c).alias(f"{c}_2") for c in right.columns if c != ordinal])
    return a.join(b, ordinal)


def interleave(left: DataFrame, right: DataFrame, ordinal: str) -> DataFrame:
    """Rows of both in turn: new ordinals 2i and 2i + 1."""
    return left.withColumn(ordinal, F.col(ordinal) * 2).unionByName(right.withColumn(ordinal, F.col(ordinal) * 2 + 1))


def deinterleave(df: DataFrame, ordinal: str) -> tuple[DataFrame, DataFrame]:
    half = F.expr(f"{ordinal} div 2")
    return df.where(F.col(ordinal) % 2 == 0).withColumn(ordinal, half), df.where(F.col(ordinal) % 2 == 1).withColumn(ordinal, half)


def rename_by_rules(column: Column, rules: list[tuple[str, str]]) -> Column:
    """Regular expressions applied in order."""
    return reduce(lambda c, r: F.regexp_replace(c, r[0], r[1]), rules, column)


def merge_counts(a: DataFrame, b: DataFrame, key: str, count: str) -> DataFrame:
    """key, n_a, n_b, part ('a', 'b', 'shared'), f_a, f_b: two count tables side by side, with parts of their totals."""
    x = a.select(F.col(key).alias("key"), F.col(count).alias("n_a"))
    y = b.select(F.col(key).alias("key"), F.col(count).alias("n_b"))
    ta, tb = x.agg(F.sum("n_a").alias("t_a")), y.agg(F.sum("n_b").alias("t_b"))
    part = F.when(F.col("n_b").isNull(), "a").when(F.col("n_a").isNull(), "b").otherwise("shared")
    both = x.join(y, "key", "full_outer").withColumn("part", part).crossJoin(F.broadcast(ta)).crossJoin(F.broadcast(tb))  # totals: one row each
    return both.select("key", "n_a", "n_b", "part", (F.col("n_a") / F.col("t_a")).alias("f_a"), (F.col("n_b") / F.col("t_b")).alias("f_b"))


def union_all(tables: list[DataFrame], transform=None) -> DataFrame:
    """All rows of tables with the same columns, each transformed first if asked for."""
    return reduce(lambda x, y: x.unionByName(y), [transform(t) if transform else t for t in tables])


def last_wins_semi(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows of df whose key is in other too; of rows with equal keys the greatest by all columns stays."""
    last = df.groupBy(key).agg(F.max(F.struct(*[F.col(c) for c in df.columns])).alias("__row")).select("__row.*")
    return last.join(other.select(key).distinct(), key, "left_semi")


def number_singletons(members: DataFrame, grouped: DataFrame, key: str, group: str) -> DataFrame:
    """group, key: members that are in no group, each as a group of its own, numbered from the greatest group on, in order of key."""
    alone = members.select(key).distinct().join(grouped.select(key), key, "left_anti")
    top = grouped.agg(F.coalesce(F.max(group), F.lit(0)).alias("top"))
    # numbered within ranges of the key, whose sizes are summed first
    at = alone.withColumn("__b", F.expr(f"substring(cast({key} AS string), 1, 2)"))
    sizes = at.groupBy("__b").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("__b", before.alias("before"))
    rn = F.row_number().over(Window.partitionBy("__b").orderBy(key))
    return at.withColumn("rn", rn).join(sizes, "__b").crossJoin(F.broadcast(top)).select((F.col("top") + F.col("before") + F.col("rn")).alias(group), key)
