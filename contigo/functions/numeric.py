"""Numeric expressions: normal distribution, synteny thresholds, scaffolding parameters."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def normal_pdf(x: Column, mean: Column, sd: Column) -> Column:
    return F.exp(-((x - mean) * (x - mean)) / (2 * sd * sd)) / (sd * math.sqrt(2 * math.pi))


@F.pandas_udf(DoubleType())
def normal_cdf(z: pd.Series) -> pd.Series:
    """Of the standard normal distribution; Spark has no error function."""
    return z.map(lambda v: None if v is None or v != v else 0.5 * math.erfc(-v / math.sqrt(2)))


def geometric_quantile(alpha: float, p: Column) -> Column:
    """Failures before a success of chance p that only a part alpha of series exceed."""
    return F.log(F.lit(alpha)) / F.log1p(-p) - 1


def density_parameters(p: Column, read_length: Column, alpha: float = 1e-4) -> Column:
    """Neighbourhood size and least neighbours from the chance p of a read start at a base."""
    eps = F.greatest(read_length, geometric_quantile(alpha, p))
    return F.struct(eps.alias("eps"), (p * 2 * eps).alias("min_points"))


def synteny_distance(t: float, h: Column, single: bool = False) -> Column:
    """Greatest distance of neighbours in a block for a chance t of neighbours among points of density h; single: in 32-bit steps, as the published values."""
    x = F.lit(t).cast("float") if single else F.lit(t)
    y = h.cast("float") if single else h
    ratio = F.log(1 - x.cast("double")) / F.log(1 - y.cast("double"))
    ratio = ratio.cast("float").cast("double") if single else ratio
    out = F.sqrt(ratio + 0.25) + 0.5
    return out.cast("float").cast("double") if single else out


def block_p_value(cells: Column, n: Column, h: Column, length: Column) -> Column:
    """Chance of a block of that many points by accident."""
    return 1 - F.exp(-cells * F.pow(n * h, length) * h)


def expected_links(reads: Column, insert: Column, genome: Column) -> Column:
    return reads * insert / F.nullif(genome, F.lit(0))


def scaffold_parameters(genome: Column, insert: Column, mean: Column, sd: Column, links: Column, again: bool = False) -> Column:
    """Overlap m, merge length n, link count k, link ratio a and insert error of the scaffolder."""
    m = F.greatest(F.lit(15), F.floor(F.log2(genome) + 3.99))
    n = F.floor(1.25 * F.log2(insert) + 0.99)
    k = F.greatest(F.lit(1), F.floor(F.log(1.4, links) - 11.5) - (2 if again else 0))
    return F.struct(m.cast("int").alias("m"), n.cast("int").alias("n"), k.cast("int").alias("k"), F.lit(0.3 if again else 0.4).alias("a"), F.least(6 * sd / mean, F.lit(0.95)).alias("err"))


@F.pandas_udf(DoubleType())
def linking_pairs(len1: pd.Series, len2: pd.Series, gap: pd.Series, mean: pd.Series, sd: pd.Series, density: pd.Series) -> pd.Series:
    """Pairs expected to join two contigs with a gap between them, for normal inserts: over the starts at i bases from the first
    contig's end, the chance that the insert ends on the second contig, times pairs per base. The sum over i is taken as an integral."""

    def area(x: float, s: float) -> float:
        z = x / s
        return s * (z * 0.5 * math.erfc(-z / math.sqrt(2)) + math.exp(-z * z / 2) / math.sqrt(2 * math.pi))

    def one(a: float, b: float, g: float, m: float, s: float, d: float) -> float | None:
        if None in (a, b, g, m, s, d) or s <= 0:
            return None
        return d * (area(a + g + b - m, s) - area(g + b - m, s) - area(a + g - m, s) + area(g - m, s))

    return pd.Series([one(*map(float, x)) for x in zip(len1, len2, gap, mean, sd, density)])


def quoted_field(line: Column, n: int = 1) -> Column:
    """The n-th double-quoted field of a log line, null if there are fewer."""
    return F.get(F.regexp_extract_all(line, F.lit('"([^"]*)"'), 1), F.lit(n - 1))
