"""Base qualities: encodings, shifts, and where to trim. Quality strings are one character a base."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def codes(qual: Column) -> Column:
    """Character codes."""
    return F.transform(F.filter(F.split(qual, ""), lambda c: c != ""), lambda c: F.ascii(c))


def phred(qual: Column, offset: int = 33) -> Column:
    return F.transform(codes(qual), lambda x: x - offset)


def encode(values: Column, offset: int = 33) -> Column:
    return F.array_join(F.transform(values, lambda x: F.char(x + offset)), "")


def shift(qual: Column, by: int) -> Column:
    """Qualities in another offset: -31 from 64 to 33, +31 back."""
    return F.array_join(F.transform(codes(qual), lambda x: F.char(x + by)), "")


def offset_of(least: Column, most: Column) -> Column:
    """33 or 64 from the range of character codes in a sample: below ';' only 33 reaches, above 'J' only 64."""
    return F.when(least < 59, 33).when(most > 74, 64).otherwise(33)


def solexa_to_phred(values: Column) -> Column:
    """Solexa qualities (odds) to Phred (probability), rounded."""
    return F.transform(values, lambda q: F.round(10 * F.log10(F.pow(F.lit(10.0), q / 10.0) + 1)).cast("int"))


def trim_at_low(seq: Column, qual: Column, least: int, offset: int = 33) -> Column:
    """The bases before the first with a quality below least."""
    low = F.array_position(F.transform(codes(qual), lambda x: x - offset < least), True)
    return F.when(low > 0, F.substring(seq, F.lit(1), low.cast("int") - 1)).otherwise(seq)


def good_mask(qual: Column, least: int, offset: int = 33) -> Column:
    """'-' for each base of at least that quality, 'x' for the others."""
    return F.array_join(F.transform(codes(qual), lambda x: F.when(x - offset >= least, "-").otherwise("x")), "")


def first_good_run(seq: Column, qual: Column, least: int, length: int, offset: int = 33) -> Column:
    """The first run of at least so many good bases; empty if there is none."""
    mask = good_mask(qual, least, offset)
    at = F.regexp_instr(mask, F.lit(f"-{{{length},}}"))
    run = F.char_length(F.regexp_extract(mask, f"(-{{{length},}})", 1))
    return F.when(at > 0, F.substring(seq, at, run)).otherwise(F.lit(""))


def trim_tail(values: Column, least: int) -> Column:
    """Bases to keep by the running-sum rule of quality trimmers: cut where the sum of (least - q) from the end is greatest."""
    zero = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("most"), F.size(values).alias("keep"), F.size(values).alias("at"))

    def step(a: Column, q: Column) -> Column:
        total = a["sum"] + least - q
        return F.when(a["at"] < 0, a).otherwise(
            F.when(total < 0, F.struct(a["sum"], a["most"], a["keep"], F.lit(-1).alias("at"))).otherwise(
                F.struct(total.alias("sum"), F.greatest(a["most"], total).alias("most"), F.when(total > a["most"], a["at"] - 1).otherwise(a["keep"]).alias("keep"), (a["at"] - 1).alias("at"))
            )
        )

    return F.aggregate(F.reverse(values), zero, step, lambda a: a["keep"])


def sliding_window_cut(values: Column, width: int, least: float) -> Column:
    """Bases to keep: up to the first window of that width with a mean quality below least."""
    n = F.size(values)
    bad = F.filter(
        F.when(n >= width, F.sequence(F.lit(1), n - width + 1)).otherwise(F.array().cast("array<int>")),
        lambda i: F.aggregate(F.slice(values, i, F.lit(width)), F.lit(0), lambda s, x: s + x) < least * width,
    )
    return F.coalesce(F.array_min(bad) - 1, n)


def lead_trail(values: Column, least: int) -> Column:
    """(first, last) base, 1-based, with a quality of at least that; (1, 0) if there is none."""
    good = F.filter(F.transform(values, lambda x, i: F.when(x >= least, i + 1)), lambda i: i.isNotNull())
    return F.struct(F.coalesce(F.array_min(good), F.lit(1)).alias("first"), F.coalesce(F.array_max(good), F.lit(0)).alias("last"))
