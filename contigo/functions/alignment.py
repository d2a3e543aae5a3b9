"""Alignment expressions: CIGAR strings, flags, insert sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cigar_length(cigar: Column, operations: str = "M") -> Column:
    """Sum of the lengths of the given operations (M alone: aligned bases)."""
    return F.aggregate(F.regexp_extract_all(cigar, F.lit(f"([0-9]+)[{operations}]"), 1), F.lit(0), lambda n, x: n + x.cast("int"))


def is_reverse(flag: Column) -> Column:
    return flag.bitwiseAND(16) != 0


def is_inward(pos1: Column, rev1: Column, rev2: Column) -> Column:
    """Whether the mates, the left one first, point at each other."""
    return ~rev1 & rev2


def insert_size(pos1: Column, pos2: Column, len2: Column) -> Column:
    """From the left mate's start to the right mate's end."""
    return pos2 - pos1 + len2


def insert_size_across(pos1: Column, len1: Column, pos2: Column, contig_length: Column) -> Column:
    """The same across the ends of a circular contig."""
    return pos1 + len1 + contig_length - pos2


def mean_mapping_quality(q1: Column, q2: Column) -> Column:
    """255 stands for unknown and counts as 0."""
    return (F.pmod(q1, F.lit(255)) + F.pmod(q2, F.lit(255))) / 2


def circular(pos: Column, length: Column) -> Column:
    """A 1-based position on a circle."""
    return F.pmod(pos - 1, length) + 1
