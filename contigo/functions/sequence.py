"""Sequence expressions: complements, k-mers, composition, distances, names. All JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: IUPAC codes and their complements, upper and lower case; U pairs with A. Fixed values.
BASES = "ACGTacgtMRYKVBHDmrykvbhdUu"
COMPLEMENTS = "TGCAtgcaKYRMBVDHkyrmbvdhAa"


def complement(seq: Column) -> Column:
    """Base by base, case kept; W, S, N, X and gaps are their own complements."""
    return F.translate(seq, BASES, COMPLEMENTS)


def revcomp(seq: Column) -> Column:
    return F.reverse(complement(seq))


def canonical(seq: Column) -> Column:
    """The lesser of a sequence and its reverse complement, in text order."""
    return F.least(seq, revcomp(seq))


def is_palindrome(seq: Column) -> Column:
    return seq == revcomp(seq)


def trim_trailing_n(seq: Column) -> Column:
    return F.regexp_replace(seq, "[Nn]+$", "")


#: Bases of a piece: substrings are searched from a text's start, so long sequences are cut first.
PIECE = 1000


def pieces(seq: Column, k: int) -> Column:
    """The sequence in pieces of some PIECE bases, each with the k - 1 bases that follow it: every k-mer lies in one piece. Linear in the length."""
    size = max(PIECE, k)
    cut = F.regexp_extract_all(seq, F.lit(f"(?s).{{1,{size}}}"), 0)
    after = F.slice(cut, F.lit(2), F.greatest(F.size(cut), F.lit(0)))
    return F.zip_with(cut, after, lambda p, q: F.concat(p, F.left(F.coalesce(q, F.lit("")), F.lit(k - 1))))


def piece_kmers(piece: Column, k: int) -> Column:
    n = F.char_length(piece) - k + 1
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(piece, i, F.lit(k)))).otherwise(F.array().cast("array<string>"))


def kmers(seq: Column, k: int) -> Column:
    """All substrings of length k in order; none for shorter (or null) sequences."""
    return F.coalesce(F.flatten(F.transform(pieces(seq, k), lambda p: piece_kmers(p, k))), F.array().cast("array<string>"))


def count_of(seq: Column, letters: str) -> Column:
    """How many characters are one of the letters."""
    return F.char_length(seq) - F.char_length(F.translate(seq, letters, ""))


def gc_fraction(seq: Column, known_only: bool = False, strong: bool = False) -> Column:
    """Part of G and C (strong: S too) of the length, or of the known bases only; null for an empty denominator."""
    below = count_of(seq, "ACGTacgt") if known_only else F.char_length(seq)
    return count_of(seq, "GCgcSs" if strong else "GCgc") / F.nullif(below, F.lit(0))


def hamming(a: Column, b: Column) -> Column:
    """Mismatches over the common length plus the difference in length."""
    pairs = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.when(x.eqNullSafe(y), 0).otherwise(1))
    both = F.aggregate(pairs, F.lit(0), lambda n, x: n + x)
    return F.when((a == "") | (b == ""), F.greatest(F.char_length(a), F.char_length(b))).otherwise(both)


def similarity(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length; 1 for two empty sequences, null where one is null."""
    longer = F.greatest(F.char_length(a), F.char_length(b))
    return F.when((a == "") & (b == ""), F.lit(1.0)).otherwise(1 - F.levenshtein(a, b) / longer)


def read_name(header: Column) -> Column:
    """A read's name without @ or >, description and mate suffix (/1, /2, Casava 1.8's second field)."""
    first = F.regexp_extract(header, r"^[@>]?([^ \t]*)", 1)
    return F.regexp_replace(first, r"/[12]$", "")


def read_mate(header: Column) -> Column:
    """1, 2, or null where the header doesn't say."""
    m = F.coalesce(F.nullif(F.regexp_extract(header, r"^\S*/([12])(?:\s|$)", 1), F.lit("")), F.nullif(F.regexp_extract(header, r"^\S+\s([12]):", 1), F.lit("")))
    return m.cast("int")


def header_prefix(header: Column) -> Column:
    """The first part of a header that ends in white space, a bar or a colon."""
    return F.regexp_extract(header, r"^>?([^ \t|:]*)", 1)


def subsequence(seq: Column, start: Column, end: Column, strand: Column, upstream: int = 0, downstream: int = 0) -> Column:
    """Bases start..end (1-based, inclusive), with flanks on the feature's own strand, clamped to the sequence; complemented on strand -1."""
    before = F.when(strand < 0, F.lit(downstream)).otherwise(F.lit(upstream))
    after = F.when(strand < 0, F.lit(upstream)).otherwise(F.lit(downstream))
    a = F.greatest(start - before, F.lit(1))
    b = F.least(end + after, F.char_length(seq))
    part = F.substring(seq, a, F.greatest(b - a + 1, F.lit(0)))
    return F.when(strand < 0, revcomp(part)).otherwise(part)


def wrap(seq: Column, width: int = 80) -> Column:
    """Line ends after every width characters, none at the end."""
    return F.regexp_replace(F.regexp_replace(seq, f"(.{{{width}}})", "$1\n"), "\n$", "")


def overlap_length(left: Column, right: Column, least: int, most: int) -> Column:
    """The longest suffix of left that begins right, of least..most characters; 0 if there is none."""
    fits = F.filter(F.sequence(F.lit(least), F.lit(most)), lambda n: (n <= F.char_length(left)) & (n <= F.char_length(right)) & (F.right(left, n) == F.left(right, n)))
    return F.coalesce(F.array_max(fits), F.lit(0))


def sql_functions(spark) -> None:
    """Register revcomp, canonical_kmer and cigar_len as SQL functions, and the table function kmers(seq, k)."""
    from pyspark.sql.functions import udtf

    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION revcomp(s STRING) RETURNS STRING RETURN reverse(translate(s, '{BASES}', '{COMPLEMENTS}'))")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION canonical_kmer(s STRING) RETURNS STRING RETURN least(s, reverse(translate(s, '{BASES}', '{COMPLEMENTS}')))")
    spark.sql(r"CREATE OR REPLACE TEMPORARY FUNCTION cigar_len(c STRING) RETURNS INT RETURN aggregate(regexp_extract_all(c, '([0-9]+)M', 1), 0, (n, x) -> n + int(x))")

    @udtf(returnType="pos int, kmer string")
    class Kmers:
        def eval(self, seq: str, k: int):
            for i in range(len(seq or "") - k + 1):
                yield i + 1, seq[i : i + k]

    spark.udtf.register("kmers", Kmers)
