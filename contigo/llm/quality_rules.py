"""Quality rules: a table of thresholds compiled into Spark expressions; no user functions.

``features`` computes, per document, counts of words, symbols, stop words, capitals and
lines; ``RULES`` bounds ratios of those counts; ``quality_rules`` evaluates all of them in
one pass over the rows, without a shuffle.

Words are runs of other characters than ASCII white space. ``n_repeat_words`` counts the
words that lie in a 5-word window found at least twice in the text. Windows are compared by
a 64-bit hash of their words (a chance of 1e-11 for a wrong count in a text of 20,000 words);
texts without an equal pair of hashes skip the sort that finds the positions.

Edge cases: null and empty texts have all counts 0 and fail; repeated rows are judged each;
an empty table gives no rows; other columns pass through ``quality_rules`` only if asked for.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD_GAP, read_table, text_docs, words_of

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that it for on was as with be by this are or from at an not "
    "der die das und von zu den mit ist im auf für nicht ein eine des dem sich als auch "
    "le la les et des un une du que est pour dans qui par sur au avec pas en de "
    "el los las del se por con una para es y lo su al como más"
).split()


@dataclass(frozen=True)
class Rule:
    """low * below <= 1000 * above <= high * below; asked only of texts with so many words. None: no bound."""

    name: str
    above: str
    below: str
    low: int | None = None
    high: int | None = None
    least_words: int = 0

    def sql(self) -> str:
        parts = [f"{self.low} * {self.below} <= 1000 * {self.above}"] * (self.low is not None) + [f"1000 * {self.above} <= {self.high} * {self.below}"] * (self.high is not None)
        held = " AND ".join(parts)
        return f"(n_words < {self.least_words} OR ({held}))" if self.least_words else f"({held})"


#: Ratios in thousandths.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 1500, 18000),
    Rule("symbols_per_word", "n_symbols", "n_words", None, 150),
    Rule("stop_words_per_word", "n_stop_words", "n_words", 20, None, 40),
    Rule("capitals_per_character", "n_capitals", "word_chars", None, 400),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 500),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", None, 900),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", None, 300),
)
#: The base rule of the contract.
BASE_FAILED = "(n_words < 10 OR 100 * n_repeat_words > 20 * n_words)"
WINDOW = 5


def repeat_words(words: Column, n_words: Column) -> Column:
    """Words in 5-word windows found twice or more."""
    hashes = F.transform(F.sequence(F.lit(0), n_words - WINDOW), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))

    def count(h: Column) -> Column:
        by_hash = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = _let(by_hash, lambda s: F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"])))
        starts = F.array_sort(F.transform(twice, lambda x: x["i"]))
        zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        step = lambda a, p: F.struct((a["n"] + p + WINDOW - F.greatest(a["end"], p)).alias("n"), (p + WINDOW).alias("end"))
        return F.aggregate(starts, zero, step, lambda a: a["n"])

    counted = _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(count(h)))
    return F.when(n_words > WINDOW, counted).otherwise(F.lit(0))


def _let(value: Column, body) -> Column:
    """body(value) with value computed once a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def features(docs: DataFrame) -> DataFrame:
    """doc_id and the counts that the rules use."""
    has_word = lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    df = text_docs(docs).select("doc_id", "text", words_of(F.col("text")).alias("words"), F.filter(F.split("text", "\n"), has_word).alias("lines"))
    words, lines, text = F.col("words"), F.col("lines"), F.col("text")
    df = df.select("*", F.size(words).alias("n"))
    stop = [w for w in dict.fromkeys(STOP_WORDS)]
    return df.select(
        "doc_id",
        F.col("n").cast("long").alias("n_words"),
        F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeat_words(words, F.col("n")).cast("long").alias("n_repeat_words"),
        F.size(F.filter(words, lambda w: F.lower(w).isin(stop))).cast("long").alias("n_stop_words"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
        F.size(lines).cast("long").alias("n_lines"),
        F.size(F.filter(lines, lambda x: x.rlike(r"^[ \t]*[-*•] "))).cast("long").alias("n_bullet_lines"),
        F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)[ \t]*$"))).cast("long").alias("n_ellipsis_lines"),
    )


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The features, a column fails_<rule> for each rule, base_failed and kept."""
    df = features(docs).withColumn("base_failed", F.expr(BASE_FAILED))
    df = df.withColumns({f"fails_{r.name}": ~F.expr(r.sql()) for r in rules})
    return df.withColumn("kept", ~F.col("base_failed") & F.expr(" AND ".join(f"NOT fails_{r.name}" for r in rules)))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_STOP_SQL = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
SQL = rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
g AS (SELECT doc_id, i, ws[i:i+4] AS g FROM w, unnest(range(1, len(ws) - 3)) t(i)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1),
n AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, unnest(range(0, 5)) t(k) GROUP BY doc_id),
f AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n.n, 0) AS BIGINT) AS n_repeat_words,
         len(list_filter(ws, lambda x: lower(x) IN ({_STOP_SQL}))) AS n_stop_words, len(regexp_extract_all(text, '\p{{Lu}}')) AS n_capitals,
         len(lines) AS n_lines, len(list_filter(lines, lambda x: regexp_matches(x, '^[ \t]*[-*•] '))) AS n_bullet_lines,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[ \t]*$'))) AS n_ellipsis_lines
  FROM w LEFT JOIN n USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {BASE_FAILED} AS base_failed,
       NOT {BASE_FAILED} AND {" AND ".join(r.sql() for r in RULES)} AS kept
FROM f
"""
