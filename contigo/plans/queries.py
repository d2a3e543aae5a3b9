"""The operators on the benchmark tables, each with its SQL: {name: (query, sql or None)}.

A query takes (spark, sf_dir). Floats are rounded on both sides, as sums of doubles depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sequence as seq
from ..operators import cluster, coverage, demux, graph, hits, islands, kmers, lengths, links, moments, orthologs, pairing, scaffold, score, simulate

QUERIES: dict[str, tuple] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__.removeprefix("q_")] = (f, sql)
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


# ---- lengths


def _n50_sql(rule: str) -> str:
    crossing = "cum >= 0.5 * total" if rule == "ge" else "cum > 0.5 * total"
    if rule == "next":
        return """
WITH r AS (SELECT lang, n_chars AS l, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC) AS k,
  sum(n_chars) OVER (PARTITION BY lang ORDER BY n_chars DESC ROWS UNBOUNDED PRECEDING) AS cum, sum(n_chars) OVER (PARTITION BY lang) AS total FROM documents),
x AS (SELECT lang, min(k) AS k FROM r WHERE cum > 0.5 * total GROUP BY lang)
SELECT x.lang, coalesce(b.l, a.l) AS nxx FROM x JOIN r a ON a.lang = x.lang AND a.k = x.k LEFT JOIN r b ON b.lang = x.lang AND b.k = x.k + 1"""
    return f"""
WITH r AS (SELECT lang, n_chars AS l, sum(n_chars) OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id ROWS UNBOUNDED PRECEDING) AS cum,
  sum(n_chars) OVER (PARTITION BY lang) AS total FROM documents)
SELECT lang, max(l) AS nxx FROM r WHERE {crossing} GROUP BY lang"""


for _rule in ("gt", "ge", "next"):
    QUERIES[f"n50_{_rule}"] = ((lambda s, d, r=_rule: lengths.nxx(table(s, d, "documents"), "n_chars", ["lang"], 0.5, r)), _n50_sql(_rule))


@query("""
WITH r AS (SELECT lang, n_chars AS l, sum(n_chars) OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id ROWS UNBOUNDED PRECEDING) AS cum, sum(n_chars) OVER (PARTITION BY lang) AS total FROM documents),
n AS (SELECT lang, max(l) AS n50 FROM r WHERE cum > 0.5 * total GROUP BY lang)
SELECT lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS total, max(n_chars) AS longest, min(n_chars) AS shortest, CAST(sum(n_chars) // count(*) AS BIGINT) AS mean, any_value(n50) AS n50
FROM documents JOIN n USING (lang) GROUP BY lang""")
def q_length_summary(s, d):
    return lengths.length_summary(table(s, d, "documents"), "n_chars", ["lang"])


@query("""
WITH h AS (SELECT lang, n_chars AS length, count(*) AS n FROM documents GROUP BY ALL)
SELECT lang, length, CAST(sum(n) OVER w AS BIGINT) AS sequences, CAST(sum(n * length) OVER w AS BIGINT) AS bases FROM h WINDOW w AS (PARTITION BY lang ORDER BY length DESC)""")
def q_accumulation_curve(s, d):
    return lengths.accumulation_curve(table(s, d, "documents"), "n_chars", ["lang"])


@query("""
WITH r AS (SELECT n_chars AS l, sum(n_chars) OVER (ORDER BY n_chars DESC, doc_id ROWS UNBOUNDED PRECEDING) AS cum FROM documents)
SELECT max(l) AS nxx FROM r WHERE cum >= 500000""")
def q_ng50(s, d):
    return lengths.ng_length(table(s, d, "documents"), "n_chars", 1_000_000)


# ---- moments


@query("""
SELECT l_returnflag, count(l_quantity) AS n, round(avg(l_quantity), 6) AS mean, round(var_samp(l_quantity), 5) AS var, round(covar_samp(l_quantity, l_extendedprice), 2) AS cov,
  round(corr(l_quantity, l_extendedprice), 6) AS cor, round(skewness(l_quantity), 5) AS skew FROM lineitem GROUP BY 1""")
def q_sample_moments(s, d):
    return rounded(rounded(rounded(moments.sample_moments(table(s, d, "lineitem"), "l_quantity", "l_extendedprice", ["l_returnflag"]), 6, "mean", "cor"), 5, "var", "skew"), 2, "cov")


@query("""
SELECT l_linestatus, round(avg(l_quantity), 6) AS mean_l_quantity, round(avg(l_discount), 6) AS mean_l_discount, round(avg(l_tax), 6) AS mean_l_tax,
  round(var_pop(l_quantity), 5) AS var_l_quantity, round(var_pop(l_discount), 6) AS var_l_discount, round(var_pop(l_tax), 6) AS var_l_tax,
  round(covar_pop(l_quantity, l_discount), 5) AS cov_l_quantity_l_discount, round(covar_pop(l_quantity, l_tax), 5) AS cov_l_quantity_l_tax, round(covar_pop(l_discount, l_tax), 6) AS cov_l_discount_l_tax
FROM lineitem GROUP BY 1""")
def q_population_moments(s, d):
    out = moments.population_moments(table(s, d, "lineitem"), ["l_quantity", "l_discount", "l_tax"], ["l_linestatus"])
    out = rounded(out, 6, *[c for c in out.columns if c.startswith("mean")], "var_l_discount", "var_l_tax", "cov_l_discount_l_tax")
    return rounded(out, 5, "var_l_quantity", "cov_l_quantity_l_discount", "cov_l_quantity_l_tax")


@query("""
SELECT l_returnflag, round(sum(l_quantity * l_discount) / sum(l_quantity), 6) AS mean,
  round(sum(l_quantity * l_discount * l_discount) / sum(l_quantity) - (sum(l_quantity * l_discount) / sum(l_quantity)) ** 2, 6) AS var,
  round(sum(l_quantity * l_discount * l_tax) / sum(l_quantity) - (sum(l_quantity * l_discount) / sum(l_quantity)) * (sum(l_quantity * l_tax) / sum(l_quantity)), 6) AS cov
FROM lineitem GROUP BY 1""")
def q_weighted_moments(s, d):
    return rounded(moments.weighted_moments(table(s, d, "lineitem"), "l_discount", "l_tax", "l_quantity", ["l_returnflag"]), 6, "mean", "var", "cov")


@query("""
WITH r AS (SELECT l_returnflag, l_quantity, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) - 1 AS k, count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem)
SELECT l_returnflag, max(l_quantity) FILTER (k = floor(n * 0.5)) AS p50, max(l_quantity) FILTER (k = floor(n * 0.1)) AS p10 FROM r GROUP BY 1""")
def q_nearest_rank(s, d):
    return moments.nearest_rank(table(s, d, "lineitem"), "l_quantity", ["l_returnflag"], [0.5, 0.1])


@query("""
WITH r AS (SELECT l_linestatus, l_extendedprice AS x, row_number() OVER (PARTITION BY l_linestatus ORDER BY l_extendedprice) - 1 AS k, count(*) OVER (PARTITION BY l_linestatus) AS n FROM lineitem)
SELECT l_linestatus, count(*) AS n, round(avg(x), 4) AS mean, round(stddev_samp(x), 3) AS sd FROM r WHERE k >= floor(n * 0.1) AND k < floor(n * 0.1) + floor(n * 0.8) GROUP BY 1""")
def q_trimmed_mean(s, d):
    return rounded(rounded(moments.trimmed_mean(table(s, d, "lineitem"), "l_extendedprice", ["l_linestatus"]), 4, "mean"), 3, "sd")


@query("""
WITH r AS (SELECT l_returnflag, l_quantity, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) - 1 AS k, count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem)
SELECT l_returnflag, l_quantity, count(*) AS n FROM r WHERE k >= floor(n * 0.05) AND k < n - floor(n * 0.05) GROUP BY 1, 2""")
def q_drop_tails(s, d):
    return moments.drop_tails(table(s, d, "lineitem"), "l_quantity", ["l_returnflag"], 0.1)


@query("""
WITH h AS (SELECT l_linestatus, l_quantity AS x, count(*) AS n FROM lineitem GROUP BY ALL),
c AS (SELECT *, sum(n) OVER (PARTITION BY l_linestatus ORDER BY x) AS cum, sum(n) OVER (PARTITION BY l_linestatus) AS total FROM h),
k AS (SELECT * FROM c WHERE cum > total * 0.05 AND total - cum + n > total * 0.05),
m AS (SELECT *, sum(n) OVER (PARTITION BY l_linestatus ORDER BY x) AS after, sum(n) OVER (PARTITION BY l_linestatus) AS kept FROM k)
SELECT l_linestatus, CAST(sum(n) AS BIGINT) AS n, round(sum(x * n) / sum(n), 6) AS mean, round(sum(x * x * n) / sum(n) - (sum(x * n) / sum(n)) ** 2, 4) AS variance, min(x) FILTER (after > kept * 0.5) AS median FROM m GROUP BY 1""")
def q_histogram_summary(s, d):
    return rounded(rounded(moments.histogram_summary(table(s, d, "lineitem"), "l_quantity", ["l_linestatus"], 0.05), 6, "mean"), 4, "variance")


@query("""
WITH m AS (SELECT l_returnflag, avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS s FROM lineitem GROUP BY 1)
SELECT l_returnflag, count(*) AS n FROM lineitem JOIN m USING (l_returnflag) WHERE abs(l_extendedprice - m) <= 1.5 * s GROUP BY 1""")
def q_near_mean(s, d):
    return moments.near_mean(table(s, d, "lineitem"), "l_extendedprice", ["l_returnflag"], 1.5).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query()
def q_kernel_density(s, d):
    return moments.kernel_density(table(s, d, "lineitem"), "l_extendedprice")


# ---- coverage


@query("""
WITH r AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events)
SELECT user_id, CAST((k - 1) // 10 AS BIGINT) AS "window", count(*) AS n, round(avg(value), 6) AS mean_value FROM r GROUP BY ALL""")
def q_tumbling_windows(s, d):
    return rounded(coverage.tumbling_windows(table(s, d, "events"), ["user_id"], ["ts", "event_id"], 10, ["value"]), 6, "mean_value")


@query("""
SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING), 6) AS profile FROM events""")
def q_centred_profile(s, d):
    return rounded(coverage.centred_profile(table(s, d, "events"), ["user_id"], ["ts", "event_id"], 7, "value"), 6, "profile").select("event_id", "profile")


@query("""
WITH o AS (SELECT p_partkey, p_size, CAST(coalesce(sum(p_size) OVER (ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset" FROM part) SELECT * FROM o""")
def q_concatenated_offsets(s, d):
    return coverage.concatenated_offsets(table(s, d, "part").select("p_partkey", "p_size"), "p_partkey", "p_size")


@query("""
WITH o AS (SELECT p_partkey, coalesce(sum(p_size) OVER (ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM part)
SELECT CAST(floor((o + 1 + l_linenumber % 7 - 1) / 1000) AS BIGINT) AS "window", count(*) AS n FROM lineitem JOIN o ON l_partkey = p_partkey GROUP BY 1""")
def q_window_tally(s, d):
    offsets = coverage.concatenated_offsets(table(s, d, "part").select("p_partkey", "p_size"), "p_partkey", "p_size")
    points = table(s, d, "lineitem").select(F.col("l_partkey").alias("p_partkey"), (1 + F.col("l_linenumber") % 7).alias("pos"))
    return coverage.window_tally(points, offsets, "p_partkey", "pos", 1000)


@query("SELECT l_orderkey, count(*) AS sites, round(avg(l_quantity), 6) AS coverage FROM lineitem GROUP BY 1")
def q_site_coverage(s, d):
    return rounded(coverage.site_coverage(table(s, d, "lineitem"), "l_orderkey", "l_quantity"), 6, "coverage")


@query("""
WITH g AS (SELECT l_orderkey AS ctg, l_linenumber AS pos, max(l_discount) AS gc FROM lineitem WHERE l_returnflag <> 'A' GROUP BY ALL),
p AS (SELECT l_orderkey AS ctg, l_linenumber AS pos, max(l_quantity) AS depth FROM lineitem WHERE l_linestatus = 'O' GROUP BY ALL)
SELECT ctg, pos, gc, depth FROM g JOIN p USING (ctg, pos) WHERE depth > 0 AND gc >= 0""")
def q_merge_gc_and_depth(s, d):
    li = table(s, d, "lineitem").select(F.col("l_orderkey").alias("ctg"), F.col("l_linenumber").alias("pos"), "l_discount", "l_quantity", "l_returnflag", "l_linestatus")
    g = li.where("l_returnflag <> 'A'").groupBy("ctg", "pos").agg(F.max("l_discount").alias("gc"))
    p = li.where("l_linestatus = 'O'").groupBy("ctg", "pos").agg(F.max("l_quantity").alias("depth"))
    return coverage.merge_gc_and_depth(g, p, "ctg", "pos")


@query("""
WITH m AS (SELECT (user_id * 37 + event_id * 11) % 500 AS a, 1 + event_id % 40 AS n FROM events),
e AS (SELECT (a + k) % 500 + 1 AS pos FROM m, unnest(range(0, n)) t(k)) SELECT pos, count(*) AS depth FROM e GROUP BY 1""")
def q_circular_depth(s, d):
    m = table(s, d, "events").select((F.expr("(user_id * 37 + event_id * 11) % 500") + 1).alias("start"), F.expr("1 + event_id % 40").alias("n"))
    return coverage.circular_depth(m, "start", "n", 500)


@query("""
SELECT doc_id, round(CAST(length(regexp_replace(text, '[^GCgc]', '', 'g')) AS DOUBLE) / nullif(length(text), 0), 9) AS gc,
  round(CAST(length(regexp_replace(text, '[^GCgcSs]', '', 'g')) AS DOUBLE) / nullif(length(text), 0), 9) AS gcs,
  round(CAST(length(regexp_replace(text, '[^GCgc]', '', 'g')) AS DOUBLE) / nullif(length(regexp_replace(text, '[^ACGTacgt]', '', 'g')), 0), 9) AS gc_known FROM documents""")
def q_gc_fraction(s, d):
    t = F.col("text")
    return table(s, d, "documents").select("doc_id", F.round(seq.gc_fraction(t), 9).alias("gc"), F.round(seq.gc_fraction(t, strong=True), 9).alias("gcs"), F.round(seq.gc_fraction(t, known_only=True), 9).alias("gc_known"))


# ---- sequence functions


@query("""
WITH t AS (SELECT doc_id, upper(regexp_replace(text, '[^ACGTacgt]', '', 'g')) AS s FROM documents), r AS (SELECT *, reverse(translate(s, 'ACGT', 'TGCA')) AS rc FROM t)
SELECT doc_id, md5(rc) AS rc, md5(least(s, rc)) AS canon, s = rc AS palindrome FROM r""")
def q_reverse_complement(s, d):
    t = table(s, d, "documents").select("doc_id", F.upper(F.regexp_replace("text", "[^ACGTacgt]", "")).alias("s"))
    x = F.col("s")
    return t.select("doc_id", F.md5(seq.revcomp(x)).alias("rc"), F.md5(seq.canonical(x)).alias("canon"), seq.is_palindrome(x).alias("palindrome"))


@query("""
WITH n AS (SELECT p_name AS x, min(p_partkey) AS a FROM part WHERE p_partkey IS NOT NULL GROUP BY 1)
SELECT v.a, w.a AS b, v.x, w.x AS y, round(1 - CAST(levenshtein(v.x, w.x) AS DOUBLE) / greatest(length(v.x), length(w.x)), 9) AS similarity FROM n v JOIN n w ON v.a < w.a OR (v.a = w.a AND v.x < w.x)
UNION ALL SELECT n.a, p_partkey, n.x, p_name, CASE WHEN p_name IS NOT NULL THEN CAST(1 AS DOUBLE) END FROM part JOIN n ON p_name IS NOT DISTINCT FROM n.x WHERE p_partkey <> n.a""")
def q_similarity(s, d):
    return hits.similar_classes(table(s, d, "part"), "p_partkey", "p_name")


@query("""
WITH t AS (SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS k, o_orderpriority AS p FROM orders)
SELECT o_orderkey, CAST(hamming(lpad(k, 8, '0'), lpad(CAST(o_orderkey * 7 AS VARCHAR), 8, '0')) AS INT) AS mismatches FROM t""")
def q_hamming(s, d):
    o = table(s, d, "orders")
    return o.select("o_orderkey", seq.hamming(F.lpad(F.col("o_orderkey").cast("string"), 8, "0"), F.lpad((F.col("o_orderkey") * 7).cast("string"), 8, "0")).alias("mismatches"))


# ---- k-mers


@query("""
WITH k AS (SELECT substr(text, i, 5) AS kmer FROM benchmark, unnest(range(1, length(text) - 3)) t(i)) SELECT kmer, count(*) AS n FROM k GROUP BY 1""")
def q_kmer_counts(s, d):
    return kmers.kmer_counts(table(s, d, "benchmark"), "text", 5, strands=False, letters=None)


@query("""
WITH t AS (SELECT upper(regexp_replace(text, '[^ACGTacgt]', '', 'g')) AS s FROM documents), k AS (SELECT substr(s, i, 7) AS x FROM t, unnest(range(1, length(s) - 5)) u(i))
SELECT least(x, reverse(translate(x, 'ACGT', 'TGCA'))) AS kmer, count(*) AS n FROM k GROUP BY 1 HAVING count(*) >= 2""")
def q_canonical_kmers(s, d):
    t = table(s, d, "documents").select(F.upper(F.regexp_replace("text", "[^ACGTacgt]", "")).alias("s"))
    return kmers.kmer_counts(t, "s", 7, least=2)


@query("""
WITH k AS (SELECT substr(text, i, 5) AS kmer FROM benchmark, unnest(range(1, length(text) - 3)) t(i)), c AS (SELECT kmer, count(*) AS n FROM k GROUP BY 1)
SELECT n AS multiplicity, count(*) AS kmers FROM c GROUP BY 1""")
def q_kmer_spectrum(s, d):
    return kmers.spectrum(kmers.kmer_counts(table(s, d, "benchmark"), "text", 5, strands=False, letters=None))


@query("""
WITH a AS (SELECT substr(text, i, 4) AS key, count(*) AS n_a FROM benchmark, unnest(range(1, length(text) - 2)) t(i) GROUP BY 1),
b AS (SELECT substr(text, i, 4) AS key, count(*) AS n_b FROM conversations, unnest(range(1, length(text) - 2)) t(i) GROUP BY 1)
SELECT key, n_a, n_b, CASE WHEN n_b IS NULL THEN 'a' WHEN n_a IS NULL THEN 'b' ELSE 'shared' END AS part, round(n_a / (SELECT sum(n_a) FROM a), 9) AS f_a, round(n_b / (SELECT sum(n_b) FROM b), 9) AS f_b
FROM a FULL OUTER JOIN b USING (key)""")
def q_kmer_sets(s, d):
    count = lambda t: kmers.kmer_counts(table(s, d, t), "text", 4, strands=False, letters=None)
    return rounded(pairing.merge_counts(count("benchmark"), count("conversations"), "kmer", "n"), 9, "f_a", "f_b")


@query()
def q_kmer_graph(s, d):
    t = table(s, d, "documents").select(F.upper(F.regexp_replace("text", "[^ACGTacgt]", "")).alias("s"))
    return kmers.kmer_graph(t, "s", 8, 2)


# ---- hits


@query("""SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity >= 10 AND l_discount >= 0.02 AND l_tax <= 0.06 AND l_extendedprice <= 50000""")
def q_threshold_inclusive(s, d):
    return hits.threshold(table(s, d, "lineitem"), {"l_quantity": 10, "l_discount": 0.02}, {"l_tax": 0.06, "l_extendedprice": 50000}).select("l_orderkey", "l_linenumber")


@query("""SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity > 10 AND l_discount > 0.02 AND l_tax < 0.06 AND l_extendedprice < 50000""")
def q_threshold_strict(s, d):
    return hits.threshold(table(s, d, "lineitem"), {"l_quantity": 10, "l_discount": 0.02}, {"l_tax": 0.06, "l_extendedprice": 50000}, inclusive=False).select("l_orderkey", "l_linenumber")


_SOLD = "WITH q AS (SELECT l_partkey, l_suppkey, CAST(sum(l_quantity) AS BIGINT) AS score FROM lineitem GROUP BY ALL)"


def _sold(s, d):
    return table(s, d, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.sum("l_quantity").cast("long").alias("score"))


@query(_SOLD + """, a AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY score DESC, l_partkey DESC, l_suppkey DESC) AS k FROM q),
b AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY score DESC, l_partkey DESC, l_suppkey DESC) AS k FROM q)
SELECT l_partkey, l_suppkey FROM a JOIN b USING (l_partkey, l_suppkey) WHERE a.k = 1 AND b.k = 1""")
def q_reciprocal_best(s, d):
    return hits.reciprocal_best(_sold(s, d), "l_partkey", "l_suppkey", [F.col("score"), F.col("l_partkey"), F.col("l_suppkey")])


@query(_SOLD + """ SELECT l_partkey, l_suppkey, score FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY score DESC, l_suppkey) AS l, row_number() OVER (PARTITION BY l_suppkey ORDER BY score DESC, l_partkey) AS r FROM q) WHERE l <= 3 OR r <= 3""")
def q_symmetric_top(s, d):
    return hits.symmetric_top(_sold(s, d), "l_partkey", "l_suppkey", F.col("score"), 3)


@query("""SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_orderkey, l_linenumber) AS k FROM lineitem) WHERE k = 1""")
def q_first_wins(s, d):
    return hits.first_wins(table(s, d, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber"), ["l_partkey", "l_suppkey"], ["l_orderkey", "l_linenumber"])


@query("""SELECT least(o_custkey, o_orderkey % 100) AS a, greatest(o_custkey, o_orderkey % 100) AS b, CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) // count(*) AS BIGINT) AS score FROM orders GROUP BY 1, 2""")
def q_merge_duplicate_scores(s, d):
    o = table(s, d, "orders").select("o_custkey", F.expr("o_orderkey % 100").alias("k"), F.floor("o_totalprice").alias("v"))
    return hits.merge_duplicate_scores(o, "o_custkey", "k", "v", average=True)


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def q_not_in_list(s, d):
    return hits.in_lists(table(s, d, "customer"), table(s, d, "orders").where("o_orderstatus = 'F'").withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", keep=False).select("c_custkey")


@query("SELECT p_partkey FROM part WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 45)")
def q_in_list(s, d):
    return hits.in_lists(table(s, d, "part"), table(s, d, "lineitem").where("l_quantity > 45").withColumnRenamed("l_partkey", "p_partkey"), "p_partkey").select("p_partkey")


@query("SELECT doc_id FROM documents WHERE regexp_matches(text, '(?i)the') AND regexp_matches(text, '(?i)license') AND NOT regexp_matches(text, '(?i)apache')")
def q_search_terms(s, d):
    return hits.matches_all(table(s, d, "documents"), F.col("text"), ["the", "license", "-apache"]).select("doc_id")


# ---- orthologs

_MEMBERS = "WITH m AS (SELECT DISTINCT l_partkey AS g, n_regionkey AS t FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"


def _members(s, d):
    sup = table(s, d, "supplier").join(table(s, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_regionkey").alias("t"))
    return table(s, d, "lineitem").join(sup, F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("l_partkey").alias("g"), "t")


@query(_MEMBERS + """, n AS (SELECT t, count(*) AS n FROM m GROUP BY 1), c AS (SELECT x.t AS a, y.t AS b, count(*) AS core FROM m x JOIN m y USING (g) WHERE x.t < y.t GROUP BY ALL)
SELECT x.t AS a, y.t AS b, x.n + y.n - coalesce(core, 0) AS pan, coalesce(core, 0) AS core, round((x.n + y.n - 2 * coalesce(core, 0)) / (x.n + y.n - coalesce(core, 0)), 9) AS variable
FROM n x JOIN n y ON x.t < y.t LEFT JOIN c ON c.a = x.t AND c.b = y.t""")
def q_pan_core(s, d):
    return rounded(orthologs.pan_core(_members(s, d), "g", "t"), 9, "variable")


@query(_MEMBERS + " SELECT g, " + ", ".join(f"CAST(count(*) FILTER (t = {k}) AS INT) AS t{k}" for k in range(5)) + " FROM m GROUP BY g")
def q_presence_matrix(s, d):
    m = _members(s, d).withColumn("t", F.concat(F.lit("t"), F.col("t").cast("string")))
    out = orthologs.count_matrix(m, "g", "t", [f"t{k}" for k in range(5)], presence=True)
    return out.select("g", *[F.col(f"t{k}").cast("int") for k in range(5)])


@query("""
WITH m AS (SELECT l_partkey AS g, n_regionkey AS t, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL)
SELECT x.t AS a, y.t AS b, count(*) AS n FROM m x JOIN m y USING (g) WHERE x.t < y.t OR (x.t = y.t AND x.n > 1) GROUP BY ALL""")
def q_co_occurrence(s, d):
    return orthologs.co_occurrence(_members(s, d), "g", "t")


@query(_MEMBERS + " SELECT g FROM m GROUP BY g HAVING count(*) = 5")
def q_core_groups(s, d):
    return orthologs.core_groups(_members(s, d), "g", "t", 5)


@query("""
WITH a AS (SELECT c_custkey AS k FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'))
SELECT (SELECT max(o_orderkey) FROM orders WHERE o_orderstatus = 'F') + row_number() OVER (ORDER BY substr(CAST(k AS VARCHAR), 1, 2), k) AS o_orderkey, k AS o_custkey FROM a""")
def q_number_singletons(s, d):
    members = table(s, d, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return pairing.number_singletons(members, table(s, d, "orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey"), "o_custkey", "o_orderkey")


# ---- pairing


@query("""
WITH u AS (SELECT conv_id, arg_max(turn, turn) FILTER (role = 'user') AS turn_1, arg_max(turn, turn) FILTER (role = 'assistant') AS turn_2 FROM conversations GROUP BY 1)
SELECT conv_id, turn_1, turn_2, CASE WHEN turn_1 IS NOT NULL AND turn_2 IS NOT NULL THEN 'paired' WHEN turn_1 IS NOT NULL THEN 'first' ELSE 'second' END AS state FROM u WHERE turn_1 IS NOT NULL OR turn_2 IS NOT NULL""")
def q_repair(s, d):
    return pairing.repair(table(s, d, "conversations"), ["conv_id"], F.when(F.col("role") == "user", 1).when(F.col("role") == "assistant", 2), "turn", ["turn"])


@query("""
WITH r AS (SELECT event_id, user_id, event_type, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER w OR row_number() OVER w = 1 THEN 1 ELSE 0 END AS new, ts FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM r),
k AS (SELECT *, row_number() OVER (PARTITION BY user_id, run ORDER BY ts, event_id) AS k, count(*) OVER (PARTITION BY user_id, run) AS n FROM g)
SELECT event_id, CASE WHEN k = n AND n % 2 = 1 THEN NULL WHEN k % 2 = 1 THEN 'first' ELSE 'second' END AS pair FROM k""")
def q_adjacent_pairs(s, d):
    return pairing.adjacent_pairs(table(s, d, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type")).select("event_id", "pair")


@query("SELECT a.event_id, a.user_id AS user_id_1, b.o_custkey AS o_custkey_2 FROM events a JOIN orders b ON a.event_id = b.o_orderkey")
def q_zip_rows(s, d):
    return pairing.zip_rows(table(s, d, "events").select("event_id", "user_id"), table(s, d, "orders").select(F.col("o_orderkey").alias("event_id"), "o_custkey"), "event_id")


@query("SELECT event_id * 2 AS k, user_id AS v FROM events UNION ALL SELECT o_orderkey * 2 + 1, o_custkey FROM orders")
def q_interleave(s, d):
    return pairing.interleave(table(s, d, "events").select(F.col("event_id").alias("k"), F.col("user_id").alias("v")), table(s, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("v")), "k")


@query("SELECT p_partkey, regexp_replace(regexp_replace(p_name, 'a', 'b', 'g'), 'bb', 'c', 'g') AS name FROM part")
def q_rename_by_rules(s, d):
    return table(s, d, "part").select("p_partkey", pairing.rename_by_rules(F.col("p_name"), [("a", "b"), ("bb", "c")]).alias("name"))


# ---- islands

_SESSION = """WITH r AS (SELECT *, CASE WHEN ts - lag(ts) OVER w > INTERVAL 1 HOUR OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
g AS (SELECT *, CAST(sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM r)"""


@query(_SESSION + " SELECT user_id, island, count(*) AS n, min(event_id) AS first, max(event_id) AS last FROM g GROUP BY ALL")
def q_sessions(s, d):
    from pyspark.sql import Window

    e = table(s, d, "events")
    gap = F.col("ts") - F.lag("ts").over(Window.partitionBy("user_id").orderBy("ts", "event_id")) > F.expr("INTERVAL '1' HOUR")
    return islands.sessions(e, ["user_id"], ["ts", "event_id"], gap).groupBy("user_id", "island").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first"), F.max("event_id").alias("last"))


@query("""
WITH p AS (SELECT DISTINCT l_suppkey, date_diff('day', TIMESTAMP '1970-01-01', l_shipdate) AS pos FROM lineitem), g AS (SELECT *, pos - row_number() OVER (PARTITION BY l_suppkey ORDER BY pos) AS g FROM p)
SELECT l_suppkey, min(pos) AS first, max(pos) AS last, count(*) AS n FROM g GROUP BY l_suppkey, g""")
def q_runs(s, d):
    li = table(s, d, "lineitem").select("l_suppkey", F.unix_date(F.to_date("l_shipdate")).cast("long").alias("day"))
    return islands.runs(li, ["l_suppkey"], "day")


@query("""
WITH i AS (SELECT l_suppkey, CAST(l_partkey AS BIGINT) AS a, CAST(l_partkey + l_quantity AS BIGINT) AS b FROM lineitem),
r AS (SELECT *, max(b) OVER (PARTITION BY l_suppkey ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM i),
g AS (SELECT *, sum(CASE WHEN reach IS NULL OR a > reach THEN 1 ELSE 0 END) OVER (PARTITION BY l_suppkey ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS g FROM r)
SELECT l_suppkey, min(a) AS a, max(b) AS b, count(*) AS n FROM g GROUP BY l_suppkey, g""")
def q_merge_overlapping(s, d):
    i = table(s, d, "lineitem").select("l_suppkey", F.col("l_partkey").cast("long").alias("a"), (F.col("l_partkey") + F.col("l_quantity")).cast("long").alias("b"))
    return islands.merge_overlapping(i, ["l_suppkey"], "a", "b")


@query("""
WITH i AS (SELECT s_nationkey, s_suppkey, 100 + s_suppkey * 13 % 900 AS c, 100 + s_suppkey * 13 % 900 - s_suppkey % 50 AS lo, 100 + s_suppkey * 13 % 900 + s_suppkey % 50 AS hi FROM supplier),
r AS (SELECT *, CASE WHEN lag(c) OVER w IS NULL OR lo > lag(hi) OVER w OR c > 2 * lag(c) OVER w THEN 1 ELSE 0 END AS new FROM i WINDOW w AS (PARTITION BY s_nationkey ORDER BY c, lo, hi, s_suppkey)),
g AS (SELECT *, CAST(sum(new) OVER (PARTITION BY s_nationkey ORDER BY c, lo, hi, s_suppkey ROWS UNBOUNDED PRECEDING) AS BIGINT) AS "group" FROM r)
SELECT s_nationkey, "group", count(*) AS n, min(lo) AS low, max(hi) AS high FROM g GROUP BY ALL""")
def q_merge_ranges_in_order(s, d):
    i = table(s, d, "supplier").selectExpr("s_nationkey", "100 + s_suppkey * 13 % 900 AS c", "100 + s_suppkey * 13 % 900 - s_suppkey % 50 AS lo", "100 + s_suppkey * 13 % 900 + s_suppkey % 50 AS hi")
    return islands.merge_ranges_in_order(i, ["s_nationkey"], "c", "lo", "hi")


@query("""
WITH i AS (SELECT DISTINCT l_suppkey AS k, CAST(l_partkey AS BIGINT) AS a, CAST(l_partkey + l_quantity AS BIGINT) AS b FROM lineitem), w AS (SELECT max(p_partkey) + 50 AS hi FROM part),
r AS (SELECT k, a, b, coalesce(max(b) OVER (PARTITION BY k ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS reach FROM i),
g AS (SELECT k, reach + 1 AS gap_start, a - 1 AS gap_end FROM r UNION ALL SELECT k, max(b) + 1, (SELECT hi FROM w) FROM i GROUP BY k)
SELECT * FROM g WHERE gap_end - gap_start + 1 >= 5""")
def q_gaps(s, d):
    hi = table(s, d, "part").agg((F.max("p_partkey") + 50).alias("hi"))
    i = table(s, d, "lineitem").select(F.col("l_suppkey").alias("k"), F.col("l_partkey").cast("long").alias("a"), (F.col("l_partkey") + F.col("l_quantity")).cast("long").alias("b")).crossJoin(F.broadcast(hi))
    return islands.gaps(i, ["k"], "a", "b", F.lit(1).cast("long"), F.col("hi"), 5)


@query("""
WITH r AS (SELECT 1000 * n_nationkey AS lo, 1000 * n_nationkey + 300 AS hi FROM nation)
SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM r WHERE o_totalprice BETWEEN lo AND hi)""")
def q_outside_ranges(s, d):
    r = table(s, d, "nation").selectExpr("1000 * n_nationkey AS lo", "1000 * n_nationkey + 300 AS hi")
    return islands.outside_ranges(table(s, d, "orders"), "o_totalprice", r, "lo", "hi", bins=1000.0).select("o_orderkey")


@query("""
WITH a AS (SELECT p_partkey, p_partkey * 3 AS x, p_partkey * 3 + p_size AS y FROM part), b AS (SELECT s_suppkey, s_suppkey * 50 AS u, s_suppkey * 50 + 30 AS v FROM supplier)
SELECT p_partkey, s_suppkey FROM a JOIN b ON x <= v AND u <= y""")
def q_overlap_join(s, d):
    a = table(s, d, "part").selectExpr("1 AS one", "p_partkey", "p_partkey * 3 AS a_start", "p_partkey * 3 + p_size AS a_end")
    b = table(s, d, "supplier").selectExpr("1 AS one", "s_suppkey", "s_suppkey * 50 AS b_start", "s_suppkey * 50 + 30 AS b_end")
    return islands.overlap_join(a, b, ["one"], 50).select("p_partkey", "s_suppkey")


@query("""
WITH p AS (SELECT vec_id, label, embedding[1] AS x, embedding[2] AS y FROM embeddings)
SELECT a.label, a.vec_id, CAST(count(b.vec_id) AS BIGINT) AS neighbours FROM p a LEFT JOIN p b ON a.label = b.label AND a.vec_id <> b.vec_id AND abs(a.x - b.x) <= 0.05 AND abs(a.y - b.y) <= 0.05 GROUP BY ALL""")
def q_neighbour_counts(s, d):
    p = table(s, d, "embeddings").select("label", "vec_id", F.col("embedding")[0].alias("x"), F.col("embedding")[1].alias("y"))
    return cluster.neighbour_counts(p, ["label"], "vec_id", "x", "y", 0.05)


# ---- links


@query("""
WITH p AS (SELECT DISTINCT l_orderkey, l_partkey AS p FROM lineitem) SELECT a.p AS a, b.p AS b, count(*) AS n FROM p a JOIN p b USING (l_orderkey) WHERE a.p < b.p GROUP BY ALL HAVING count(*) > 1""")
def q_shared_orders(s, d):
    p = table(s, d, "lineitem").select("l_orderkey", F.col("l_partkey").alias("p")).distinct()
    pairs = p.toDF("l_orderkey", "a").join(p.toDF("l_orderkey", "b"), "l_orderkey").where("a < b")  # an order has a few lines
    return pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("""
WITH l AS (SELECT l_partkey AS src, l_suppkey AS dst, count(*) AS links, sum(CAST(floor(l_extendedprice) AS BIGINT)) AS gaps FROM lineitem GROUP BY ALL)
SELECT src, dst, links, CAST(gaps AS BIGINT) AS gaps, CAST(gaps // links AS BIGINT) AS distance FROM l""")
def q_mean_distance(s, d):
    l = table(s, d, "lineitem").groupBy(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst")).agg(F.count(F.lit(1)).alias("links"), F.sum(F.floor("l_extendedprice")).alias("gaps"))
    return links.mean_distance(l)


@query("""SELECT o_custkey AS contig, count(DISTINCT CASE WHEN o_custkey <> o_orderkey % 150 THEN o_orderkey % 150 END) AS neighbours, count(*) FILTER (o_custkey = o_orderkey % 150) AS self_links FROM orders GROUP BY 1""")
def q_degrees(s, d):
    return links.degrees(table(s, d, "orders").selectExpr("o_custkey AS src", "o_orderkey % 150 AS dst"))


@query("SELECT * FROM orders WHERE o_orderkey % 40 < 3")
def q_systematic_sample(s, d):
    return links.systematic_sample(table(s, d, "orders"), "o_orderkey", 40, 3)


# ---- graphs


@query("""
WITH RECURSIVE e AS (SELECT 'c' || c_custkey AS a, 'n' || c_nationkey AS b FROM customer UNION SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier),
u AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r(v, w) AS (SELECT a, a FROM u UNION SELECT r.v, u.b FROM r JOIN u ON r.w = u.a)
SELECT v, min(w) AS component FROM r GROUP BY v""")
def q_components(s, d):
    c = table(s, d, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("a"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("b"))
    u = table(s, d, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("a"), F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("b"))
    return graph.components(c.union(u))


_EDGES = "WITH e AS (SELECT l_suppkey % 60 AS src, l_partkey % 60 AS dst, count(*) AS pairs, round(avg(l_quantity), 9) AS distance FROM lineitem WHERE l_suppkey % 60 <> l_partkey % 60 GROUP BY ALL HAVING count(*) >= 24)"


def _edges(s, d):
    rows = table(s, d, "lineitem").where("l_suppkey % 60 <> l_partkey % 60").selectExpr("l_suppkey % 60 AS src", "l_partkey % 60 AS dst", "l_quantity AS distance")
    return rounded(graph.scaffold_edges(rows, 24), 9, "distance")


@query(_EDGES + " SELECT * FROM e")
def q_scaffold_edges(s, d):
    return _edges(s, d)


@query(_EDGES + " SELECT * FROM e WHERE NOT EXISTS (SELECT 1 FROM e x JOIN e y ON x.dst = y.src WHERE x.src = e.src AND y.dst = e.dst AND x.dst <> e.src AND x.dst <> e.dst)")
def q_transitive_reduction(s, d):
    return graph.two_step_reduction(_edges(s, d))  # as its SQL has it; all of it is in whole_transitive_reduction


@query()
def q_whole_transitive_reduction(s, d):
    return graph.transitive_reduction(_edges(s, d))


@query("""
WITH e AS (SELECT DISTINCT c_custkey % 700 AS src, (c_custkey * 31 + c_nationkey) % 700 AS dst FROM customer)
SELECT * FROM e WHERE src IN (SELECT src FROM e GROUP BY 1 HAVING count(*) = 1) AND dst IN (SELECT dst FROM e GROUP BY 1 HAVING count(*) = 1)""")
def q_unique_successors(s, d):
    return graph.unique_successors(table(s, d, "customer").selectExpr("c_custkey % 700 AS src", "(c_custkey * 31 + c_nationkey) % 700 AS dst").distinct())


@query()
def q_unitigs(s, d):
    t = table(s, d, "benchmark").select(F.upper(F.regexp_replace("text", "[^ACGTacgt]", "")).alias("s"))
    return graph.unitigs(graph.kept(kmers.kmer_counts(t, "s", 11)), 11)


@query()
def q_max_flow(s, d):
    e = table(s, d, "lineitem").groupBy((F.col("l_suppkey") % 50).alias("src"), (F.col("l_partkey") % 50 + 100).alias("dst")).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    return graph.max_flow(e, F.col("src") < 10, F.col("dst") >= 140, "bigint")


@query()
def q_longest_paths(s, d):
    e = table(s, d, "orders").selectExpr("o_custkey % 400 AS src", "o_custkey % 400 + 1 + o_orderkey % 3 AS dst").distinct()
    return graph.longest_paths(e, "bigint")


@query()
def q_dcj_distance(s, d):
    return graph.dcj_distance(_genomes(s, d), "a", "b")


def _genomes(s, d):
    chromosomes = table(s, d, "part").groupBy(F.col("p_brand").alias("chromosome"))
    a = chromosomes.agg(F.sort_array(F.collect_list("p_partkey")).alias("b")).select(F.lit("a").alias("genome"), "chromosome", F.transform("b", lambda x: x.cast("int")).alias("blocks"))
    b = chromosomes.agg(F.sort_array(F.collect_list(F.struct("p_size", "p_partkey"))).alias("b")).select(F.lit("b").alias("genome"), "chromosome", F.transform("b", lambda x: F.when(x["p_size"] % 2 == 0, x["p_partkey"]).otherwise(-x["p_partkey"]).cast("int")).alias("blocks"))
    return a.unionByName(b)


@query()
def q_dcj_operations(s, d):
    return graph.dcj_operations(_genomes(s, d), "a", "b")


# ---- clusters


@query("""
WITH RECURSIVE p AS (SELECT vec_id, label, embedding[1] AS x, embedding[2] AS y FROM embeddings),
n AS (SELECT a.label, a.vec_id AS a, b.vec_id AS b FROM p a JOIN p b ON a.label = b.label AND a.vec_id <> b.vec_id AND abs(a.x - b.x) <= 0.05 AND abs(a.y - b.y) <= 0.05),
c AS (SELECT label, a AS v FROM n GROUP BY ALL HAVING count(*) >= 4), e AS (SELECT n.a, n.b FROM n JOIN c x ON n.a = x.v JOIN c y ON n.b = y.v),
r(v, w) AS (SELECT v, v FROM c UNION SELECT r.v, e.b FROM r JOIN e ON r.w = e.a), k AS (SELECT v, min(w) AS cluster FROM r GROUP BY 1),
o AS (SELECT n.a AS v, min(k.cluster) AS cluster FROM n JOIN k ON n.b = k.v WHERE n.a NOT IN (SELECT v FROM c) GROUP BY 1)
SELECT label, vec_id, coalesce(k.cluster, o.cluster) AS cluster FROM p LEFT JOIN k ON k.v = vec_id LEFT JOIN o ON o.v = vec_id""")
def q_dbscan(s, d):
    p = table(s, d, "embeddings").select("label", "vec_id", F.col("embedding")[0].alias("x"), F.col("embedding")[1].alias("y"))
    return cluster.dbscan(p, ["label"], "vec_id", "x", "y", 0.05, 4)


@query()
def q_insert_mixture(s, d):
    m = cluster.best_mixture(table(s, d, "lineitem").select(F.col("l_extendedprice").cast("long").alias("v")), "v", 6)
    return s.createDataFrame([(k, float(w), float(mu), float(sd)) for k, (w, mu, sd) in enumerate(zip(m.weights, m.means, m.sds))], "part int, weight double, mean double, sd double")


@query("""
WITH r AS (SELECT l_orderkey, l_suppkey, l_linenumber, l_suppkey % 5 AS fam FROM lineitem), n AS (SELECT *, CASE WHEN l_linenumber - lag(l_linenumber) OVER w > 1 OR lag(l_linenumber) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM r WINDOW w AS (PARTITION BY l_orderkey, fam ORDER BY l_linenumber)),
g AS (SELECT *, sum(new) OVER (PARTITION BY l_orderkey, fam ORDER BY l_linenumber ROWS UNBOUNDED PRECEDING) AS run FROM n)
SELECT l_orderkey, l_linenumber, min(l_linenumber) OVER (PARTITION BY l_orderkey, fam, run) AS feature FROM g""")
def q_tandem_features(s, d):
    g = table(s, d, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_suppkey % 5 AS fam")
    return cluster.tandem_features(g, ["l_orderkey"], "fam", "l_linenumber", 1).select("l_orderkey", "l_linenumber", "feature")


@query("""WITH n AS (SELECT n_regionkey AS c, count(*) AS n FROM nation GROUP BY 1) SELECT x.c AS a, y.c AS b, CAST(CASE WHEN x.c = y.c THEN x.n * (x.n - 1) // 2 ELSE x.n * y.n END AS BIGINT) AS cells FROM n x JOIN n y ON x.c <= y.c""")
def q_cells(s, d):
    return cluster.cells(table(s, d, "nation"), "n_regionkey")


@query()
def q_collinear_chains(s, d):
    # a grid a supplier: all its points, and no more of them in a larger table
    p = table(s, d, "lineitem").selectExpr("l_suppkey AS grid", "l_partkey % 500 AS x", "l_orderkey % 500 AS y").distinct()
    return cluster.collinear_chains(p, ["grid"], "x", "y", 120.0, 3)


@query()
def q_synteny_blocks(s, d):
    genes = table(s, d, "part").selectExpr("p_brand AS contig", "p_partkey AS gene", "p_partkey AS order", "p_type AS family")
    one = table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    matches = one.join(one.select("l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"), F.col("l_partkey").alias("gene2")), ["l_orderkey", "l_linenumber"])
    return cluster.synteny_blocks(genes, matches.select(F.col("l_partkey").alias("gene1"), "gene2", F.col("l_quantity").alias("score")))


# ---- demultiplexing, scaffolds, scores, sampling


@query("""
WITH b AS (SELECT * FROM (VALUES (0, 'a', '10'), (1, 'b', '23'), (2, 'c', '44')) v(ord, ident, barcode)), x AS (SELECT p_partkey, ord, ident, hamming(p_code, barcode) AS dist FROM (SELECT p_partkey, right(p_brand, 2) AS p_code FROM part), b),
m AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY dist, ord) AS k FROM x)
SELECT p_partkey, CASE WHEN dist <= 1 THEN ident END AS ident, CASE WHEN dist <= 1 THEN CAST(dist AS INT) END AS distance FROM m WHERE k = 1""")
def q_barcodes(s, d):
    b = s.createDataFrame([(0, "a", "10"), (1, "b", "23"), (2, "c", "44")], "ord int, ident string, barcode string")
    return demux.best_barcode(table(s, d, "part").select("p_partkey", F.right("p_brand", F.lit(2)).alias("code")), b, ["p_partkey"], "code")


@query("""WITH t AS (SELECT event_type AS ident FROM events) SELECT ident, count(*) AS n FROM t GROUP BY 1 UNION ALL SELECT 'total', count(*) FROM t""")
def q_demux_counts(s, d):
    return demux.demux_counts(table(s, d, "events").select(F.col("event_type").alias("ident")))


@query("""
WITH x AS (SELECT doc_id, string_split_regex(text, '[Nn]{1,}') AS p FROM documents), e AS (SELECT doc_id, i, p[i] AS s FROM x, unnest(range(1, len(p) + 1)) t(i) WHERE p[i] <> '')
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) AS INT) AS part, md5(s) AS piece FROM e""")
def q_split_at_n(s, d):
    return scaffold.split_at_n(table(s, d, "documents").select("doc_id", "text"), "doc_id", "text").select("doc_id", "part", F.md5("text").alias("piece"))


@query("""
WITH t AS (SELECT doc_id, regexp_replace(text, '[.] ', 'NNNNNNNNNNNN', 'g') AS s FROM documents), x AS (SELECT doc_id, string_split_regex(s, '[Nn]{10,}') AS p, regexp_extract_all(s, '[Nn]{10,}') AS g FROM t),
e AS (SELECT doc_id, i, length(p[i]) AS n, coalesce(length(g[i]), 0) AS gap FROM x, unnest(range(1, len(p) + 1)) u(i)),
a AS (SELECT *, 1 + coalesce(sum(n + gap) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM e),
b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY start) AS k, start - min(start) OVER (PARTITION BY doc_id) + 1 AS beg FROM a WHERE n >= 20),
c AS (SELECT *, beg + n - 1 AS fin, lag(beg + n - 1) OVER (PARTITION BY doc_id ORDER BY k) AS prev FROM b)
SELECT doc_id AS object, CAST(beg AS BIGINT) AS object_beg, CAST(fin AS BIGINT) AS object_end, 2 * k - 1 AS part, 'W' AS type, doc_id || '_c' || k AS c6, '1' AS c7, CAST(n AS VARCHAR) AS c8, '+' AS c9 FROM c
UNION ALL SELECT doc_id, CAST(prev + 1 AS BIGINT), CAST(beg - 1 AS BIGINT), 2 * k - 2, 'N', CAST(CAST(beg - prev - 1 AS BIGINT) AS VARCHAR), 'scaffold', 'yes', 'paired-ends' FROM c WHERE prev IS NOT NULL""")
def q_agp(s, d):
    return scaffold.agp(table(s, d, "documents").select("doc_id", F.regexp_replace("text", "[.] ", "NNNNNNNNNNNN").alias("text")), "doc_id", "text", 10, 20)


@query("""
WITH e AS (SELECT lower(substr(a.text, i, 1)) AS x, lower(substr(b.text, i, 1)) AS y FROM benchmark a JOIN benchmark b ON b.item_id = a.item_id + 1, unnest(range(1, least(length(a.text), length(b.text)) + 1)) t(i))
SELECT x, y, count(*) AS n FROM e WHERE x IN ('a', 'e', 'n', 't') AND y IN ('a', 'e', 'n', 't') GROUP BY ALL""")
def q_substitution_matrix(s, d):
    b = table(s, d, "benchmark").select("item_id", F.lower("text").alias("a"))
    return score.substitution_matrix(b.join(b.select((F.col("item_id") - 1).alias("item_id"), F.col("a").alias("b")), "item_id"), "a", "b", "aent")


@query("""WITH r AS (SELECT unnest(regexp_extract_all(replace(text, ' ', '-'), '(-+)')) AS r FROM conversations) SELECT length(r) AS length, count(*) AS n FROM r GROUP BY 1""")
def q_gap_lengths(s, d):
    return score.gap_lengths(table(s, d, "conversations").select(F.translate("text", " ", "-").alias("t")), "t").withColumn("length", F.col("length").cast("long"))


@query("""
WITH c AS (SELECT count(*) FILTER (quality = 1 AND toxic = 1) AS tp, count(*) FILTER (quality = 0 AND toxic = 1) AS fp, count(*) FILTER (quality = 1 AND toxic = 0) AS fn, count(*) FILTER (quality = 0 AND toxic = 0) AS tn FROM labels)
SELECT *, round(tp / nullif(tp + fp, 0), 9) AS precision, round(tp / nullif(tp + fn, 0), 9) AS recall FROM c""")
def q_confusion(s, d):
    return rounded(score.confusion(table(s, d, "labels"), "quality", "toxic"), 9, "precision", "recall")


@query("""
WITH s AS (SELECT l_returnflag AS f, CAST(sum(l_quantity) AS DOUBLE) AS a, CAST(sum(l_extendedprice) AS DOUBLE) AS r, CAST(count(*) AS DOUBLE) AS m FROM lineitem GROUP BY 1)
SELECT f, round((a - m - 2 * m - 3 * m) / a, 9) AS precision, round((r - m - 2 * m - 4 * m) / r, 9) AS recall FROM s""")
def q_precision_recall(s, d):
    li = table(s, d, "lineitem").groupBy(F.col("l_returnflag").alias("f")).agg(F.sum("l_quantity").alias("a"), F.sum("l_extendedprice").alias("r"), F.count(F.lit(1)).alias("m"))
    li = li.withColumn("u", 2 * F.col("m")).withColumn("e", 3 * F.col("m")).withColumn("x", 4 * F.col("m"))
    return rounded(score.precision_recall(li, "a", "r", "m", "u", "e", "x"), 9, "precision", "recall").select("f", "precision", "recall")


@query("""
WITH b AS (SELECT DISTINCT l_suppkey AS ref, CAST(l_partkey AS BIGINT) AS a, CAST(l_partkey + l_linenumber * 20 AS BIGINT) AS b FROM lineitem), n AS (SELECT max(p_partkey) + 200 AS length FROM part),
p AS (SELECT ref, count(DISTINCT i) AS covered FROM b, unnest(range(greatest(a, 1), b + 1)) t(i) GROUP BY 1)
SELECT s_suppkey AS ref, coalesce(covered, 0) AS covered, (SELECT length FROM n) AS length, round(coalesce(covered, 0) / (SELECT length FROM n), 9) AS part FROM supplier LEFT JOIN p ON ref = s_suppkey""")
def q_reference_coverage(s, d):
    n = table(s, d, "part").agg((F.max("p_partkey") + 200).alias("length"))
    refs = table(s, d, "supplier").select(F.col("s_suppkey").alias("ref")).crossJoin(F.broadcast(n))
    blocks = table(s, d, "lineitem").select(F.col("l_suppkey").alias("ref"), F.col("l_partkey").cast("long").alias("start"), (F.col("l_partkey") + F.col("l_linenumber") * 20).cast("long").alias("end"))
    return rounded(score.reference_coverage(blocks, refs)[0], 9, "part")


@query("""
WITH g AS (SELECT l_returnflag, l_suppkey, avg(l_quantity) AS x, avg(l_extendedprice) AS y FROM lineitem GROUP BY ALL), c AS (SELECT l_returnflag, count(*) AS n FROM g GROUP BY 1),
t AS (SELECT a.l_returnflag, CAST(sum(CASE WHEN (a.x - b.x) * (a.y - b.y) > 0 THEN 1 ELSE -1 END) AS DOUBLE) AS s FROM g a JOIN g b ON a.l_returnflag = b.l_returnflag AND a.l_suppkey < b.l_suppkey GROUP BY 1)
SELECT l_returnflag, n, round(s / (n * (n - 1) / 2), 9) AS tau, round(3 * s / (n * (n - 1) / 2) * sqrt(n * (n - 1)) / sqrt(2 * (2 * n + 5)), 9) AS z FROM c JOIN t USING (l_returnflag)""")
def q_kendall(s, d):
    return rounded(score.kendall(table(s, d, "lineitem").select("l_returnflag", "l_suppkey", "l_orderkey", "l_quantity", "l_extendedprice").groupBy("l_returnflag", "l_suppkey").agg(F.avg("l_quantity").alias("x"), F.avg("l_extendedprice").alias("y")), "x", "y", "l_returnflag"), 9, "tau", "z")


@query("SELECT * FROM documents WHERE doc_id % 10 = 0")
def q_systematic(s, d):
    return simulate.systematic(table(s, d, "documents"), "doc_id", 10)


@query()
def q_bernoulli(s, d):
    return simulate.bernoulli(table(s, d, "conversations"), F.col("conv_id"), 0.3, 7)


@query()
def q_simulated_reads(s, d):
    c = table(s, d, "benchmark").select(F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("name"), F.upper(F.regexp_replace("text", "[^ACGTacgt]", "")).alias("seq"))
    return simulate.simulate_pairs(c, 20.0, 30, 60, 5)


@query()
def q_one_of_many(s, d):
    return simulate.one_of_many(table(s, d, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber"), "l_partkey", ["l_orderkey", "l_linenumber"], 3)


@query("""SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""")
def q_pricing_summary(s, d):
    li = table(s, d, "lineitem").where("l_shipdate <= TIMESTAMP '1998-09-02'")
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count(F.lit(1)).alias("n"))
