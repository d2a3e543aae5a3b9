"""More of the operators on the benchmark tables with their SQL: text formats written and read again, sequence and quality functions, links, routes.

A format's query writes lines made of a table into the shared folder and reads them back; its SQL takes the values from the table itself.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import alignment, numeric, quality
from ..functions import sequence as seq
from ..operators import cluster, coverage, demux, graph, hits, islands, lengths, links, orthologs, pairing, scaffold, score, simulate
from ..operators.staging import _folders, shared_dir
from ..sources import sinks, text
from .queries import query, rounded, table


def written(spark: SparkSession, lines: DataFrame) -> str:
    """The path of a text file set of the column value; it goes when the driver ends."""
    path = f"{shared_dir(spark)}/lines-{uuid.uuid4().hex[:12]}"
    _folders[path] = spark
    sinks.write_lines(lines.select("value"), path)
    return path


def tabbed(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(F.concat_ws("\t", *[F.expr(c).cast("string") for c in columns]).alias("value"))


_READS = """
WITH r AS (SELECT o_orderkey, o_custkey, translate(lpad(CAST(o_custkey * 104729 AS VARCHAR), 12, '0'), '0123456789', 'ACGTACGTNA') AS seq,
  translate(lpad(CAST(o_orderkey * 7919 AS VARCHAR), 12, '0'), '0123456789', '!+5?ABCDEI') AS qual FROM orders)"""


def _reads(s, d):
    o = table(s, d, "orders").selectExpr("o_orderkey", "o_custkey", "translate(lpad(cast(o_custkey * 104729 AS string), 12, '0'), '0123456789', 'ACGTACGTNA') AS seq")
    return o.selectExpr("*", "translate(lpad(cast(o_orderkey * 7919 AS string), 12, '0'), '0123456789', '!+5?ABCDEI') AS qual")


# ---- formats


@query(_READS + " SELECT 'r' || o_orderkey AS name, CAST(1 + o_orderkey % 2 AS INT) AS mate, seq, qual FROM r")
def q_fastq_round_trip(s, d):
    name = F.expr("concat('r', o_orderkey, '/', 1 + o_orderkey % 2)")
    return text.read_fastq(s, written(s, sinks.to_fastq(_reads(s, d), name, "seq", "qual"))).select("name", "mate", "seq", "qual")


@query(_READS + " SELECT 'r' || o_orderkey AS name, seq, repeat('I', 12) AS qual FROM r WHERE seq NOT LIKE '%N%'")
def q_fasta_to_fastq(s, d):
    reads = _reads(s, d).withColumn("name", F.expr("concat('r', o_orderkey)"))
    fasta = text.read_fasta(s, written(s, sinks.fastq_to_fasta(reads, no_n=True)))
    return text.read_fastq(s, written(s, sinks.to_fastq(fasta, F.col("name"), "seq"))).select("name", "seq", "qual")


@query("""
WITH t AS (SELECT doc_id, regexp_replace(text, '[^ACGTacgt]', '', 'g') AS s FROM documents)
SELECT 'org|d' || doc_id || '|size' || length(s) AS name, 'lang' AS descr, md5(s) AS seq, CAST(length(s) AS INT) AS len FROM t WHERE s <> ''""")
def q_fasta_round_trip(s, d):
    t = table(s, d, "documents").select("doc_id", F.regexp_replace("text", "[^ACGTacgt]", "").alias("s")).where("s != ''")
    name = F.concat(sinks.with_label(sinks.with_length(F.concat(F.lit("d"), F.col("doc_id").cast("string")), F.col("s")), "org"), F.lit(" lang"))
    return text.read_fasta(s, written(s, sinks.to_fasta(t, name, "s", 60))).select("name", "descr", F.md5("seq").alias("seq"), "len")


@query("""
SELECT 'q' || l_orderkey AS qname, CAST(l_orderkey % 64 AS INT) AS flag, 'c' || l_suppkey AS rname, CAST(l_partkey AS INT) AS pos, CAST(l_linenumber * 8 AS INT) AS mapq,
  CAST(l_quantity AS INT) + l_linenumber AS aligned, (l_orderkey % 64) & 16 <> 0 AS rev, 'XT:A:U' AS tag FROM lineitem""")
def q_sam_round_trip(s, d):
    lines = tabbed(table(s, d, "lineitem"), "concat('q', l_orderkey)", "l_orderkey % 64", "concat('c', l_suppkey)", "l_partkey", "l_linenumber * 8", "concat(cast(l_quantity AS int), 'M2I', l_linenumber, 'M')", "'*'", "0", "0", "'ACGT'", "'IIII'", "'XT:A:U'")
    rows = text.read_sam(s, written(s, lines))[1]
    return rows.select("qname", "flag", "rname", "pos", "mapq", alignment.cigar_length(F.col("cigar")).alias("aligned"), alignment.is_reverse(F.col("flag")).alias("rev"), F.col("tags")[0].alias("tag"))


@query("SELECT 'c' || s_suppkey AS name, CAST(1000 + s_suppkey AS INT) AS len FROM supplier")
def q_sam_header(s, d):
    lines = table(s, d, "supplier").select(F.expr("concat('@SQ\\tSN:c', s_suppkey, '\\tLN:', 1000 + s_suppkey)").alias("value"))
    return text.read_sam(s, written(s, lines))[0]


@query("""
SELECT 'p' || l_partkey AS query, 's' || l_suppkey AS subject, CAST(l_quantity AS DOUBLE) AS pid, CAST(l_linenumber AS INT) AS length, CAST(l_partkey AS INT) AS qstart, CAST(l_partkey + 9 AS INT) AS qend, CAST(l_tax AS DOUBLE) AS evalue, CAST(l_discount AS DOUBLE) AS bitscore FROM lineitem""")
def q_blast_round_trip(s, d):
    lines = tabbed(table(s, d, "lineitem"), "concat('p', l_partkey)", "concat('s', l_suppkey)", "l_quantity", "l_linenumber", "0", "0", "l_partkey", "l_partkey + 9", "1", "10", "l_tax", "l_discount")
    return text.read_blast(s, written(s, lines.unionByName(s.sql("SELECT '# comment' AS value")))).select("query", "subject", "pid", "length", "qstart", "qend", "evalue", "bitscore")


@query("""
SELECT CAST(p_size AS INT) AS "match", CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand, 'p' || p_partkey AS qname, CAST(p_size + 5 AS INT) AS qto, 'ref' AS rname, CAST(p_partkey AS INT) AS rfrom, CAST(3 + p_size AS INT) AS block_bases FROM part""")
def q_psl_round_trip(s, d):
    columns = ["p_size", "1", "0", "0", "0", "0", "0", "0", "if(p_partkey % 2 = 0, '+', '-')", "concat('p', p_partkey)", "100", "5", "p_size + 5", "'ref'", "100000", "p_partkey", "p_partkey + p_size", "2", "concat('3,', p_size, ',')", "'5,9,'", "'1,2,'"]
    rows = text.read_psl(s, written(s, tabbed(table(s, d, "part"), *columns)))
    return rows.select("match", "strand", "qname", "qto", "rname", "rfrom", F.expr("aggregate(blocks, 0, (n, b) -> n + b.size)").alias("block_bases"))


@query("""
SELECT CAST(p_partkey AS INT) AS rstart, CAST(p_partkey + p_size AS INT) AS rend, CAST(1 AS INT) AS qstart, CAST(p_size AS INT) AS qend, CAST(99.5 AS DOUBLE) AS identity, 'ref' AS ref, 'q' || p_partkey AS query FROM part""")
def q_coords_round_trip(s, d):
    lines = table(s, d, "part").select(F.expr("concat('  ', p_partkey, ' ', p_partkey + p_size, '  |  1 ', p_size, '  |  ', p_size + 1, ' ', p_size, '  |  99.5  |  ref q', p_partkey)").alias("value"))
    return text.read_coords(s, written(s, lines)).select("rstart", "rend", "qstart", "qend", "identity", "ref", "query")


@query("SELECT 'r' || l_orderkey AS read, 'c' || l_suppkey AS contig, count(*) AS n, min(l_partkey) AS start FROM lineitem GROUP BY 1, 2")
def q_bowtie_round_trip(s, d):
    lines = tabbed(table(s, d, "lineitem"), "concat('r', l_orderkey)", "'+'", "concat('c', l_suppkey)", "l_partkey", "'ACGT'")
    return text.read_delimited(s, written(s, lines), text.BOWTIE).groupBy("read", "contig").agg(F.count(F.lit(1)).alias("n"), F.min("start").cast("long").alias("start"))


@query("SELECT 'r' || l_orderkey AS read, max(l_partkey) AS start, CAST(sum(l_linenumber) AS BIGINT) AS score FROM lineitem GROUP BY 1")
def q_shrimp_round_trip(s, d):
    lines = tabbed(table(s, d, "lineitem"), "concat('r', l_orderkey)", "'c'", "'-'", "l_partkey", "l_partkey + 30", "1", "30", "30", "l_linenumber", "'30'")
    return text.read_delimited(s, written(s, lines), text.SHRIMP).groupBy("read").agg(F.max("start").cast("long").alias("start"), F.sum("score").alias("score"))


@query("SELECT p_type AS kmer, count(*) AS cnt FROM part GROUP BY 1")
def q_kmer_count_round_trip(s, d):
    n = table(s, d, "part").groupBy("p_type").agg(F.count(F.lit(1)).alias("n"))
    return text.read_delimited(s, written(s, tabbed(n, "p_type", "n")), text.KMER_COUNTS)


@query("SELECT 'c' || l_suppkey AS ctg, count(*) AS sites, round(avg(CAST(l_quantity AS INT)), 6) AS coverage FROM lineitem GROUP BY 1")
def q_pileup_coverage(s, d):
    lines = tabbed(table(s, d, "lineitem"), "concat('c', l_suppkey)", "l_partkey", "'A'", "cast(l_quantity AS int)", "'.'", "'I'")
    return rounded(coverage.site_coverage(text.read_delimited(s, written(s, lines), text.PILEUP), "ctg", "depth"), 6, "coverage")


@query("SELECT CAST(n_nationkey AS INT) AS lib, 'lib' || n_nationkey AS id, CAST(200 + n_nationkey * 10 AS VARCHAR) AS ins FROM nation")
def q_library_round_trip(s, d):
    lines = table(s, d, "nation").coalesce(1).sortWithinPartitions("n_nationkey").select(F.expr("concat('[LIB]\\nid=lib', n_nationkey, '\\np1=a.fastq\\n# note\\nins = ', 200 + n_nationkey * 10)").alias("value"))
    return text.read_libraries(s, written(s, lines)).select(F.col("lib").cast("int").alias("lib"), "id", F.col("attrs")["ins"].alias("ins"))


@query("""
SELECT 'l' || n_nationkey AS name, CAST(CASE WHEN n_nationkey % 5 = 0 THEN 0 ELSE 300 END AS DOUBLE) AS "insert", n_nationkey / 20 AS error,
  CASE WHEN n_nationkey % 5 = 0 THEN 'insert size' WHEN n_nationkey > 20 THEN 'error must be between 0 and 1' WHEN n_nationkey % 3 = 0 THEN 'orientation' END AS problem FROM nation""")
def q_scaffolder_libraries(s, d):
    lines = table(s, d, "nation").select(F.expr("concat_ws(' ', concat('l', n_nationkey), 'a.fq', 'b.fq', if(n_nationkey % 5 = 0, 0, 300), n_nationkey / 20, if(n_nationkey % 3 = 0, 'XX', 'FR'))").alias("value"))
    return text.read_scaffolder_libraries(s, written(s, lines)).select("name", "insert", "error", "problem")


@query("""SELECT 'sp' || n_regionkey AS species, string_agg(repeat('A', CAST(n_nationkey % 4 + 1 AS INT)) || '-', '' ORDER BY n_nationkey) AS seq FROM nation GROUP BY 1""")
def q_maf_to_mfa(s, d):
    lines = table(s, d, "nation").coalesce(1).sortWithinPartitions("n_nationkey").select(F.expr("concat('a score=1\\ns sp', n_regionkey, '.chr1 ', n_nationkey, ' 4 + 100 ', repeat('A', n_nationkey % 4 + 1), '-\\n')").alias("value"))
    return sinks.maf_to_mfa(text.read_maf(s, written(s, lines)))


@query("SELECT 'g' || n_regionkey AS gid, 'n' || n_nationkey % 3 AS taxon, n_name AS tag FROM nation WHERE n_name NOT LIKE '% %'")
def q_ortholog_groups(s, d):
    n = table(s, d, "nation").where("n_name NOT LIKE '% %'").selectExpr("concat('g', n_regionkey) AS g", "concat('n', n_nationkey % 3, '|', n_name) AS m")
    lines = n.groupBy("g").agg(F.concat_ws(" ", F.sort_array(F.collect_list("m"))).alias("m")).select(F.concat_ws(": ", "g", "m").alias("value"))
    return orthologs.parse_groups(s.read.text(written(s, lines)))


@query("""
SELECT concat_ws(':', 'M', o_custkey % 8, 1, 2, 3, o_orderkey) AS name, CAST(1 + o_orderkey % 2 AS INT) AS mate, seq, qual, o_orderkey % 3 > 0 AS passed FROM (""" + _READS.strip() + """ SELECT * FROM r)""")
def q_qseq_round_trip(s, d):
    r = _reads(s, d).withColumn("q64", quality.shift(F.col("qual"), 31))
    lines = tabbed(r, "'M'", "o_custkey % 8", "1", "2", "3", "o_orderkey", "0", "1 + o_orderkey % 2", "translate(seq, 'N', '.')", "q64", "if(o_orderkey % 3 > 0, 1, 0)")
    return text.read_qseq(s, written(s, lines))


# ---- functions


@query("""
WITH t AS (SELECT p_partkey, p_name || repeat('N', CAST(p_size % 4 AS INT)) AS x FROM part)
SELECT p_partkey, regexp_replace(x, '[Nn]+$', '') AS trimmed, regexp_replace(regexp_replace(x, '(.{5})', '\\1' || chr(10), 'g'), chr(10) || '$', '') AS wrapped FROM t""")
def q_trim_and_wrap(s, d):
    t = table(s, d, "part").select("p_partkey", F.expr("concat(p_name, repeat('N', p_size % 4))").alias("x"))
    return t.select("p_partkey", seq.trim_trailing_n(F.col("x")).alias("trimmed"), seq.wrap(F.col("x"), 5).alias("wrapped"))


@query("""
WITH p AS (SELECT l_orderkey, l_linenumber, CAST(l_partkey AS INT) AS p1, CAST(l_partkey + l_orderkey % 500 AS INT) AS p2, CAST(l_quantity AS INT) AS n, CAST(l_suppkey * 7 % 256 AS INT) AS q1, CAST(l_linenumber * 37 % 256 AS INT) AS q2 FROM lineitem)
SELECT l_orderkey, l_linenumber, p2 - p1 + n AS "insert", p1 + n + 5000 - p2 AS across, (q1 % 255 + q2 % 255) / 2 AS quality, (p2 - 1) % 100 + 1 AS circle FROM p WHERE (q1 % 255 + q2 % 255) / 2 >= 20""")
def q_pair_measures(s, d):
    p = table(s, d, "lineitem").selectExpr("l_orderkey", "l_linenumber", "cast(l_partkey AS int) AS p1", "cast(l_partkey + l_orderkey % 500 AS int) AS p2", "cast(l_quantity AS int) AS n", "cast(l_suppkey * 7 % 256 AS int) AS q1", "l_linenumber * 37 % 256 AS q2")
    c = F.col
    out = p.select("l_orderkey", "l_linenumber", alignment.insert_size(c("p1"), c("p2"), c("n")).alias("insert"), alignment.insert_size_across(c("p1"), c("n"), c("p2"), F.lit(5000)).alias("across"), alignment.mean_mapping_quality(c("q1"), c("q2")).alias("quality"), alignment.circular(c("p2"), F.lit(100)).alias("circle"))
    return out.where("quality >= 20")


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'M:1:FC:' || (o_custkey % 8 + 1) || ':1101:5:' || o_orderkey ELSE 'M' || o_orderkey || ':' || (o_custkey % 8 + 1) || ':9:4:7#ACGT' END AS name,
  CAST(1 + o_orderkey % 2 AS INT) AS mate, CAST(o_custkey % 8 + 1 AS INT) AS lane, CASE WHEN o_orderkey % 3 = 0 THEN 'TTGG' ELSE 'ACGT' END AS idx, CASE WHEN o_orderkey % 3 = 0 THEN 'M' ELSE 'M' || o_orderkey END AS prefix FROM orders""")
def q_read_headers(s, d):
    h = table(s, d, "orders").selectExpr("o_orderkey", "if(o_orderkey % 3 = 0, concat('M:1:FC:', o_custkey % 8 + 1, ':1101:5:', o_orderkey, ' ', 1 + o_orderkey % 2, ':N:0:TTGG'), concat('M', o_orderkey, ':', o_custkey % 8 + 1, ':9:4:7#ACGT/', 1 + o_orderkey % 2)) AS h")
    h = h.withColumn("x", demux.lane_and_mate(F.col("h")))
    return h.select("o_orderkey", seq.read_name(F.col("h")).alias("name"), seq.read_mate(F.col("h")).alias("mate"), "x.lane", F.col("x.index").alias("idx"), seq.header_prefix(F.col("h")).alias("prefix"))


@query(_READS + """, m AS (SELECT *, length(regexp_extract(qual, '^[^!+]*')) AS good, regexp_replace(qual, '[^!+]', '-', 'g') AS mask FROM r),
t AS (SELECT *, CASE WHEN good = 12 THEN 'hq' WHEN good >= 5 THEN 'trimmed' ELSE 'lq' END AS route FROM m)
SELECT o_orderkey, translate(qual, '!+5?ABCDEI', '@JT^`abcdh') AS shifted, substr(seq, 1, good) AS trimmed,
  CASE WHEN strpos(mask, '---') > 0 THEN substr(seq, strpos(mask, '---'), length(regexp_extract(qual, '[^!+]{3,}'))) ELSE '' END AS run, route || '_' || route AS route FROM t""")
def q_quality_trims(s, d):
    q, x = F.col("qual"), F.col("seq")
    r = _reads(s, d).withColumn("t", demux.trim_route(x, q, 20, 5))
    return r.select("o_orderkey", quality.shift(q, 31).alias("shifted"), quality.trim_at_low(x, q, 20).alias("trimmed"), quality.first_good_run(x, q, 20, 3).alias("run"), demux.pair_route(F.col("t.route"), F.col("t.route")).alias("route"))


@query(_READS + """
SELECT o_orderkey, CASE WHEN seq NOT LIKE '%N%' THEN seq END AS strict, CASE WHEN NOT regexp_matches(seq, 'N.{0,2}N') THEN replace(seq, 'N', 'A') END AS mended FROM r""")
def q_alphabet_repair(s, d):
    return _reads(s, d).select("o_orderkey", demux.alphabet_repair(F.col("seq"), 1, 0, 1).alias("strict"), demux.alphabet_repair(F.col("seq"), 0, 1, 4).alias("mended"))


@query("""
WITH t AS (SELECT doc_id, upper(regexp_replace(text, '[^ACGTacgt]', '', 'g')) AS s, CAST(1 + doc_id % 50 AS INT) AS a, CAST(21 + doc_id % 50 + doc_id % 30 AS INT) AS b, doc_id % 2 = 1 AS back FROM documents),
p AS (SELECT *, substr(s, greatest(a - CASE WHEN back THEN 3 ELSE 5 END, 1), greatest(least(b + CASE WHEN back THEN 5 ELSE 3 END, length(s)) - greatest(a - CASE WHEN back THEN 3 ELSE 5 END, 1) + 1, 0)) AS part FROM t)
SELECT doc_id, CASE WHEN back THEN reverse(translate(part, 'ACGT', 'TGCA')) ELSE part END AS feature FROM p""")
def q_subsequences(s, d):
    t = table(s, d, "documents").select("doc_id", F.upper(F.regexp_replace("text", "[^ACGTacgt]", "")).alias("s"), F.expr("cast(1 + doc_id % 50 AS int)").alias("a"), F.expr("cast(21 + doc_id % 50 + doc_id % 30 AS int)").alias("b"), F.expr("if(doc_id % 2 = 1, -1, 1)").alias("strand"))
    return t.select("doc_id", seq.subsequence(F.col("s"), F.col("a"), F.col("b"), F.col("strand"), 5, 3).alias("feature"))


@query("""
WITH p AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS z, CAST(p_partkey AS DOUBLE) AS k, CAST(p_retailprice AS DOUBLE) AS v FROM part)
SELECT p_partkey, round(exp(-((v - 1000) ** 2) / (2 * 300.0 * 300.0)) / (300 * sqrt(2 * pi())), 9) AS pdf, round(ln(0.0001) / ln(1 - z / 1000) - 1, 4) AS quantile, round(sqrt(ln(1 - 0.05) / ln(1 - z / 100000) + 0.25) + 0.5, 6) AS reach,
  round(1 - exp(-10000 * pow(5 * z / 100000, 3) * z / 100000), 9) AS chance, round(z * 300 / nullif(k, 0), 6) AS links, CAST(greatest(15, floor(log2(k * 1000) + 3.99)) AS INT) AS m, CAST(floor(1.25 * log2(100 + z * 10) + 0.99) AS INT) AS n,
  CAST(greatest(1, floor(ln(k * 50) / ln(1.4) - 11.5)) AS INT) AS k, round(least(6 * z / (100 + z * 10), 0.95), 9) AS err FROM p""")
def q_formulas(s, d):
    p = table(s, d, "part").selectExpr("p_partkey", "cast(p_size AS double) AS z", "cast(p_partkey AS double) AS k", "p_retailprice AS v")
    z, k = F.col("z"), F.col("k")
    p = p.withColumn("x", numeric.scaffold_parameters(k * 1000, 100 + z * 10, 100 + z * 10, z, k * 50))
    out = p.select("p_partkey", numeric.normal_pdf(F.col("v"), F.lit(1000.0), F.lit(300.0)).alias("pdf"), numeric.geometric_quantile(1e-4, z / 1000).alias("quantile"), numeric.synteny_distance(0.05, z / 100000).alias("reach"), numeric.block_p_value(F.lit(10000.0), F.lit(5.0), z / 100000, F.lit(3.0)).alias("chance"), numeric.expected_links(z, F.lit(300.0), k).alias("links"), "x.m", "x.n", "x.k", "x.err")
    return rounded(rounded(rounded(out, 9, "pdf", "chance", "err"), 6, "reach", "links"), 4, "quantile")


@query("""
WITH t AS (SELECT p_partkey, p_brand || p_name AS a, right(p_brand || p_name, CAST(1 + p_partkey % 6 AS INT)) || p_type AS b FROM part)
SELECT p_partkey, CASE WHEN right(a, 5) = left(b, 5) THEN 5 WHEN right(a, 4) = left(b, 4) THEN 4 WHEN right(a, 3) = left(b, 3) THEN 3 WHEN right(a, 2) = left(b, 2) THEN 2 ELSE 0 END AS overlap FROM t""")
def q_end_overlaps(s, d):
    t = table(s, d, "part").selectExpr("p_partkey", "concat(p_brand, p_name) AS a", "concat(right(concat(p_brand, p_name), cast(1 + p_partkey % 6 AS int)), p_type) AS b")
    return t.select("p_partkey", seq.overlap_length(F.col("a"), F.col("b"), 2, 5).alias("overlap"))


@query("""SELECT 'x' || l_linenumber || ' "a' || l_orderkey || '" then' AS line, 'a' || l_orderkey AS field FROM lineitem""")
def q_quoted_fields(s, d):
    t = table(s, d, "lineitem").select(F.expr("concat('x', l_linenumber, ' \"a', l_orderkey, '\" then')").alias("line"))
    return t.select("line", numeric.quoted_field(F.col("line")).alias("field"))


# ---- hits, pairs, routes


_HITS = "WITH h AS (SELECT l_orderkey, l_linenumber, l_partkey % 5 AS query, l_suppkey % 5 AS subject, l_linenumber AS qstart, l_linenumber + 3 AS qend, l_linenumber + 3 * (l_orderkey % 2) AS sstart, l_linenumber + 3 - 3 * (l_orderkey % 2) AS send FROM lineitem)"


def _hits(s, d):
    return table(s, d, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_partkey % 5 AS query", "l_suppkey % 5 AS subject", "l_linenumber AS qstart", "l_linenumber + 3 AS qend", "l_linenumber + 3 * (l_orderkey % 2) AS sstart", "l_linenumber + 3 - 3 * (l_orderkey % 2) AS send")


@query(_HITS + " SELECT l_orderkey, l_linenumber FROM h WHERE query = subject")
def q_self_hits(s, d):
    return hits.self_hits(_hits(s, d)).select("l_orderkey", "l_linenumber")


@query(_HITS + " SELECT l_orderkey, l_linenumber FROM h WHERE query = subject AND qstart = send AND qend = sstart")
def q_palindromic_hits(s, d):
    return hits.palindromic_hits(_hits(s, d)).select("l_orderkey", "l_linenumber")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity - 5 >= 0.6 * (l_quantity + l_linenumber - 1) AND l_quantity + l_linenumber - 1 >= 12")
def q_accepted_alignments(s, d):
    h = table(s, d, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_quantity - 5 AS match", "100 AS qlen", "1 AS qfrom", "l_quantity + l_linenumber AS qto")
    return score.accepted(h, 0.6, 12, local=True).select("l_orderkey", "l_linenumber")


@query("SELECT DISTINCT least(l_partkey % 200, l_suppkey) AS a, greatest(l_partkey % 200, l_suppkey) AS b FROM lineitem")
def q_distinct_pairs(s, d):
    return hits.distinct_pairs(table(s, d, "lineitem").selectExpr("l_partkey % 200 AS a", "l_suppkey AS b"), "a", "b")


@query("""
WITH i AS (SELECT l_suppkey, CAST(l_partkey AS BIGINT) AS a, CAST(l_partkey + l_linenumber AS BIGINT) AS b FROM lineitem),
r AS (SELECT *, max(b) OVER (PARTITION BY l_suppkey ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM i),
g AS (SELECT *, sum(CASE WHEN reach IS NULL OR a > reach + 2 THEN 1 ELSE 0 END) OVER (PARTITION BY l_suppkey ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS g FROM r)
SELECT l_suppkey, min(a) AS a, max(b) AS b, count(*) AS n FROM g GROUP BY l_suppkey, g""")
def q_merged_regions(s, d):
    i = table(s, d, "lineitem").selectExpr("l_suppkey", "cast(l_partkey AS bigint) AS a", "cast(l_partkey + l_linenumber AS bigint) AS b")
    return islands.fuzzy_merge(i, ["l_suppkey"], "a", "b", 2)


@query("SELECT o_custkey, max(o_orderkey) AS o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY 1")
def q_shared_last(s, d):
    c = table(s, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return pairing.last_wins_semi(table(s, d, "orders").select("o_orderkey", "o_custkey"), c, "o_custkey").select("o_custkey", "o_orderkey")


@query("SELECT reverse(translate(upper(p_name), 'ACGT', 'TGCA')) AS s FROM part UNION ALL SELECT reverse(translate(upper(c_name), 'ACGT', 'TGCA')) FROM customer")
def q_union_of_libraries(s, d):
    one, two = table(s, d, "part").select(F.upper("p_name").alias("s")), table(s, d, "customer").select(F.upper("c_name").alias("s"))
    turn = lambda t: t.select(F.reverse(F.translate("s", "ACGT", "TGCA")).alias("s"))
    return pairing.union_all([one, two], turn)


@query("SELECT event_id // 2 AS event_id, user_id AS a FROM events WHERE event_id % 2 = 1")
def q_second_of_pairs(s, d):
    return pairing.deinterleave(table(s, d, "events").select("event_id", F.col("user_id").alias("a")), "event_id")[1]


@query("SELECT event_id, CASE WHEN value >= 50 THEN 'a' ELSE 'b' END AS part FROM events")
def q_routed(s, d):
    return coverage.split_by(table(s, d, "events"), F.col("value") >= 50).select("event_id", "part")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity + l_suppkey % 30 < 40")
def q_without_contaminant(s, d):
    m = table(s, d, "lineitem").selectExpr("l_orderkey", "l_linenumber", "concat(cast(l_quantity AS int), 'M1D', l_suppkey % 30, 'M') AS cigar")
    return demux.contaminant(m, 40).select("l_orderkey", "l_linenumber")


@query("""
WITH b AS (SELECT * FROM (VALUES (0, 'a', '10'), (1, 'b', '23'), (2, 'c', '44')) v(ord, ident, barcode)), p AS (SELECT p_partkey, right(p_brand, 2) || 'xx' || p_name AS s1, left(CAST(p_size + 10 AS VARCHAR), 2) || 'yy' || p_type AS s2 FROM part),
x AS (SELECT p_partkey, ident, ord, hamming(left(s1, 2), barcode) AS d1, hamming(left(s2, 2), barcode) AS d2 FROM p, b),
m AS (SELECT p_partkey, min(struct_pack(d := d1, o := ord, i := ident)) AS a, min(struct_pack(d := d2, o := ord, i := ident)) AS c FROM x GROUP BY 1),
n AS (SELECT p_partkey, CASE WHEN a.d <= 1 THEN a.i END AS ident1, CASE WHEN c.d <= 1 THEN c.i END AS ident2 FROM m)
SELECT p_partkey, ident1, ident2, CASE WHEN ident1 IS NULL AND ident2 IS NULL THEN 'unmatched' WHEN ident1 = ident2 THEN 'paired' WHEN ident1 IS NULL OR ident2 IS NULL THEN 'unpaired' ELSE 'mispaired' END AS state,
  CASE WHEN ident1 IS NULL THEN s1 ELSE substr(s1, 5) END AS s1, CASE WHEN ident2 IS NULL THEN s2 ELSE substr(s2, 5) END AS s2 FROM n JOIN p USING (p_partkey)""")
def q_barcoded_pairs(s, d):
    b = s.createDataFrame([(0, "a", "10"), (1, "b", "23"), (2, "c", "44")], "ord int, ident string, barcode string")
    p = table(s, d, "part").selectExpr("p_partkey", "concat(right(p_brand, 2), 'xx', p_name) AS s1", "concat(left(cast(p_size + 10 AS string), 2), 'yy', p_type) AS s2")
    return demux.demux_pairs(p, b, "p_partkey", "s1", "s2")


@query("SELECT lang, n_chars AS length, count(*) AS n FROM documents WHERE n_chars >= 100 GROUP BY ALL")
def q_length_histogram(s, d):
    return lengths.length_histogram(lengths.longer_than(table(s, d, "documents"), "n_chars", 100), "n_chars", ["lang"])


@query("SELECT p_partkey, CAST(dense_rank() OVER (PARTITION BY p_brand ORDER BY p_size) AS INT) AS rank FROM part")
def q_dense_ranks(s, d):
    return score.dense_ranks(table(s, d, "part"), ["p_brand"], "p_size", "rank").select("p_partkey", "rank")


@query("""
WITH m AS (SELECT l_returnflag AS x, l_linestatus AS y, count(*) AS n FROM lineitem GROUP BY ALL), t AS (SELECT x, sum(n) AS t, count(*) AS k FROM m WHERE x <> y GROUP BY 1)
SELECT x, y, round(n / t * k, 9) AS ratio FROM m JOIN t USING (x) WHERE x <> y""")
def q_call_bias(s, d):
    m = table(s, d, "lineitem").groupBy(F.col("l_returnflag").alias("x"), F.col("l_linestatus").alias("y")).agg(F.count(F.lit(1)).alias("n"))
    return rounded(score.call_bias(m), 9, "ratio")


@query("SELECT concat_ws(chr(9), p_partkey, p_name, coalesce(CAST(nullif(p_size, 1) AS VARCHAR), 'NA')) AS value FROM part")
def q_stats_lines(s, d):
    return sinks.stats_line(table(s, d, "part").selectExpr("p_partkey", "p_name", "nullif(p_size, 1) AS p_size"), ["p_partkey", "p_name", "p_size"])


@query("""SELECT l_suppkey, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY p) AS INT) AS rank, l_suppkey || '_' || p || chr(9) || '1' AS value FROM (SELECT DISTINCT l_suppkey, l_partkey AS p FROM lineitem)""")
def q_synteny_map_lines(s, d):
    return sinks.synteny_maps(table(s, d, "lineitem"), "l_suppkey", "l_partkey")


# ---- links


_PAIRS = """
WITH p AS (SELECT 'c' || o_custkey % 5 AS ctg1, 'c' || (o_custkey + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END) % 5 AS ctg2, CAST(o_orderkey % 900 + 1 AS INT) AS pos1, CAST(o_orderkey % 900 + 201 + o_custkey % 100 AS INT) AS pos2, o_orderkey % 4 = 0 AS rev1, o_orderkey % 5 < 3 AS rev2 FROM orders)"""


def _pairs(s, d):
    return table(s, d, "orders").selectExpr("concat('c', o_custkey % 5) AS ctg1", "concat('c', (o_custkey + if(o_orderkey % 3 = 0, 1, 0)) % 5) AS ctg2", "cast(o_orderkey % 900 + 1 AS int) AS pos1", "cast(o_orderkey % 900 + 201 + o_custkey % 100 AS int) AS pos2", "o_orderkey % 4 = 0 AS rev1", "o_orderkey % 5 < 3 AS rev2", "36 AS len1", "36 AS len2", "5000 AS clen1", "5000 AS clen2")


_LINKS = _PAIRS + """, u AS (SELECT DISTINCT * FROM p WHERE ctg1 <> ctg2), g AS (SELECT *, 3000 - CASE WHEN rev1 THEN pos1 + 35 ELSE 5001 - pos1 END - CASE WHEN rev2 THEN pos2 + 35 ELSE 5001 - pos2 END AS gap FROM u),
e AS (SELECT ctg1 AS src, CASE WHEN rev1 THEN 'r' ELSE 'f' END AS src_strand, ctg2 AS dst, CASE WHEN rev2 THEN 'f' ELSE 'r' END AS dst_strand, gap FROM g
  UNION ALL SELECT ctg2, CASE WHEN rev2 THEN 'r' ELSE 'f' END, ctg1, CASE WHEN rev1 THEN 'f' ELSE 'r' END, gap FROM g),
l AS (SELECT src, src_strand, dst, dst_strand, count(*) AS links, CAST(sum(gap) AS DOUBLE) AS gaps FROM e GROUP BY ALL)"""


@query(_LINKS + " SELECT * FROM l")
def q_contig_links(s, d):
    return links.contig_links(_pairs(s, d), 3000.0)


@query(_LINKS + """, st AS (SELECT * FROM l WHERE links >= 5), f AS (SELECT src, src_strand FROM st GROUP BY ALL HAVING count(DISTINCT dst) > 1),
w AS (SELECT src, src_strand, dst FROM st JOIN f USING (src, src_strand))
SELECT DISTINCT x.src AS contig, x.src_strand AS strand FROM w x JOIN w y USING (src, src_strand) WHERE x.dst < y.dst AND NOT EXISTS (SELECT 1 FROM st z WHERE z.src = x.dst AND z.dst = y.dst)""")
def q_repeat_contigs(s, d):
    return links.repeat_contigs(links.contig_links(_pairs(s, d), 3000.0), 5)


@query(_PAIRS + """, c AS (SELECT count(*) FILTER (NOT rev1 AND rev2) AS inward, count(*) FILTER (rev1 AND NOT rev2) AS outward, count(*) FILTER (rev1 = rev2) AS same FROM p)
SELECT *, CASE WHEN inward > outward THEN 0 ELSE 1 END AS orientation, least(inward, outward) * 10 > inward + outward AS mixed FROM c""")
def q_orientation_vote(s, d):
    return links.orientation_vote(_pairs(s, d))


@query(_PAIRS + """, i AS (SELECT *, pos2 - pos1 + 36 AS n FROM p)
SELECT count(*) FILTER (ctg1 = ctg2 AND NOT rev1 AND rev2 AND abs(n - 300) <= 60) AS satisfied, count(*) FILTER (ctg1 = ctg2 AND NOT rev1 AND rev2 AND abs(n - 300) > 60) AS wrong_distance,
  count(*) FILTER (ctg1 = ctg2 AND NOT (NOT rev1 AND rev2)) AS wrong_orientation, count(*) FILTER (ctg1 <> ctg2) AS between FROM i""")
def q_pair_states(s, d):
    return links.pair_states(_pairs(s, d), 300.0, 0.2)


@query(_PAIRS + """, i AS (SELECT pos2 - pos1 + 36 AS n FROM p WHERE ctg1 = ctg2), r AS (SELECT n, row_number() OVER (ORDER BY n) - 1 AS k, count(*) OVER () AS t FROM i),
m AS (SELECT count(*) AS n, avg(n) AS mean, stddev_samp(n) AS sd FROM r WHERE k >= floor(t * 0.1) AND k < floor(t * 0.1) + floor(t * 0.8))
SELECT n, round(mean, 6) AS mean, round(sd, 6) AS sd, round(least(6 * sd / mean, 0.95), 6) AS err, n >= 2500 AS enough FROM m""")
def q_library_estimate(s, d):
    return rounded(links.library_estimate(_pairs(s, d), 10_000), 6, "mean", "sd", "err")


@query(_PAIRS + " SELECT ctg1, pos1, count(*) AS n, CASE WHEN pos1 <= 100 THEN -1 WHEN pos1 + 35 > 900 - 100 THEN 1 ELSE 0 END AS terminal FROM p GROUP BY ctg1, pos1")
def q_terminal_reads(s, d):
    contigs = table(s, d, "customer").selectExpr("concat('c', c_custkey % 5) AS name", "900 AS len").distinct()
    return links.terminal(_pairs(s, d), contigs, "ctg1", "pos1", 100, 36).groupBy("ctg1", "pos1", "terminal").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT doc_id FROM documents WHERE len(regexp_extract_all(text, '[^Nn]+')) = 1""")
def q_single_pieces(s, d):
    return scaffold.single_pieces(scaffold.split_at_n(table(s, d, "documents").select("doc_id", "text"), "doc_id", "text"), "doc_id")[0].select("doc_id")


# ---- searches, samples, joined sequences


_NEXT = "WITH RECURSIVE e AS (SELECT DISTINCT o_custkey % 200 AS src, (o_custkey % 200 + 1 + o_orderkey % 3 * 7) AS dst FROM orders WHERE o_orderkey % 5 < 2 AND o_custkey % 3 > 0)"


def _next(s, d):
    return table(s, d, "orders").where("o_orderkey % 5 < 2 AND o_custkey % 3 > 0").selectExpr("o_custkey % 200 AS src", "o_custkey % 200 + 1 + o_orderkey % 3 * 7 AS dst").distinct()


@query(_NEXT + """, p AS (SELECT DISTINCT c_custkey % 200 AS start, c_custkey % 200 + c_custkey % 31 AS goal FROM customer),
w AS (SELECT DISTINCT start, start AS v, 0 AS steps FROM p UNION SELECT start, dst, steps + 1 FROM w JOIN e ON src = v WHERE steps < 16)
SELECT start, goal, CAST(min(steps) AS INT) AS steps FROM p JOIN w USING (start) WHERE v = goal GROUP BY ALL""")
def q_shortest_paths(s, d):
    pairs = table(s, d, "customer").selectExpr("c_custkey % 200 AS start", "c_custkey % 200 + c_custkey % 31 AS goal")
    return graph.shortest_paths(_next(s, d), pairs, 16).select("start", "goal", (F.size("path") - 1).alias("steps"))


@query(_NEXT + """, v AS (SELECT DISTINCT x AS v, x % 9 + 31 AS len FROM (SELECT src AS x FROM e UNION SELECT dst FROM e)),
w AS (SELECT v, v AS at, 0 AS n FROM v UNION SELECT w.v, dst, CAST(least(200, n + len - 21) AS INT) FROM w JOIN e ON src = w.at JOIN v u ON u.v = dst)
SELECT v, CAST(max(n) AS BIGINT) AS reach FROM w GROUP BY v""")
def q_reach(s, d):
    e = _next(s, d)
    v = e.selectExpr("explode(array(src, dst)) AS v").distinct().selectExpr("v", "v % 9 + 31 AS len")
    return graph.reach(e, v, 21, 200)


@query(_NEXT + """, w AS (SELECT src AS v, dst AS branch, dst AS node, -21 AS d FROM e UNION SELECT v, branch, dst, CAST(d + node % 9 + 10 AS INT) FROM w JOIN e ON src = node WHERE d + node % 9 + 10 <= 60),
m AS (SELECT v, node, count(DISTINCT branch) AS met FROM w GROUP BY ALL), b AS (SELECT src AS v, count(*) AS n FROM e GROUP BY 1)
SELECT DISTINCT v FROM m JOIN b USING (v) WHERE met = n""")
def q_converging(s, d):
    e = _next(s, d)
    v = e.selectExpr("explode(array(src, dst)) AS v").distinct().selectExpr("v", "v % 9 + 31 AS len")
    return graph.converging(e, v, 21, 60)


@query(_READS + """, x AS (SELECT left(seq, 5) AS a, right(seq, 5) AS b FROM r), y AS (SELECT a, b, reverse(translate(b, 'ACGT', 'TGCA')) AS c, reverse(translate(a, 'ACGT', 'TGCA')) AS e FROM x)
SELECT CASE WHEN (a, b) <= (c, e) THEN a ELSE c END AS a, CASE WHEN (a, b) <= (c, e) THEN b ELSE e END AS b, count(*) AS n FROM y GROUP BY ALL""")
def q_distinct_sequence_pairs(s, d):
    return hits.distinct_sequence_pairs(_reads(s, d).selectExpr("left(seq, 5) AS a", "right(seq, 5) AS b"), "a", "b")


@query("SELECT doc_id FROM documents WHERE doc_id < 100 OR doc_id > (SELECT max(doc_id) FROM documents) - 100")
def q_first_and_last(s, d):
    return links.first_and_last(table(s, d, "documents").select("doc_id"), "doc_id", 100)


@query("SELECT p_brand, md5(string_agg(p_name, '|' ORDER BY length(p_name) DESC, p_partkey)) AS joined FROM part GROUP BY 1")
def q_joined_longest_first(s, d):
    return lengths.joined_longest_first(table(s, d, "part"), ["p_brand"], "p_name", "p_partkey", "|").select("p_brand", F.md5("p_name").alias("joined"))


@query("SELECT l_orderkey AS o, count(*) AS n FROM lineitem GROUP BY 1")
def q_pick_by_weight(s, d):
    # what was drawn depends on hashes; that each group has one row of its own doesn't
    rows = table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    one = simulate.pick_by_weight(rows, ["l_orderkey"], "l_linenumber", "l_quantity")
    return one.join(rows, ["l_orderkey"]).groupBy(F.col("l_orderkey").alias("o")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT translate(lpad(CAST(p_partkey * 7919 AS VARCHAR), 9, '0'), '0123456789', 'ACGTACGTAC') AS seq, translate(lpad(CAST(p_partkey * 7919 AS VARCHAR), 9, '0'), '0123456789', '+++++IIIII') AS qual FROM part")
def q_prb_round_trip(s, d):
    p = table(s, d, "part").selectExpr("split(lpad(cast(p_partkey * 7919 AS string), 9, '0'), '') AS digits")
    score = "transform(sequence(0, 3), j -> if(j = cast(x AS int) % 8 % 4, if(cast(x AS int) < 5, 10, 40), -cast(x AS int) - 5))"
    lines = p.selectExpr(f"concat_ws('\t', transform(filter(digits, x -> x != ''), x -> concat_ws(' ', transform({score}, y -> lpad(cast(y AS string), 4, ' '))))) AS value")
    return text.read_prb(s, written(s, lines)).select("seq", "qual")


@query("""WITH e AS (SELECT DISTINCT p_size AS a, p_size + 50 AS b FROM part)
SELECT 'graph [' AS value UNION ALL SELECT '  directed 1' UNION ALL SELECT ']' UNION ALL SELECT '  node [ id ' || v || ' ]' FROM (SELECT a AS v FROM e UNION SELECT b FROM e) UNION ALL SELECT '  edge [ source ' || a || ' target ' || b || ' label "' || a || '" ]' FROM e""")
def q_gml_lines(s, d):
    return graph.gml(table(s, d, "part").selectExpr("p_size AS a", "p_size + 50 AS b").distinct(), "a", "b", "a")


@query("SELECT l_suppkey AS contig1, l_linenumber AS contig2, l_suppkey || '_' || l_partkey || chr(9) || l_linenumber || '_' || l_orderkey || chr(9) || CAST(max(CAST(l_quantity AS INT)) AS VARCHAR) AS value FROM lineitem GROUP BY l_suppkey, l_partkey, l_linenumber, l_orderkey")
def q_synteny_match_lines(s, d):
    return sinks.synteny_matches(table(s, d, "lineitem").withColumn("q", F.col("l_quantity").cast("int")), "l_suppkey", "l_partkey", "l_linenumber", "l_orderkey", "q")
