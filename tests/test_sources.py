import gzip

import pytest
from pyspark.sql import functions as F

from contigo.sources import sinks, text


@pytest.fixture
def put(tmp_path):
    def f(name, content):
        p = tmp_path / name
        (gzip.open(p, "wt") if name.endswith(".gz") else open(p, "w")).write(content)
        return str(p)

    return f


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_fastq(spark, put):
    body = "@r1/1 x\nACGT\n+\nIIII\n@r1/2\nNNGT\n+r1\nIII!\n@r2 1:N:0:ACG\nA\n+\n#\n@cut\nAC\n"
    for name in ("a.fq", "a.fq.gz"):
        got = rows(text.read_fastq(spark, put(name, body)).orderBy("ord"), "ord", "name", "mate", "seq", "qual")
        assert got == [(0, "r1", 1, "ACGT", "IIII"), (1, "r1", 2, "NNGT", "III!"), (2, "r2", 1, "A", "#")]
    wrapped = put("w.fq", "@a\nACG\nTTT\n+\nIII\n@II\n@b\nA\n+\nI\n")
    assert rows(text.read_wrapped_fastq(spark, wrapped), "ord", "header", "seq", "qual") == [(0, "a", "ACGTTT", "III@II"), (1, "b", "A", "I")]


def test_fasta(spark, put):
    p = put("a.fa", ">s1|size5 some text\nACG\nTNn\n\n>s2\n>s3\nA>C\n")
    assert rows(text.read_fasta(spark, p).orderBy("name"), "name", "descr", "seq", "len") == [("s1|size5", "some text", "ACGTNn", 6), ("s2", "", "", 0), ("s3", "", "A>C", 3)]
    assert spark.range(1).select(text.sniff(F.lit(">x")), text.sniff(F.lit("@HD\tVN:1")), text.sniff(F.lit("@r"))).first()[:] == ("fasta", "sam", "fastq")


def test_sam_blast_psl(spark, put):
    sam = put("a.sam", "@SQ\tSN:c1\tLN:100\nr1\t16\tc1\t5\t60\t4M1I3M\t=\t50\t49\tACGTACGT\t*\tXT:A:U\tNM:i:0\nbad\tline\n@r2\t0\t*\t0\t0\t*\t*\t0\t0\tA\tI\n")
    contigs, body = text.read_sam(spark, sam)
    assert rows(contigs, "name", "len") == [("c1", 100)]
    assert rows(body, "qname", "flag", "pos", "cigar", "tags") == [("r1", 16, 5, "4M1I3M", ["XT:A:U", "NM:i:0"]), ("@r2", 0, 0, "*", [])]
    blast = put("a.m8", "# c\nq s 99.5 10 0 0 1 10 5 14 1e-5 50\nq\tt\t80\t9\t1\t0\t1\t9\t9\t1\t0.1\t20.5\n")
    assert rows(text.read_blast(spark, blast).orderBy("ord"), "subject", "evalue", "bitscore") == [("s", 1e-5, 50.0), ("t", 0.1, 20.5)]
    psl = put("a.psl", "psLayout version 3\n\n" + "\t".join(["90", "2", "0", "0", "0", "0", "0", "0", "+", "q", "100", "0", "92", "t", "500", "10", "102", "2", "40,50,", "0,42,", "10,52,"]) + "\n")
    r = text.read_psl(spark, psl).first()
    assert (r.match, r.qname, r.rto, [tuple(b) for b in r.blocks]) == (90, "q", 102, [(40, 0, 10), (50, 42, 52)])


def test_small_formats(spark, put):
    libs = text.read_libraries(spark, put("l.libs", "[LIB]\np1=a.fq\nins=300\n[LIB]\nid=x\nup=b.fq\nvalid=1\n"))
    assert rows(libs.orderBy("lib"), "id", "attrs") == [("raw1", {"p1": "a.fq", "ins": "300"}), ("x", {"id": "x", "up": "b.fq", "valid": "1"})]
    lib = text.read_scaffolder_libraries(spark, put("s.txt", "l1 a b 300 0.2 FR\nl2 a b 300 2 FR\nl3 a\n"))
    assert rows(lib.orderBy("name"), "name", "problem") == [("l1", None), ("l2", "error must be between 0 and 1"), ("l3", "not six fields")]
    with pytest.raises(ValueError):
        text.read_barcodes(spark, put("b.txt", "# x\na ACG\nb AC\n"))
    maf = text.read_maf(spark, put("a.maf", "##maf\na score=1\ns hs.c1 0 3 + 9 AC-G\ns mm.c2 1 2 - 9 A--G\n\na\ns mm.c2 5 1 + 9 T\n"))
    assert dict(rows(sinks.maf_to_mfa(maf), "species", "seq")) == {"hs": "AC-G", "mm": "A--GT"}
    x = text.read_xmfa(spark, put("a.xmfa", "#c\n> 1:5-9 + f\nAC\nGT-\n> 2:1-4 - g\nACG-T\n=\n> 1:20-21 + f\nAA\n=\n"))
    assert sorted(rows(x, "seq_no", "left", "strand", "aln")) == [(1, 5, "+", "ACGT-"), (1, 20, "+", "AA"), (2, 1, "-", "ACG-T")]
    g = text.read_genbank(spark, put("a.gb", 'LOCUS       R1 10 bp\nFEATURES             Location/Qualifiers\n     CDS             complement(3..8)\n                     /gene="ab\n                     c"\n                     /pseudo\nORIGIN\n//\n'))
    assert rows(g, "record", "kind", "start", "end", "strand", "qualifiers") == [("R1", "CDS", 3, 8, -1, {"gene": "ab c", "pseudo": ""})]
    c = text.read_synteny_control(spark, put("c.txt", "-maps\n1 a.map\n2 b.map\nend\n-matches\n1 2 x\nend\n"))
    assert sorted(rows(c, "section", "contig1", "contig2", "path")) == [("maps", 1, None, "a.map"), ("maps", 2, None, "b.map"), ("matches", 1, 2, "x")]
    q = text.read_qseq(spark, put("q.txt", "\t".join(["M", "1", "2", "3", "4", "5", "0", "1", "AC.T", "hhhB", "1"]) + "\n"))
    assert rows(q, "mate", "seq", "qual", "passed") == [(1, "ACNT", "III#", True)]


def test_lines_over_tasks(spark, put):
    p = put("big.txt", "".join(f"{i}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = text.numbered_lines(spark, p)
        assert spark.read.text(p).rdd.getNumPartitions() > 2
        assert df.where("ord != cast(value AS int)").count() == 0 and df.count() == 5000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", "ACGTACGTAC", "x"), ("b", "NN", "y")], "name string, seq string, k string")
    assert rows(sinks.to_fasta(df, sinks.with_length(F.col("name"), F.col("seq")), "seq", 4), "value")[0] == (">a|size10\nACGT\nACGT\nAC",)
    assert rows(sinks.to_fastq(df, F.col("name"), "seq"), "value")[1] == ("@b\nNN\n+\nII",)
    assert rows(sinks.fastq_to_fasta(df, no_n=True), "value") == [(">a\nACGTACGTAC",)]
    sinks.write_lines(sinks.to_fasta(df, F.col("name"), "seq", keep=["k"]), str(tmp_path / "out"), by=["k"])
    assert spark.read.text(str(tmp_path / "out/k=y")).count() == 2


def test_prb_and_synteny_files(spark, put):
    p = text.read_prb(spark, put("a.prb", "  40  -40  -40  -40\t -5 -5 -5 -5\t -40 20 20 -40\n\n -40 -40 -40 10\n")).orderBy("ord")
    assert rows(p, "seq", "qual") == [("ANC", "I\"5"), ("T", "+")]
    control = "".join(f"{r.value}\n" for r in sinks.synteny_control(spark, [(1, "m1"), (2, "m2")], [(1, 2, "x")]).collect())
    assert rows(text.read_synteny_control(spark, put("c.txt", control)), "section", "contig1", "contig2", "path") == [("maps", 1, None, "m1"), ("maps", 2, None, "m2"), ("matches", 1, 2, "x")]
