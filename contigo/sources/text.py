"""Line formats as tables. Readers give every record an ordinal, since rows have no order of their own.

Line-based files of one file each are numbered with the file's name and the row index that
the Parquet-free text source gives after a single ordered pass: ``numbered_lines`` numbers lines
within ranges of the file, whose sizes are summed first, so a file may span many tasks.
Compressed files (gzip, bzip2) are read by Hadoop's codecs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, ord (0-based line number in the file), value.

    A file's splits are numbered by task, lines within a task by position; the lines before each task are
    a sum over tasks (one row each).
    """
    lines = spark.read.text(path).select(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("id"), "value")
    lines = lines.withColumn("task", F.shiftright("id", 33)).withColumn("k", F.col("id").bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = lines.groupBy("file", "task").agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("first"))
    # tasks follow the files' splits by size, so a file's splits are put in order by where they start
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("task", "first").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("file", "task", "first", before.alias("before"))
    return lines.join(sizes, ["file", "task"]).select("file", (F.col("before") + F.col("k") - F.col("first")).alias("ord"), "value")


def sniff(first_line: Column) -> Column:
    """fasta, fastq, sam or unknown, by how a file begins."""
    return F.when(first_line.startswith(">"), "fasta").when(first_line.rlike("^@(HD|SQ|RG|PG|CO)\t"), "sam").when(first_line.startswith("@"), "fastq").otherwise("unknown")


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """file, ord, header, name, mate, seq, qual of four-line records; a record cut off at the end is left out."""
    from ..functions.sequence import read_mate, read_name

    lines = numbered_lines(spark, path)
    rec = lines.groupBy("file", F.expr("ord div 4").alias("ord")).agg(*[F.max(F.when(F.col("ord") % 4 == k, F.col("value"))).alias(c) for k, c in enumerate(("header", "seq", "plus", "qual"))])
    rec = rec.where("qual IS NOT NULL AND header LIKE '@%'")
    return rec.select("file", "ord", F.expr("substring(header, 2)").alias("header"), read_name(F.col("header")).alias("name"), read_mate(F.expr("substring(header, 2)")).alias("mate"), "seq", "qual")


def read_wrapped_fastq(spark: SparkSession, path: str) -> DataFrame:
    """As read_fastq for records whose sequence and quality run over several lines: a record ends where its quality is as long as its sequence. Whole files, one task each."""
    import pandas as pd

    def parse(batches):
        for pdf in batches:
            rows = []
            for file, text in zip(pdf["file"], pdf["value"]):
                lines, i, k = text.split("\n"), 0, 0
                while i < len(lines):
                    if not lines[i].startswith("@"):
                        i += 1
                        continue
                    header, seq, qual, i = lines[i][1:], "", "", i + 1
                    while i < len(lines) and not lines[i].startswith("+"):
                        seq += lines[i].strip()
                        i += 1
                    i += 1
                    while i < len(lines) and len(qual) < len(seq):
                        qual += lines[i].strip()
                        i += 1
                    if len(qual) == len(seq):
                        rows.append((file, k, header, seq, qual))
                        k += 1
            yield pd.DataFrame(rows, columns=["file", "ord", "header", "seq", "qual"])

    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    return whole.mapInPandas(parse, "file string, ord long, header string, seq string, qual string")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """name, descr, seq, len: records split at '>' at the start of a line, lines joined; case stays."""
    rec = spark.read.text(path, lineSep="\n>").select(F.regexp_replace("value", r"^>", "").alias("v")).where(F.trim("v") != "")
    head = F.regexp_replace(F.substring_index("v", "\n", 1), r"\r$", "")
    body = F.when(F.instr("v", "\n") > 0, F.regexp_replace(F.expr("substring(v, instr(v, '\\n') + 1)"), r"\s", "")).otherwise("")
    rec = rec.select(head.alias("head"), body.alias("seq"))
    return rec.select(F.regexp_extract("head", r"^(\S*)", 1).alias("name"), F.trim(F.regexp_extract("head", r"^\S*\s*(.*)$", 1)).alias("descr"), "seq", F.char_length("seq").alias("len"))


def read_sam(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(contigs: name, len) of the header's @SQ lines, and (rows) with the eleven columns and the tags."""
    lines = spark.read.text(path)
    sq = lines.where("value LIKE '@SQ\\t%'").select(F.regexp_extract("value", r"\tSN:([^\t]+)", 1).alias("name"), F.regexp_extract("value", r"\tLN:(\d+)", 1).cast("int").alias("len"))
    f = F.split("value", "\t")
    names = [("qname", "string"), ("flag", "int"), ("rname", "string"), ("pos", "int"), ("mapq", "int"), ("cigar", "string"), ("rnext", "string"), ("pnext", "int"), ("tlen", "int"), ("seq", "string"), ("qual", "string")]
    body = lines.where(~F.col("value").rlike(r"^@[A-Z]{2}\t") & (F.size(f) >= 11))
    return sq, body.select(*[F.get(f, F.lit(k)).try_cast(t).alias(n) for k, (n, t) in enumerate(names)], F.slice(f, F.lit(12), F.greatest(F.size(f) - 11, F.lit(0))).alias("tags"))


BLAST = "query string, subject string, pid double, length int, mismatches int, gap_openings int, qstart int, qend int, sstart int, send int, evalue double, bitscore double"


def read_blast(spark: SparkSession, path: str) -> DataFrame:
    """The twelve columns, parted by tabs or other white space, and ord; comment lines are skipped."""
    lines = numbered_lines(spark, path).where("value NOT LIKE '#%' AND trim(value) != ''")
    f = F.split(F.trim("value"), r"\s+")
    return lines.select("ord", *[F.get(f, F.lit(k)).try_cast(c.split()[1]).alias(c.split()[0]) for k, c in enumerate(BLAST.split(", "))])


def read_psl(spark: SparkSession, path: str) -> DataFrame:
    """match, mismatch, strand, query and reference with lengths and ends (0-based, half-open), blocks; header lines are skipped."""
    f = F.split("value", "\t")
    rows = spark.read.text(path).where(F.col("value").rlike(r"^\d+\t") & (F.size(f) >= 21))
    ints = lambda k: F.transform(F.filter(F.split(F.get(f, F.lit(k)), ","), lambda x: x != ""), lambda x: x.cast("int"))
    col = lambda k, t: F.get(f, F.lit(k)).try_cast(t)
    blocks = F.transform(F.arrays_zip(ints(18).alias("s"), ints(19).alias("q"), ints(20).alias("r")), lambda b: F.struct(b["s"].alias("size"), b["q"].alias("qfrom"), b["r"].alias("rfrom")))
    return rows.select(col(0, "int").alias("match"), col(1, "int").alias("mismatch"), col(8, "string").alias("strand"), col(9, "string").alias("qname"), col(10, "int").alias("qlen"), col(11, "int").alias("qfrom"), col(12, "int").alias("qto"), col(13, "string").alias("rname"), col(14, "int").alias("rlen"), col(15, "int").alias("rfrom"), col(16, "int").alias("rto"), blocks.alias("blocks"))


def read_coords(spark: SparkSession, path: str) -> DataFrame:
    """rstart, rend, qstart, qend, rspan, qspan, identity, ref, query of a MUMmer coordinate table."""
    m = r"^\s*(\d+)\s+(\d+)\s+\|\s+(\d+)\s+(\d+)\s+\|\s+(\d+)\s+(\d+)\s+\|\s+([\d.]+)\s+\|\s+(?:.*\|\s+)?(\S+)\s+(\S+)\s*$"
    names = ["rstart int", "rend int", "qstart int", "qend int", "rspan int", "qspan int", "identity double", "ref string", "query string"]
    rows = spark.read.text(path).where(F.col("value").rlike(m))
    return rows.select(*[F.regexp_extract("value", m, k + 1).cast(n.split()[1]).alias(n.split()[0]) for k, n in enumerate(names)])


def read_delimited(spark: SparkSession, path: str, schema: str, sep: str = "\t", comment: str | None = None, header: bool = False) -> DataFrame:
    """Tables of a fixed schema: pileups, k-mer counts, bowtie and SHRiMP maps, score tables."""
    options = {"sep": sep, "header": header} | ({"comment": comment} if comment else {})
    return spark.read.csv(path, schema=schema, **options)


PILEUP = "ctg string, pos int, base string, depth int, bases string, quals string"
BOWTIE = "read string, strand string, contig string, start int, seq string"
KMER_COUNTS = "kmer string, cnt bigint"
SHRIMP = "read string, contig string, strand string, start int, end int, rstart int, rend int, rlen int, score int, edit string"


def read_libraries(spark: SparkSession, path: str) -> DataFrame:
    """lib (0-based), id, attrs map of '[LIB]' blocks of key=value lines; a library without an id is raw<number>."""
    lines = numbered_lines(spark, path).where("trim(value) != '' AND value NOT LIKE '#%'")
    w = Window.partitionBy("file").orderBy("ord")  # a library file is a few lines
    lines = lines.withColumn("lib", F.sum((F.upper(F.trim("value")) == "[LIB]").cast("int")).over(w) - 1)
    kv = lines.where("lib >= 0 AND value LIKE '%=%'").select("file", "lib", "ord", F.trim(F.substring_index("value", "=", 1)).alias("k"), F.trim(F.regexp_extract("value", r"^[^=]*=(.*)$", 1)).alias("v"))
    last = kv.groupBy("file", "lib", "k").agg(F.max_by("v", "ord").alias("v"))
    libs = lines.where("lib >= 0").select("file", "lib").distinct().join(last.groupBy("file", "lib").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("attrs")), ["file", "lib"], "left")
    attrs = F.coalesce("attrs", F.create_map().cast("map<string,string>"))
    return libs.select("lib", F.coalesce(attrs["id"], F.concat(F.lit("raw"), (F.col("lib") + 1).cast("string"))).alias("id"), attrs.alias("attrs"))


def read_scaffolder_libraries(spark: SparkSession, path: str) -> DataFrame:
    """name, file1, file2, insert, error, reverse, problem: six fields a line; problem names what is wrong, null if nothing is."""
    f = F.split(F.trim("value"), r"\s+")
    col = lambda k, t: F.get(f, F.lit(k)).try_cast(t)
    rows = spark.read.text(path).where("trim(value) != ''")
    problem = (
        F.when(F.size(f) != 6, "not six fields").when(col(3, "double").isNull() | (col(3, "double") <= 0), "insert size").when(col(4, "double").isNull() | ~col(4, "double").between(0, 1), "error must be between 0 and 1").when(~col(5, "string").isin("0", "1", "FR", "RF", "FF", "RR"), "orientation")
    )
    return rows.select(col(0, "string").alias("name"), col(1, "string").alias("file1"), col(2, "string").alias("file2"), col(3, "double").alias("insert"), col(4, "double").alias("error"), col(5, "string").alias("reverse"), problem.alias("problem"))


def read_barcodes(spark: SparkSession, path: str) -> DataFrame:
    """ord, ident, barcode; raises if lengths differ or a barcode has letters other than A, C, G, T. The table is collected to check it: it is a run's few barcodes."""
    rows = numbered_lines(spark, path).where("value NOT LIKE '#%' AND trim(value) != ''").select("ord", F.get(F.split(F.trim("value"), r"\s+"), F.lit(0)).alias("ident"), F.upper(F.get(F.split(F.trim("value"), r"\s+"), F.lit(1))).alias("barcode"))
    bad = rows.agg(F.count_distinct(F.char_length("barcode")).alias("lengths"), F.count_if(F.expr("barcode IS NULL OR barcode NOT RLIKE '^[ACGT]+$'")).alias("bad")).first()
    if bad.lengths > 1 or bad.bad:
        raise ValueError("barcodes must be of one length and of A, C, G and T")
    return rows


def read_maf(spark: SparkSession, path: str) -> DataFrame:
    """block, ord, species, start, size, strand, src_size, aln of 's' lines."""
    lines = numbered_lines(spark, path)
    w = Window.partitionBy("file").orderBy("ord")
    lines = lines.withColumn("block", F.sum(F.col("value").rlike(r"^a\b").cast("int")).over(w) - 1).where(F.col("value").rlike(r"^s\s"))
    f = F.split("value", r"\s+")
    col = lambda k, t: F.get(f, F.lit(k)).cast(t)
    return lines.select("block", "ord", F.substring_index(col(1, "string"), ".", 1).alias("species"), col(2, "int").alias("start"), col(3, "int").alias("size"), col(4, "string").alias("strand"), col(5, "int").alias("src_size"), col(6, "string").alias("aln"))


def read_xmfa(spark: SparkSession, path: str) -> DataFrame:
    """lcb, seq_no, left, right, strand, aln of blocks that end in '='; comment lines are skipped."""
    blocks = spark.read.text(path, lineSep="\n=").select(F.monotonically_increasing_id().alias("lcb"), F.regexp_replace("value", r"(?m)^#.*\n?", "").alias("v"))
    rec = blocks.select("lcb", F.explode(F.split("v", ">")).alias("r")).where(F.col("r").rlike(r"^\s*\d+:"))
    m = r"^\s*(\d+):(\d+)-(\d+)\s+([+-])"
    return rec.select("lcb", *[F.regexp_extract("r", m, k).cast(t).alias(n) for k, n, t in ((1, "seq_no", "int"), (2, "left", "int"), (3, "right", "int"), (4, "strand", "string"))], F.regexp_replace(F.expr("substring(r, instr(r, '\\n') + 1)"), r"\s", "").alias("aln"))


def read_genbank(spark: SparkSession, path: str) -> DataFrame:
    """record, kind, start, end, strand, qualifiers map of features with simple or complement locations (joins: from first to last base). Whole files, one task each."""
    import re

    import pandas as pd

    def parse(batches):
        for pdf in batches:
            rows = []
            for text in pdf["value"]:
                for part in text.split("\n//"):
                    m = re.search(r"^LOCUS\s+(\S+)", part, re.M)
                    block = re.search(r"^FEATURES.*?\n(.*?)(?=^ORIGIN|^CONTIG|\Z)", part, re.M | re.S)
                    if not m or not block:
                        continue
                    for f in re.finditer(r"^ {5}(\S+)\s+(.*?)(?=^ {5}\S|\Z)", block[1], re.M | re.S):
                        where, *tags = re.split(r"\n\s+/", f[2])
                        at = [int(x) for x in re.findall(r"\d+", where)]
                        pairs = dict((t.strip().split("=", 1) + [""])[:2] for t in tags)
                        rows.append((m[1], f[1], min(at), max(at), -1 if "complement" in where else 1, {k: re.sub(r"\s*\n\s*", " ", v).strip().strip('"') for k, v in pairs.items()}))
            yield pd.DataFrame(rows, columns=["record", "kind", "start", "end", "strand", "qualifiers"])

    return spark.read.text(path, wholetext=True).mapInPandas(parse, "record string, kind string, start int, end int, strand int, qualifiers map<string,string>")


def read_synteny_control(spark: SparkSession, path: str) -> DataFrame:
    """section ('maps' or 'matches'), contig1, contig2, path of lines between '-maps', '-matches' and 'end'."""
    lines = numbered_lines(spark, path).where("trim(value) != ''")
    w = Window.partitionBy("file").orderBy("ord")
    mark = F.when(F.col("value").rlike(r"^\s*-(maps|matches)"), F.regexp_extract("value", r"-(\w+)", 1)).when(F.lower(F.trim("value")) == "end", "")
    lines = lines.withColumn("section", F.last(mark, ignorenulls=True).over(w)).where(mark.isNull() & F.col("section").isin("maps", "matches"))
    f = F.split(F.trim("value"), r"\s+")
    maps = F.col("section") == "maps"
    return lines.select("section", F.get(f, F.lit(0)).try_cast("int").alias("contig1"), F.when(~maps, F.get(f, F.lit(1)).try_cast("int")).alias("contig2"), F.when(maps, F.get(f, F.lit(1))).otherwise(F.get(f, F.lit(2))).alias("path"))


def read_matches(spark: SparkSession, path: str, least: float) -> DataFrame:
    """gene1, gene2, score of at least so much."""
    return read_delimited(spark, path, "gene1 string, gene2 string, score double").where(F.col("score") >= least)


def read_qseq(spark: SparkSession, path: str) -> DataFrame:
    """name, mate, seq, qual (offset 33), passed of eleven-column qseq lines: dots are N, qualities come in offset 64."""
    from ..functions.quality import shift

    f = F.split("value", "\t")
    col = lambda k: F.get(f, F.lit(k))
    return spark.read.text(path).where(F.size(f) >= 11).select(F.concat_ws(":", *[col(k) for k in range(6)]).alias("name"), col(7).cast("int").alias("mate"), F.translate(col(8), ".", "N").alias("seq"), shift(col(9), -31).alias("qual"), (col(10) == "1").alias("passed"))


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """As read_qseq of 22-column export lines."""
    from ..functions.quality import shift

    f = F.split("value", "\t")
    col = lambda k: F.get(f, F.lit(k))
    return spark.read.text(path).where(F.size(f) >= 22).select(F.concat_ws(":", *[col(k) for k in range(6)]).alias("name"), col(7).cast("int").alias("mate"), F.translate(col(8), ".", "N").alias("seq"), shift(col(9), -31).alias("qual"), (col(21) == "Y").alias("passed"))


def read_scarf(spark: SparkSession, path: str) -> DataFrame:
    """name, seq, qual (offset 33) of colon-parted lines whose last two fields are sequence and qualities in offset 64."""
    from ..functions.quality import shift

    m = r"^(.*):([ACGTN.]+):(.*)$"
    return spark.read.text(path).where(F.col("value").rlike(m)).select(F.regexp_extract("value", m, 1).alias("name"), F.translate(F.regexp_extract("value", m, 2), ".", "N").alias("seq"), shift(F.regexp_extract("value", m, 3), -31).alias("qual"))


def read_prb(spark: SparkSession, path: str) -> DataFrame:
    """file, ord, seq, qual (offset 33) of lines of four scores a base, in the order A, C, G, T: the base with the best score, the first one on ties, N where none is positive."""
    from ..functions.quality import encode, solexa_to_phred

    groups = F.filter(F.split("value", r"\t"), lambda g: F.trim(g) != "")
    scores = F.transform(groups, lambda g: F.transform(F.split(F.trim(g), r"\s+"), lambda x: x.try_cast("int")))
    rows = numbered_lines(spark, path).where("trim(value) != ''").withColumn("s", scores)
    base = F.transform("s", lambda x: F.when(F.array_max(x) > 0, F.get(F.array(*map(F.lit, "ACGT")), F.array_position(x, F.array_max(x)).cast("int") - 1)).otherwise("N"))
    return rows.select("file", "ord", F.array_join(base, "").alias("seq"), encode(solexa_to_phred(F.transform("s", lambda x: F.array_max(x)))).alias("qual"))
