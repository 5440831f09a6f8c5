"""Hit and evidence tables from text: BLAST, expression, domains, conserved genes, FASTA."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLAST = "query string, subject string, pident double, length long, mismatch long, gapopen long, qstart long, qend long, sstart long, send long, evalue double, bitscore double, qcovs double"


def read_blast(spark: SparkSession, path: str) -> DataFrame:
    """Tabular hits with 13 columns and no header."""
    return spark.read.csv(path, sep="\t", schema=BLAST)


def read_expression(spark: SparkSession, path: str) -> DataFrame:
    """Isoform expression with a header: ``transcript_id, tpm``; without these names, the first and the last column."""
    t = spark.read.csv(path, sep="\t", header=True)
    key = "transcript_id" if "transcript_id" in t.columns else t.columns[0]
    value = "TPM" if "TPM" in t.columns else t.columns[-1]
    return t.select(F.col(key).alias("transcript_id"), F.col(value).try_cast("double").alias("tpm"))


def read_coverage(spark: SparkSession, path: str, id_at: int = 4, fraction_at: int = 8) -> DataFrame:
    """Coverage tables without a header: id and covered fraction by column number."""
    f = F.split("value", "\t")
    return spark.read.text(path).select(f[id_at].alias("transcript_id"), f[fraction_at].try_cast("double").alias("fraction"))


def read_domains(spark: SparkSession, path: str) -> DataFrame:
    """Domain scans separated by white space with ``#`` comments: ``transcript_id, domain``."""
    f = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).where(~F.col("value").startswith("#")).where(F.size(f) >= 8).select(f[0].alias("transcript_id"), f[6].alias("domain"))


def read_busco(spark: SparkSession, path: str) -> DataFrame:
    f = F.split("value", "\t")
    return spark.read.text(path).where(~F.col("value").startswith("#")).select(f[0].alias("busco_id"), f[1].alias("status"), F.get(f, F.lit(2)).alias("transcript_id"))


def read_fasta(spark: SparkSession, path: str, sep: str | None = None, index: int = 0) -> DataFrame:
    """``seq_id, description, seq``: records are split at ``>`` after a line feed by the reader, so no line order is needed.
    The id is the header's first token, or with ``sep`` that part of it. Compressed files are read as well."""
    rec = spark.read.text(path, lineSep="\n>").where("trim(value) NOT IN ('', '>')").withColumn("value", F.regexp_replace("value", "^>", ""))
    head = F.regexp_extract("value", r"^([^\r\n]*)", 1)
    token = F.regexp_extract(head, r"^(\S*)", 1)
    if sep is not None:
        token = F.coalesce(F.get(F.split(token, f"\\Q{sep}\\E"), F.lit(index)), token)
    return rec.select(token.alias("seq_id"), head.alias("description"), F.regexp_replace(F.regexp_replace("value", r"^[^\n]*", ""), r"\s", "").alias("seq"))


def write_fasta(sequences: DataFrame, path: str) -> None:
    sequences.select(F.concat(F.lit(">"), "seq_id", F.lit("\n"), "seq").alias("value")).write.text(path)


def best_per(hits: DataFrame, key: str, *order) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*order)
    return hits.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def fasta_groups(sequences: DataFrame, path: str, per_file: int = 100) -> None:
    """FASTA files of about ``per_file`` sequences each, dealt by a hash of the id."""
    n = sequences.count()
    groups = max(1, -(-n // per_file))
    grouped = sequences.withColumn("group", F.pmod(F.xxhash64("seq_id"), F.lit(groups)))
    grouped.select(F.concat(F.lit(">"), "seq_id", F.lit("\n"), "seq").alias("value"), "group").repartition("group").write.partitionBy("group").text(path)


def _fields(spark: SparkSession, path: str, least: int, pattern: str = "\t", comment: str = "#"):
    """Lines that are no comments as arrays ``f`` of at least ``least`` fields."""
    lines = spark.read.text(path).where(~F.col("value").startswith(comment) & (F.trim("value") != ""))
    return lines.select(F.split(F.trim("value") if pattern != "\t" else F.col("value"), pattern).alias("f"), "value").where(F.size("f") >= least)


def read_lengths(spark: SparkSession, path: str) -> DataFrame:
    """``seqid, length`` of a FASTA index, or of the sequence lines of an alignment header (``@SQ SN: LN:``)."""
    t = spark.read.text(path)
    name, size = F.regexp_extract("value", r"\tSN:([^\t]+)", 1), F.regexp_extract("value", r"\tLN:(\d+)", 1)
    f = F.split("value", "\t")
    header = F.col("value").startswith("@")
    return t.where(F.when(header, F.col("value").startswith("@SQ")).otherwise(F.size(f) >= 2)).select(F.when(header, name).otherwise(f[0]).alias("seqid"), F.when(header, size).otherwise(F.get(f, F.lit(1))).try_cast("long").alias("length")).where("length IS NOT NULL")


def sequence_lengths(sequences: DataFrame) -> DataFrame:
    return sequences.select(F.col("seq_id").alias("seqid"), F.length("seq").cast("long").alias("length"))


def read_lncdc(spark: SparkSession, path: str) -> DataFrame:
    """``transcript_id, lnc, noncoding_prob, hexamer, fickett`` of a table with a header; the scores are null if it has other
    columns than expected."""
    t = spark.read.csv(path, header=True)
    named = lambda c: F.col(f"`{c}`").try_cast("double") if c in t.columns else F.lit(None).cast("double")
    label = F.col(f"`{t.columns[25]}`").try_cast("double") if len(t.columns) > 25 else F.lit(None).cast("double")
    return t.select(F.regexp_extract(F.col(f"`{t.columns[0]}`"), r"^(\S*)", 1).alias("transcript_id"), label.alias("lnc"), named("Noncoding_prob").alias("noncoding_prob"), named("Hexamer_score_ORF_T0").alias("hexamer"), named("Fickett_score").alias("fickett"))


def read_cpc2(spark: SparkSession, path: str) -> DataFrame:
    """Ids that the last column calls noncoding, in any case: ``transcript_id``."""
    f = _fields(spark, path, 2)
    return f.where(F.lower(F.trim(F.element_at("f", -1))) == "noncoding").select(F.col("f")[0].alias("transcript_id")).distinct()


def read_domtblout(spark: SparkSession, path: str) -> DataFrame:
    """Domain table of at least 23 fields: ``domain, hmm_len, gene, evalue, hmm_start, hmm_end``."""
    f = _fields(spark, path, 23, r"\s+")
    n = lambda i, t: F.col("f")[i].try_cast(t)
    return f.select(F.col("f")[0].alias("domain"), n(2, "int").alias("hmm_len"), F.col("f")[3].alias("gene"), n(12, "double").alias("evalue"), n(15, "long").alias("hmm_start"), n(16, "long").alias("hmm_end"))


def read_junctions(spark: SparkSession, path: str) -> DataFrame:
    """``chrom, start, end, strand`` of lines with at least five fields; any strand but + and - is ``.``."""
    f = _fields(spark, path, 5, r"\s+")
    strand = F.when(F.col("f")[4].isin("+", "-"), F.col("f")[4]).otherwise(".")
    return f.select(F.col("f")[0].alias("chrom"), F.col("f")[1].try_cast("long").alias("start"), F.col("f")[2].try_cast("long").alias("end"), strand.alias("strand")).where("start IS NOT NULL AND end IS NOT NULL").distinct()


def read_diamond(spark: SparkSession, path: str) -> DataFrame:
    """The best hit per query (``gene, evalue, length, bitscore``): lowest e-value, then longest, then highest score."""
    f = _fields(spark, path, 4)
    t = f.select(F.col("f")[0].alias("gene"), F.col("f")[1].try_cast("double").alias("evalue"), F.col("f")[2].try_cast("long").alias("length"), F.col("f")[3].try_cast("double").alias("bitscore"))
    return best_per(t, "gene", F.asc_nulls_last("evalue"), F.desc_nulls_last("length"), F.desc_nulls_last("bitscore"))


def read_transdecoder_scores(spark: SparkSession, path: str) -> DataFrame:
    """``transcript_id, score`` of a table that begins with ``#acc`` and has a column ``score_1``."""
    t = spark.read.csv(path, sep="\t", header=True)
    return t.select(F.col("`#acc`").alias("transcript_id"), F.col("score_1").try_cast("double").alias("score"))


def read_weights(spark: SparkSession, path: str) -> DataFrame:
    f = _fields(spark, path, 3, r"\s+")
    return f.select(F.col("f")[0].alias("class"), F.col("f")[1].alias("source"), F.col("f")[2].try_cast("double").alias("weight"))


def read_read_starts(spark: SparkSession, path: str) -> DataFrame:
    """``seqid, pos`` of alignment records; headers, short lines and positions that are no number are skipped."""
    f = _fields(spark, path, 4, comment="@")
    return f.select(F.col("f")[2].alias("seqid"), F.col("f")[3].try_cast("long").alias("pos")).where("pos IS NOT NULL")


def read_depth(spark: SparkSession, path: str) -> DataFrame:
    """Depth runs of a BED file, half-open: ``chrom, start, end, depth``. Bases are made of them only by :func:`per_base`."""
    f = _fields(spark, path, 4)
    n = lambda i: F.col("f")[i].try_cast("long")
    return f.select(F.col("f")[0].alias("chrom"), n(1).alias("start"), n(2).alias("end"), n(3).alias("depth"))


def per_base(runs: DataFrame) -> DataFrame:
    """One row per 1-based position."""
    return runs.where("end > start").select("chrom", F.explode(F.sequence(F.col("start") + 1, F.col("end"))).alias("pos"), "depth")


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """``file, complete, single, duplicated, fragmented, missing, n`` from a short summary's first ``C:..%[S:..%,D:..%],F:..%,M:..%,n:..``;
    ``N/A`` where it is absent."""
    t = spark.read.text(path, wholetext=True).withColumn("file", F.input_file_name())
    one = lambda p: F.coalesce(F.nullif(F.regexp_extract("value", p, 1), F.lit("")), F.lit("N/A"))
    return t.select("file", *(one(rf"{k}:([0-9.]+)%?").alias(n) for k, n in (("C", "complete"), ("S", "single"), ("D", "duplicated"), ("F", "fragmented"), ("M", "missing"), ("n", "n"))))


def listed(spark: SparkSession, path: str, extensions: Sequence[str] = ()) -> DataFrame:
    """``path, bytes`` of all files below ``path`` that aren't empty, at any depth, with one of the ``extensions``. Contents are
    not read."""
    t = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", F.col("length").alias("bytes"))
    ends = [F.lower("path").endswith(e.lower()) for e in extensions]
    return t.where(reduce(or_, ends)) if ends else t


def find_reads(spark: SparkSession, path: str) -> DataFrame:
    """The samples in all read files below ``path``, see :func:`fastq_pairs`. Empty files are not found."""
    return fastq_pairs(listed(spark, path, (".fastq", ".fq", ".fastq.gz", ".fq.gz")))


def read_plain(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """A table without a header: columns ``column0``, ``column1`` ... with the types that their values have."""
    t = spark.read.option("sep", sep).option("inferSchema", "true").csv(path)
    return t.toDF(*(f"column{k}" for k in range(len(t.columns))))


def read_omark(spark: SparkSession, path: str) -> DataFrame:
    """``file, consistent, contaminated, missing`` from the last line ``A:..%[..],I:..%[..],C:..%[..],U:..%`` of proteome
    summaries (``.sum``); ``N/A`` where there is none, and for files of up to 50 bytes."""
    t = spark.read.text(path, wholetext=True).withColumn("file", F.input_file_name())
    line = r"(?m)^\s*A:([0-9]+\.?[0-9]*)%.*,I:([0-9]+\.?[0-9]*)%.*,C:([0-9]+\.?[0-9]*)%.*,U:([0-9]+\.?[0-9]*)%"
    last = lambda k: F.coalesce(F.when(F.octet_length("value") > 50, F.try_element_at(F.regexp_extract_all("value", F.lit(line), F.lit(k)), F.lit(-1))), F.lit("N/A"))
    return t.select("file", last(1).alias("consistent"), last(3).alias("contaminated"), last(4).alias("missing"))


def fastq_pairs(files: DataFrame) -> DataFrame:
    """``sample, one, two, single`` from file names (``path``): mates by ``_1``/``_2`` or ``_R1``/``_R2``. A sample with one mate of
    two raises, and so does an empty listing."""
    name = F.regexp_extract("path", r"([^/]+?)(?:_R?([12]))?\.(?:fastq|fq)(?:\.gz)?$", 1)
    which = F.regexp_extract("path", r"([^/]+?)(?:_R?([12]))?\.(?:fastq|fq)(?:\.gz)?$", 2)
    t = files.select("path", name.alias("sample"), which.alias("mate")).where("sample <> ''")
    g = t.groupBy("sample").agg(*(F.min(F.when(F.col("mate") == m, F.col("path"))).alias(n) for m, n in (("1", "one"), ("2", "two"), ("", "single"))))
    bad = g.where("(one IS NULL) <> (two IS NULL)").limit(5).collect()
    if bad or g.isEmpty():
        raise ValueError("mates missing for " + ", ".join(r.sample for r in bad) if bad else "no reads found")
    return g


def read_genewise(spark: SparkSession, path: str) -> DataFrame:
    """Rows of blocks that end with ``//``: ``block, target, seqid, start, end, strand, line``. The target of a block's rows,
    ``<seqid>.<start>.<end>.<strand>``, is split from its end, as sequence names may hold dots."""
    blocks = spark.read.text(path, lineSep="//\n").where("trim(value) <> ''").select(F.monotonically_increasing_id().alias("block"), "value")
    rows = blocks.select("block", F.explode(F.split("value", "\n")).alias("line")).where("trim(line) <> '' AND size(split(line, '\t')) >= 9")
    target = F.split("line", "\t")[0]
    part = lambda i: F.regexp_extract(target, r"^(.*)\.(\d+)\.(\d+)\.(\w+)$", i)
    return rows.select("block", target.alias("target"), part(1).alias("seqid"), part(2).try_cast("long").alias("start"), part(3).try_cast("long").alias("end"), part(4).alias("strand"), "line")


def read_augustus(spark: SparkSession, path: str) -> DataFrame:
    """``gene, support, introns``: the hint support lines of a prediction, each belonging to the gene before it. Genes end at
    ``###``, so a record holds a gene and what is said about it."""
    rec = spark.read.text(path, lineSep="###")
    gene = F.regexp_extract("value", r"\tgene\t[^\n]*\t(?:ID=)?([^;\s]+)[^\n]*", 1)
    said = lambda p: F.nullif(F.regexp_extract("value", p, 1), F.lit(""))
    return rec.where(gene != "").select(gene.alias("gene"), said(r"# % of transcript supported by hints \(any source\): ([0-9.]+)").try_cast("double").alias("support"), said(r"# CDS introns: (\S+)").alias("introns"))
