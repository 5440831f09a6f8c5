"""GFF3 features: reader, gene blocks, writer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.attributes import attribute, parents
from ..operators.loci import depth_runs
from ..operators.sweep import carried, within
from ..operators.tree import line_range

COLUMNS = ["seqid", "source", "type", "start", "end", "score", "strand", "phase", "attributes"]


def read_gff3(spark: SparkSession, path: str, further: bool = True) -> DataFrame:
    """Feature rows with ``line_no``, ``id`` and ``parents``. Comments and rows of fewer than nine fields go; ``further``
    fields are joined to the attributes by a space, or go as well. Scores and phases of ``.`` are null. ``line_no`` orders lines within
    a file and numbers files by their place in the scan, so it needs no shuffle."""
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("line_no"), F.split("value", "\t").alias("f"), "value")
    rows = lines.where(~F.col("value").startswith("#") & (F.size("f") >= 9))
    cols = {c: F.col("f")[i] for i, c in enumerate(COLUMNS[:8])}
    cols["attributes"] = F.array_join(F.slice("f", 9, 1 << 20), " ") if further else F.col("f")[8]
    for c, kind in (("start", "long"), ("end", "long"), ("score", "double"), ("phase", "int")):
        cols[c] = cols[c].try_cast(kind)
    rows = rows.select("line_no", *(v.alias(k) for k, v in cols.items()))
    return rows.withColumn("id", attribute("attributes", "ID")).withColumn("parents", parents("attributes"))


def gene_blocks(features: DataFrame, by: str = "seqid") -> DataFrame:
    """``block``: the running number of ``gene`` rows on each sequence, in line order; gene rows of ranges of lines are
    counted first."""
    gene = (F.col("type") == "gene").cast("long")
    t = carried(features, [by], F.col("line_no"), line_range(features), {"_before": F.sum(gene)})
    return t.withColumn("block", F.coalesce("_before", F.lit(0).cast("long")) + F.sum(gene).over(within([by], "line_no"))).drop("_before", "_range")


def gene_content(features: DataFrame) -> DataFrame:
    """Every row below a gene with its ``gene`` and ``transcript``: any child of a gene that has an id is a transcript, and any
    child of one its content. Rows that name several parents belong to the transcripts among them, one row for each."""
    genes = features.where("type = 'gene'").select(F.col("id").alias("gene")).distinct()
    below = features.withColumn("_up", F.explode("parents"))
    transcripts = below.join(genes, F.col("_up") == F.col("gene")).where("id IS NOT NULL").drop("_up").withColumn("transcript", F.col("id"))
    known = transcripts.select(F.col("transcript").alias("_t"), F.col("gene").alias("_g")).dropDuplicates(["_t"])
    content = below.join(known, F.col("_up") == F.col("_t")).withColumn("gene", F.col("_g")).withColumn("transcript", F.col("_t")).drop("_up", "_t", "_g")
    return transcripts.unionByName(content)


def with_genes(features: DataFrame) -> DataFrame:
    """``mrna`` and ``gene`` of every child of an mRNA; a child with several parents gives several rows."""
    mrna = features.where("type = 'mRNA'").select(F.col("id").alias("mrna"), F.element_at("parents", 1).alias("gene"))
    return features.where("type NOT IN ('gene', 'mRNA')").withColumn("mrna", F.explode("parents")).join(mrna, "mrna")


def split_by_ids(features: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose id or any parent is in ``ids`` (``id``), and the others."""
    keys = features.select("line_no", F.explode(F.concat(F.array("id"), F.coalesce("parents", F.array().cast("array<string>")))).alias("key")).where("key IS NOT NULL")
    hit = keys.join(ids.select(F.col("id").alias("key")).distinct(), "key", "left_semi").select("line_no").distinct()
    return features.join(hit, "line_no", "left_semi"), features.join(hit, "line_no", "left_anti")


def write_gff3(features: DataFrame, path: str) -> None:
    """Range-sorted by line number; one file per partition."""
    dot = F.lit(".")
    cols = [F.coalesce(F.col(c).cast("string"), dot) if c in ("score", "phase", "strand") else F.col(c).cast("string") for c in COLUMNS]
    features.orderBy("line_no").select(F.concat_ws("\t", *cols).alias("value")).write.text(path)


def miniprot_models(features: DataFrame) -> DataFrame:
    """Protein alignments (mRNA and CDS rows) as models: ``mrna, gene, target, identity, rank, seqid, start, end, strand, score,
    cds`` (its coding parts in order). Each mRNA stands for a gene of its own; identity is 0 and rank 1 where not given."""
    m = features.where("type = 'mRNA'").select(F.col("id").alias("mrna"), F.concat("id", F.lit("_gene")).alias("gene"), F.split(F.regexp_extract("attributes", "(?:^|;)Target=([^;]+)", 1), " ")[0].alias("target"), F.coalesce(attribute("attributes", "Identity").try_cast("double"), F.lit(0.0)).alias("identity"), F.coalesce(attribute("attributes", "Rank").try_cast("int"), F.lit(1)).alias("rank"), "seqid", "start", "end", "strand", "score")
    parts = features.where("type = 'CDS'").select(F.explode("parents").alias("mrna"), F.struct("start", "end").alias("p")).groupBy("mrna").agg(F.array_sort(F.collect_list("p")).alias("cds"))
    return m.join(parts, "mrna", "left")


def with_gene_rows(features: DataFrame) -> DataFrame:
    """Rows of protein alignments with a gene row above each mRNA (half a line before it), which names it as parent."""
    m = features.where("type = 'mRNA'")
    gene = F.concat("id", F.lit("_gene"))
    rows = m.withColumn("attributes", F.concat(F.lit("ID="), gene)).withColumn("id", gene).withColumn("type", F.lit("gene")).withColumn("parents", F.lit(None).cast("array<string>")).withColumn("line_no", F.col("line_no") * 2)
    own = m.withColumn("attributes", F.concat("attributes", F.lit(";Parent="), gene)).withColumn("parents", F.array(gene)).withColumn("line_no", F.col("line_no") * 2 + 1)
    rest = features.where("type <> 'mRNA'").withColumn("line_no", F.col("line_no") * 2 + 1)
    return rows.unionByName(own).unionByName(rest)


def read_miniprot(spark: SparkSession, path: str) -> DataFrame:
    return miniprot_models(read_gff3(spark, path))


def protein_depth(features: DataFrame, by: str = "seqid") -> DataFrame:
    """Runs of depth of the coding rows of protein alignments: ``seqid, start, end, depth``, half-open. Positions are taken
    over as they stand in the file, so a part covers what follows its first base, up to its last."""
    return depth_runs(features.where(F.col("type").contains("CDS")).select(by, "start", "end"), [by])


def with_depth(positions: DataFrame, runs: DataFrame, name: str, size: int = 4096) -> DataFrame:
    """``positions`` (``seqid``, ``position``, 1-based) with a column of the depth there (0 without a run)."""
    runs = runs.select(F.col("seqid").alias("_q"), F.col("start").alias("_s"), F.col("end").alias("_e"), F.col("depth").alias("_d")).withColumn("_b", F.explode(F.sequence(F.floor(F.col("_s") / size), F.floor((F.col("_e") - 1) / size))))
    at = F.col("position") - 1
    on = (F.col("seqid") == F.col("_q")) & (F.floor(at / size) == F.col("_b")) & (at >= F.col("_s")) & (at < F.col("_e"))
    return positions.join(runs, on, "left").withColumn(name, F.coalesce("_d", F.lit(0).cast("long"))).drop("_q", "_s", "_e", "_d", "_b")


def as_evidence(features: DataFrame, pattern: str, source: str | None = None, kind: str | None = None, rename: tuple[str, str] | None = None) -> DataFrame:
    """Features whose type matches ``pattern`` for a consensus: source and type replaced, an attribute key renamed (such as
    Parent to ID), and coordinates in order."""
    t = features.where(F.col("type").rlike(pattern))
    if rename:
        t = t.withColumn("attributes", F.regexp_replace("attributes", f"(^|;){rename[0]}=", f"$1{rename[1]}="))
    if source:
        t = t.withColumn("source", F.lit(source))
    if kind:
        t = t.withColumn("type", F.lit(kind))
    return t.withColumn("_s", F.least("start", "end")).withColumn("end", F.greatest("start", "end")).withColumn("start", F.col("_s")).drop("_s")


def combined(spark: SparkSession, path: str) -> DataFrame:
    """Lines of several genomes' files with each sequence name prefixed by the first three letters of its file's name."""
    lines = spark.read.text(path).withColumn("_file", F.input_file_name()).where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    prefix = F.substring(F.regexp_extract("_file", r"([^/]+)$", 1), 1, 3)
    return lines.select(F.concat(prefix, "value").alias("value"))
