"""Gene models: validation, sanitizing, numbering and derived features.

Child tables have ``mrna``, ``start`` and ``end`` (closed), models ``gene`` and ``mrna``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def overlapping_cds(cds: DataFrame) -> DataFrame:
    """mRNAs with a CDS that starts at or before its predecessor's end."""
    w = Window.partitionBy("mrna").orderBy("start", "end")
    return cds.withColumn("_prev", F.lag("end").over(w)).where("start <= _prev").select("mrna").distinct()


def drop_models(models: DataFrame, bad: DataFrame) -> DataFrame:
    """Models without the bad mRNAs; a gene stays while one of its mRNAs does."""
    return models.join(bad, "mrna", "left_anti")


def childless(models: DataFrame, children: DataFrame) -> DataFrame:
    return models.join(children.select("mrna").distinct(), "mrna", "left_anti")


def strand_conflicts(children: DataFrame) -> DataFrame:
    """mRNAs whose children lie on several strands."""
    return children.groupBy("mrna").agg(F.count_distinct("strand").alias("strands")).where("strands > 1")


def chimeras(children: DataFrame, most_exons: int = 110, most_residues: int = 20000) -> DataFrame:
    """mRNAs with implausibly many exons or too long a CDS."""
    g = children.groupBy("mrna").agg(F.count(F.lit(1)).alias("exons"), F.sum(F.col("end") - F.col("start") + 1).alias("bp"))
    return g.where((F.col("exons") > most_exons) | (F.col("bp") / 3 > most_residues))


def beyond_chromosome(features: DataFrame, lengths: DataFrame) -> DataFrame:
    return features.join(lengths, "chrom").where("end > length")


def single_exon(n_exon: str = "n_exon", n_cds: str = "n_cds") -> Column:
    """By exons, or by CDS where a model has none."""
    return F.when(F.col(n_exon) > 0, F.col(n_exon)).otherwise(F.col(n_cds)) <= 1


def phases(cds: DataFrame) -> DataFrame:
    """CDS phase: bases to skip to the next codon, in order of translation."""
    order = F.when(F.col("strand") == "-", -F.col("start")).otherwise(F.col("start"))
    w = Window.partitionBy("mrna").orderBy(order, "end").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.col("end") - F.col("start") + 1).over(w), F.lit(0).cast("long"))
    return cds.withColumn("phase", F.pmod(3 - before % 3, F.lit(3)).cast("int"))


def utrs(exons: DataFrame, spans: DataFrame) -> DataFrame:
    """The parts of exons outside the CDS span (``cds_start``, ``cds_end`` per mRNA), typed by strand."""
    e = exons.join(spans.hint("merge"), "mrna")
    left = F.struct(F.col("start").alias("s"), F.least(F.col("end"), F.col("cds_start") - 1).alias("e"), F.when(F.col("strand") == "-", "three_prime_UTR").otherwise("five_prime_UTR").alias("type"))
    right = F.struct(F.greatest(F.col("start"), F.col("cds_end") + 1).alias("s"), F.col("end").alias("e"), F.when(F.col("strand") == "-", "five_prime_UTR").otherwise("three_prime_UTR").alias("type"))
    return e.select("mrna", "strand", F.explode(F.array(left, right)).alias("u")).where("u.s <= u.e").select("mrna", "strand", F.col("u.type").alias("type"), F.col("u.s").alias("start"), F.col("u.e").alias("end"))


def number_isoforms(models: DataFrame, *order: str) -> DataFrame:
    return models.withColumn("isoform", F.row_number().over(Window.partitionBy("gene").orderBy(*order)))


def introns(cds: DataFrame) -> DataFrame:
    """Gaps between neighbouring intervals of an mRNA (closed coordinates, at least two bases)."""
    w = Window.partitionBy("mrna").orderBy("start", "end")
    return cds.select("mrna", (F.col("end") + 1).alias("i_start"), (F.lead("start").over(w) - 1).alias("i_end")).where("i_end > i_start")


def pick_winner(e_a: str, e_b: str, len_a: str, len_b: str) -> Column:
    """A or B: an e-value ten times better wins, then a hit a tenth longer, else tie. A hit beats none."""
    a, b = F.col(e_a), F.col(e_b)
    return (
        F.when(a.isNull() & b.isNull(), "tie").when(b.isNull(), "A").when(a.isNull(), "B")
        .when(a * 10 < b, "A").when(b * 10 < a, "B")
        .when(F.col(len_a) > F.col(len_b) * 1.1, "A").when(F.col(len_b) > F.col(len_a) * 1.1, "B").otherwise("tie")
    )
