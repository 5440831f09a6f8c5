"""Evidence scores of isoforms and the best source per locus; repeats, regions and partitioned predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..written import written
from .evidence import first_by
from .interval import overlap_join
from .loci import clusters, log_evidence
from .sweep import carried, measure, previous, within


def isoform_scores(features: DataFrame, runs: DataFrame, penalty: float = 0.01) -> DataFrame:
    """``source, mrna, locus, score, length, norm_score`` of isoforms: the summed log evidence of all bases of their
    features (closed; ``chrom``), over their length (without the last base, as the rule has it; null if that is 0).

    ``runs`` are half-open stretches of equal ``depth`` (one row per stretch, never per base); bases outside count as
    depth 0 and get the penalty."""
    by = ["source", "mrna", "locus"]
    met = overlap_join(features.select(*by, "chrom", "start", (F.col("end") + 1).alias("end")), runs.select("chrom", F.col("start").alias("b_start"), F.col("end").alias("b_end"), "depth"))
    bases = F.least("end", "b_end") - F.greatest("start", "b_start")
    seen = met.groupBy(*by).agg(F.sum(bases * log_evidence("depth", penalty)).alias("_s"), F.sum(bases).alias("_n"))
    size = features.groupBy(*by).agg(F.sum(F.col("end") - F.col("start") + 1).alias("_all"), F.sum(F.col("end") - F.col("start")).alias("length"))
    low = F.log10(F.lit(penalty)) + 1
    score = F.coalesce("_s", F.lit(0.0)) + (F.col("_all") - F.coalesce("_n", F.lit(0).cast("long"))) * low
    return size.join(seen, by, "left").select(*by, score.alias("score"), "length", (score / F.nullif(F.col("length"), F.lit(0))).alias("norm_score"))


def select_sources(scores: DataFrame) -> DataFrame:
    """``locus, source`` of the best isoform of each locus; ties go to the alphabetically first source."""
    return first_by(scores, "locus", F.desc_nulls_last("norm_score"), F.asc_nulls_last("source")).select("locus", "source")


def selected_annotations(annotations: DataFrame, chosen: DataFrame) -> DataFrame:
    """The annotations of each locus' chosen source, with ``min_start`` of their gene for the order of output."""
    kept = annotations.join(chosen, ["locus", "source"])
    return kept.withColumn("min_start", F.min("start").over(Window.partitionBy("gene")))


def repeat_share(cds: DataFrame, repeats: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """``gene, overlap, cds_bp, share``: how much of each gene's CDS lies in the union of the repeats (closed; ``name``
    names their kind). Genes without CDS have no row."""
    r = repeats if not ignore else repeats.where(F.col("name").isNull() | ~F.col("name").isin(*ignore))
    half = cds.select("gene", "chrom", "start", (F.col("end") + 1).alias("end"))
    m = measure(half, r.select("chrom", F.col("start").alias("b_start"), (F.col("end") + 1).alias("b_end")))
    g = m.groupBy("gene").agg(F.sum("bp_covered").alias("overlap"), F.sum(F.col("end") - F.col("start")).alias("cds_bp"))
    return g.withColumn("share", F.col("overlap") / F.col("cds_bp"))


def without_repeat_genes(cds: DataFrame, repeats: DataFrame, ratio: float = 0.8, ignore: Sequence[str] = ()) -> DataFrame:
    return repeat_share(cds, repeats, ignore).where(F.col("share") < ratio)


def neighbours(regions: DataFrame, threshold: int) -> DataFrame:
    """Pairs of different regions of a gene and chromosome of which some ends lie within ``threshold``: ``start, end,
    other_start, other_end``. Regions closer than the threshold after widening them are the only candidates."""
    r, at = regions.select("chrom", "gene", "start", "end").distinct(), lambda c: F.floor(F.col(c) / (threshold + 1))
    around = F.array(*(at(c) + d for c in ("start", "end") for d in (-1, 0, 1)))
    a = r.select("*", at("start").alias("_s"), at("end").alias("_e"), F.explode(F.array_distinct(around)).alias("b")).alias("a")
    b = r.select("*", at("start").alias("_s"), F.explode(F.array_distinct(F.array(at("start"), at("end")))).alias("b")).alias("b")
    on = (F.col("a.chrom") == F.col("b.chrom")) & (F.col("a.gene") == F.col("b.gene")) & (F.col("a.b") == F.col("b.b"))
    near = F.lit(False)
    for x in ("start", "end"):
        for y in ("start", "end"):
            near = near | (F.abs(F.col(f"a.{x}") - F.col(f"b.{y}")) <= threshold)
    on = on & near & ((F.col("a.start") != F.col("b.start")) | (F.col("a.end") != F.col("b.end")))
    # a pair that meets in two bins counts in that of the other's start
    far = (F.abs(F.col("b._s") - F.col("a._s")) > 1) & (F.abs(F.col("b._s") - F.col("a._e")) > 1)
    on = on & ((F.col("b.b") == F.col("b._s")) | far)
    return a.join(b, on).select("a.chrom", "a.gene", "a.start", "a.end", F.col("b.start").alias("other_start"), F.col("b.end").alias("other_end"))


def _names(col: str) -> Column:
    return F.array_join(F.sort_array(F.collect_set(col)), ", ")


def _runs(t: DataFrame, by: list[str], new, order: list[str], size: int = 4096) -> DataFrame:
    """``cluster``: how many rows up to the current one, in the total order of ``order`` within ``by``, begin a run (``new``)."""
    t = carried(t.withColumn("_new", new.cast("long")), by, F.col("start"), size, {"_before": F.sum("_new")})
    return t.withColumn("cluster", F.coalesce("_before", F.lit(0).cast("long")) + F.sum("_new").over(within(by, *order))).drop("_new", "_before", "_range")


#: Groups of at most so many rows are ordered whole, in one task.
WHOLE = 100_000


def region_clusters(regions: DataFrame, genes: DataFrame, threshold: int, parity: bool = False) -> DataFrame:
    """Protein regions (``chrom, start, end, strand, prot``) joined within their gene while the next begins within
    ``threshold`` of what was reached; proteins without a gene in ``genes`` (``transcript_id``, ``gene_id``) are their own:
    ``chrom, gene, strand, proteins, start, end``.

    With ``parity``, only the row before counts, as in a pass over sorted rows: a region begins a run if its start is
    further than ``threshold`` from that row's end, on either side. Long regions then don't reach past their successor."""
    r = regions.join(genes, F.col("prot") == F.col("transcript_id"), "left").withColumn("gene", F.coalesce("gene_id", "prot"))
    r, by = written(r.select("chrom", "gene", "strand", "prot", "start", "end").distinct(), "regions"), ["chrom", "gene"]
    order = ["start", "end", "prot", "strand"]
    if r.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > WHOLE).isEmpty():
        # ranges within so many small groups would be as many as the rows: a group is shuffled once for all its windows
        w = Window.partitionBy(*by).orderBy(*(order if parity else order[:2]))
        up = Window.unboundedPreceding, Window.currentRow
        if parity:
            new, to_here = F.abs(F.col("start") - F.lag("end").over(w)) > threshold, w.rowsBetween(*up)
        else:
            new, to_here = F.col("start") > F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1)) + threshold, w.rangeBetween(*up)
        k = r.withColumn("_new", F.coalesce(new, F.lit(True)).cast("long")).withColumn("cluster", F.sum("_new").over(to_here)).drop("_new")
    elif parity:
        r = written(previous(r, by, F.col("start"), order, "end", 4096), "before")
        k = _runs(r, by, F.coalesce(F.abs(F.col("start") - F.col("_previous")) > threshold, F.lit(True)), order)
    else:
        k = clusters(r, by, threshold)
    return k.groupBy("chrom", "gene", "strand", "cluster").agg(_names("prot").alias("proteins"), F.min("start").alias("start"), F.max("end").alias("end")).drop("cluster")


def overlapping_regions(groups: DataFrame, parity: bool = False) -> DataFrame:
    """Groups of different genes that overlap, joined: ``chrom, strand, genes, start, end``. With ``parity``, groups are joined
    while the next begins at or before the end of the group right before it, whatever came earlier."""
    groups = written(groups, "groups")
    if parity:
        order = ["start", "end", "gene", "strand", "proteins"]
        g = written(previous(groups, ["chrom"], F.col("start"), order, "end", 4096), "before")
        k = _runs(g, ["chrom"], F.coalesce(F.col("start") > F.col("_previous"), F.lit(True)), order)
    else:
        k = clusters(groups, ["chrom"])
    return k.groupBy("chrom", "strand", "cluster").agg(_names("gene").alias("genes"), F.min("start").alias("start"), F.max("end").alias("end")).drop("cluster")


def best_region(hits: DataFrame) -> DataFrame:
    """One alignment per protein: the lowest rank, then the highest score, then the first line."""
    return first_by(hits, "prot", F.asc_nulls_last("rank"), F.desc_nulls_last("score"), F.asc("line_no"))


def merge_partitions(genes: DataFrame, parts: DataFrame) -> DataFrame:
    """Predictions of overlapping segments of sequences, as one set of genes: ``seqid, strand, start, end, part``.

    ``genes``: ``seqid, part, line_no, strand, start, end`` in segment coordinates (closed); ``parts``: ``seqid, part, offset,
    overlap``. Of equal genes the first segment's stays. The outermost genes of a segment (of the first one, only its
    last) go if they overlap any other gene, and then those that begin in a segment's overlap zone if they overlap a
    gene that is left. Sequences of one segment stay as they are."""
    many = parts.groupBy("seqid").agg(F.count(F.lit(1)).alias("_parts"), F.min("part").alias("_first"))
    g = genes.join(parts.join(many, "seqid"), ["seqid", "part"]).withColumn("zone", (F.col("start") <= F.col("overlap")) & (F.col("part") > F.col("_first")))
    g = g.withColumn("start", F.col("start") + F.col("offset")).withColumn("end", F.col("end") + F.col("offset"))
    key = ["seqid", "strand", "start", "end"]
    by = Window.partitionBy("seqid", "part")
    first, last = F.min("line_no").over(by), F.max("line_no").over(by)
    g = g.withColumn("margin", (F.col("line_no") == last) | ((F.col("line_no") == first) & (F.col("part") > F.col("_first"))))
    one = g.groupBy(*key).agg(F.min("part").alias("part"), F.bool_or("margin").alias("margin"), F.min_by("zone", F.struct("part", "line_no")).alias("zone"), F.max("_parts").alias("_parts"))

    def crowded(some: DataFrame, among: DataFrame) -> DataFrame:
        """Those of a few genes that overlap another one."""
        other = among.select("seqid", F.col("strand").alias("_strand"), F.col("start").alias("b_start"), F.col("end").alias("b_end"))
        met = overlap_join(some.select(*key), other, ["seqid"], bin_size=256, closed=True)
        return met.where((F.col("start") != F.col("b_start")) | (F.col("end") != F.col("b_end")) | (F.col("strand") != F.col("_strand"))).select(*key).distinct()

    left = one.join(crowded(one.where("_parts > 1 AND margin"), one), key, "left_anti")
    return left.join(crowded(left.where("_parts > 1 AND zone"), left), key, "left_anti").select(*key, "part")
