"""Queries over evidence scoring, repeats, regions, partitions and tiling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import loci, scoring, tiling
from .adapters import hours, read
from .tree_plans import ITEM_SQL, gff

CDS_SQL = ITEM_SQL + """,
cd AS (SELECT seqid AS chrom, gene AS locus, gene, mrna, 's' || (p % 3) AS source, strand, "start", "end" FROM it WHERE type = 'CDS'),
ev AS (SELECT 'Chr' || (o_orderkey * 7 % 12 + 1) AS chrom, (date_diff('day', DATE '1992-01-01', o_orderdate::DATE) * 60)::BIGINT AS s, (date_diff('day', DATE '1992-01-01', o_orderdate::DATE) * 60 + 40)::BIGINT AS e, o_orderkey % 9 AS kind FROM orders)"""


def _days(col: str):
    return F.datediff(F.to_date(col), F.lit("1992-01-01").cast("date")).cast("long")


def cds(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = read(spark, sf_dir, "lineitem").where(F.col("l_linenumber").isin(1, 3, 7))
    start = _days("l_shipdate") * 60 + F.col("l_linenumber")
    k = F.col("l_orderkey").cast("string")
    gene = F.concat(F.lit("g"), k)
    mrna = F.concat(F.lit("m"), k, F.lit("."), (F.col("l_suppkey") % 5).cast("string"))
    return l.select(F.concat(F.lit("Chr"), (F.col("l_orderkey") % 12 + 1).cast("string")).alias("chrom"), gene.alias("locus"), gene.alias("gene"), mrna.alias("mrna"), F.concat(F.lit("s"), (F.col("l_partkey") % 3).cast("string")).alias("source"), F.when(F.col("l_linestatus") == "F", "+").otherwise("-").alias("strand"), start.alias("start"), (start + F.col("l_quantity").cast("long")).alias("end"))


def track(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    s = _days("o_orderdate") * 60
    return o.select(F.concat(F.lit("Chr"), (F.col("o_orderkey") * 7 % 12 + 1).cast("string")).alias("chrom"), s.alias("start"), (s + 40).alias("end"), (F.col("o_orderkey") % 9).alias("kind"))


def isoform_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log evidence of isoforms over all their bases, normalised by length."""
    s = scoring.isoform_scores(cds(spark, sf_dir), loci.depth_runs(track(spark, sf_dir), ["chrom"]))
    return s.select("source", "mrna", "locus", F.round("score", 4).alias("score"), "length", F.round("norm_score", 4).alias("norm_score"))


def selected_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The annotations of the best source of each locus."""
    c = cds(spark, sf_dir)
    s = scoring.isoform_scores(c, loci.depth_runs(track(spark, sf_dir), ["chrom"]))
    chosen = scoring.select_sources(s.withColumn("norm_score", F.round("norm_score", 4)))
    return scoring.selected_annotations(c, chosen).groupBy("locus", "source", "min_start").agg(F.count(F.lit(1)).alias("n"))


def repeat_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genes that stay after those mostly made of repeats go; two kinds of repeats don't count."""
    r = track(spark, sf_dir).select("chrom", "start", (F.col("end") - 1).alias("end"), F.when(F.col("kind") == 0, "Simple_repeat").when(F.col("kind") == 1, "Satellite").otherwise("LTR").alias("name"))
    out = scoring.without_repeat_genes(cds(spark, sf_dir), r, 0.8, ["Simple_repeat", "Satellite"])
    return out.select("gene", "overlap", "cds_bp", F.round("share", 6).alias("share"))


REGION_SQL = ITEM_SQL + """,
rg AS (SELECT seqid AS chrom, 'p' || p AS prot, strand, "start", "end", CASE WHEN p % 4 > 0 THEN 'G' || (p // 4) END AS gene_id FROM it), rr AS (SELECT DISTINCT chrom, coalesce(gene_id, prot) AS gene, strand, prot, "start", "end" FROM rg)"""


def _regions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    l = read(spark, sf_dir, "lineitem")
    start = _days("l_shipdate") * 60 + F.col("l_linenumber")
    prot = lambda c: F.concat(F.lit("p"), F.col(c).cast("string"))
    r = l.select(F.concat(F.lit("Chr"), (F.col("l_orderkey") % 12 + 1).cast("string")).alias("chrom"), prot("l_partkey").alias("prot"), F.when(F.col("l_linestatus") == "F", "+").otherwise("-").alias("strand"), start.alias("start"), (start + F.col("l_quantity").cast("long")).alias("end"))
    p = read(spark, sf_dir, "part")
    gene = F.when(F.col("p_partkey") % 4 > 0, F.concat(F.lit("G"), F.floor(F.col("p_partkey") / 4).cast("string")))
    return r, p.select(prot("p_partkey").alias("transcript_id"), gene.alias("gene_id"))


def region_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.region_clusters(*_regions(spark, sf_dir), 2000)


def overlapping_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of different genes that overlap; ten sequences stand for each chromosome."""
    groups = scoring.region_clusters(*_regions(spark, sf_dir), 60)
    return scoring.overlapping_regions(groups.withColumn("chrom", F.concat_ws(".", "chrom", F.right("gene", F.lit(1)))))


def regions_by_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions joined by what is right before them, and then groups of genes likewise."""
    groups = scoring.region_clusters(*_regions(spark, sf_dir), 60, parity=True)
    return scoring.overlapping_regions(groups.withColumn("chrom", F.concat_ws(".", "chrom", F.right("gene", F.lit(1)))), parity=True)


def region_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions of a gene with an end within the threshold of another's, counted."""
    r, g = _regions(spark, sf_dir)
    r = r.join(g, F.col("prot") == F.col("transcript_id"), "left").withColumn("gene", F.coalesce("gene_id", "prot"))
    return scoring.neighbours(r, 500).groupBy("chrom", "gene").agg(F.count(F.lit(1)).alias("n"))


def best_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One alignment of each protein by rank and score, with its bases cut from the text as sequence."""
    l = read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("prot"), (F.col("l_suppkey") % 3).alias("rank"), F.col("l_quantity").alias("score"), ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1000 + F.col("l_suppkey")).alias("line_no"))
    return scoring.best_region(l).select("prot", "rank", "score", "line_no")


PART_SQL = """
pg AS (SELECT 'q' || (l_orderkey % 40) AS seqid, l_suppkey % 4 AS part, (l_orderkey * 10 + l_linenumber) * 1000 + l_suppkey AS line_no, CASE WHEN l_linestatus = 'F' THEN '+' ELSE '-' END AS strand, (l_partkey * 37 % 20000 + 1)::BIGINT AS s, (l_partkey * 37 % 20000 + l_quantity * 3)::BIGINT AS e FROM lineitem),
g AS (SELECT seqid, part, line_no, strand, s <= 300 AND part > 0 AS zone, s + part * 19000 AS s, e + part * 19000 AS e FROM pg)"""


def merged_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One gene set from predictions of overlapping segments."""
    l = read(spark, sf_dir, "lineitem")
    at = F.col("l_partkey") * 37 % 20000
    g = l.select(F.concat(F.lit("q"), (F.col("l_orderkey") % 40).cast("string")).alias("seqid"), (F.col("l_suppkey") % 4).alias("part"), ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1000 + F.col("l_suppkey")).alias("line_no"), F.when(F.col("l_linestatus") == "F", "+").otherwise("-").alias("strand"), (at + 1).alias("start"), (at + F.col("l_quantity") * 3).cast("long").alias("end"))
    parts = g.select("seqid", "part").distinct().select("seqid", "part", (F.col("part") * 19000).alias("offset"), F.lit(300).alias("overlap"))
    return scoring.merge_partitions(g, parts)


def sequence_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles of at most 3000 positions that end in uncovered stretches, or where depth is least."""
    t = track(spark, sf_dir).select(F.col("chrom").alias("seqid"), (F.col("start") + 1).alias("start"), F.col("end").alias("end"))
    lengths = t.groupBy("seqid").agg((F.max("end") + 500).alias("length"))
    runs = loci.depth_runs(t.withColumn("end", F.col("end") + 1), ["seqid"])
    return tiling.tiles(lengths, loci.gaps(t, ["seqid"], 50, lengths), loci.depth_profile(runs, lengths, ["seqid"], 100), span=3000, width=100, reach=1000)


def depth_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The least depth of every window of 100 positions."""
    t = track(spark, sf_dir).select("chrom", (F.col("start") + 1).alias("start"), (F.col("end") + 1).alias("end"))
    lengths = t.groupBy("chrom").agg((F.max("end") + 500).alias("length"))
    return loci.depth_profile(loci.depth_runs(t, ["chrom"]), lengths, ["chrom"], 100)


def uncovered_stretches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of 25 positions and more without evidence of a kind, up to both ends of the sequence."""
    t = track(spark, sf_dir).select(F.concat_ws(".", "chrom", "kind").alias("chrom"), (F.col("start") + 1).alias("start"), "end")
    return loci.gaps(t, ["chrom"], 25, t.groupBy("chrom").agg((F.max("end") + 500).alias("length")))


def read_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cuts of each sequence at the emptiest window near the ideal places."""
    t = track(spark, sf_dir).select(F.col("chrom").alias("seqid"), (F.col("start") + F.col("kind") * 7).alias("pos"))
    bounds = t.groupBy("seqid").agg(F.min("pos").alias("lo"), (F.max("pos") + 1).alias("hi"))
    return tiling.cuts(bounds, tiling.start_bins(t, bounds, 50), 50, 20_000)


def routed_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads per piece of their sequence; the last piece takes what lies beyond."""
    t = track(spark, sf_dir).select(F.col("chrom").alias("seqid"), (F.col("start") + 1).alias("pos"))
    lengths = t.groupBy("seqid").agg((F.max("pos") - 5000).alias("length"))
    s = tiling.segments(lengths, 10_000, 0).select("seqid", F.col("segment").alias("piece"), F.col("start").alias("lo"), (F.col("end") + 1).alias("hi"))
    return tiling.routed(t, s).groupBy("seqid", "piece").agg(F.count(F.lit(1)).alias("n"))


def predictor_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping windows of each sequence."""
    t = track(spark, sf_dir).groupBy(F.col("chrom").alias("seqid")).agg(F.max("end").alias("length"))
    return tiling.segments(t, 10_000, 600)


def coarse_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences (customers) above a threshold as bins of their own, the others first-fit; what each bin holds."""
    c = read(spark, sf_dir, "customer").select(F.concat(F.lit("scaf|"), F.col("c_custkey").cast("string")).alias("seqid"), (F.col("c_custkey") * 7919 % 10_007 + 1).alias("length"))
    b = tiling.coarse_bins(c, 9000).join(c, "seqid")
    return b.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("length"))


def segment_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depth of evidence that was dealt to overlapping segments and taken back: what it was before."""
    t = track(spark, sf_dir).select(F.col("chrom").alias("seqid"), (F.col("start") + 1).alias("start"), "end")
    pieces = tiling.segments(t.groupBy("seqid").agg(F.max("end").alias("length")), 10_000, 600)
    back = tiling.taken_back(tiling.dealt(t, pieces, 9400), pieces)
    return loci.depth_runs(back.withColumn("end", F.col("end") + 1), ["seqid"])


def segment_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence per segment, in coordinates of the segment."""
    t = track(spark, sf_dir).select(F.col("chrom").alias("seqid"), (F.col("start") + 1).alias("start"), "end")
    pieces = tiling.segments(t.groupBy("seqid").agg(F.max("end").alias("length")), 10_000, 600)
    one = F.count(F.lit(1))
    return tiling.dealt(t, pieces, 9400).groupBy("seqid", "segment").agg(one.alias("n"), F.sum("start").alias("starts"), F.sum("end").alias("ends"))


QUERIES = {f.__name__: f for f in (segment_depth, segment_evidence, isoform_scores, selected_sources, repeat_genes, region_clusters, overlapping_regions, regions_by_row, region_neighbours, best_region, merged_partitions, sequence_tiles, depth_windows, uncovered_stretches, read_cuts, routed_reads, predictor_segments, coarse_bins)}
_SCORES = CDS_SQL + """,
dp AS (SELECT chrom, pos, count(*) AS d FROM (SELECT chrom, unnest(range(s, e)) AS pos FROM ev) GROUP BY 1, 2), fb AS (SELECT source, mrna, locus, chrom, unnest(range("start", "end" + 1)) AS pos FROM cd),
sc AS (SELECT source, mrna, locus, sum(log10(coalesce(d, 0.01)) + 1) AS score FROM fb LEFT JOIN dp USING (chrom, pos) GROUP BY 1, 2, 3), ln AS (SELECT source, mrna, locus, sum("end" - "start")::BIGINT AS length FROM cd GROUP BY 1, 2, 3),
iso AS (SELECT source, mrna, locus, round(score, 4) AS score, length, round(score / nullif(length, 0), 4) AS norm_score FROM sc JOIN ln USING (source, mrna, locus))"""
_CLUSTERS = """cl AS (SELECT *, max("end") OVER (PARTITION BY chrom, gene ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM rr), c2 AS (SELECT *, sum(CASE WHEN m IS NULL OR "start" > m + {t} THEN 1 ELSE 0 END) OVER (PARTITION BY chrom, gene ORDER BY "start", "end" ROWS UNBOUNDED PRECEDING) AS k FROM cl),
gp AS (SELECT chrom, gene, strand, string_agg(DISTINCT prot, ', ' ORDER BY prot) AS proteins, min("start") AS "start", max("end") AS "end" FROM c2 GROUP BY chrom, gene, strand, k)"""
_LISTS = f"""{CDS_SQL}, ln AS (SELECT chrom, max(e) + 500 AS length FROM ev GROUP BY 1), dep AS (SELECT chrom, pos, count(*) AS d FROM (SELECT chrom, unnest(range(s + 1, e + 1)) AS pos FROM ev) GROUP BY 1, 2),
      x AS (SELECT chrom, s + 1 AS s, e FROM ev UNION ALL SELECT chrom, 0, 0 FROM ln UNION ALL SELECT chrom, length + 1, length + 1 FROM ln), y AS (SELECT chrom, max(e) OVER (PARTITION BY chrom ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 AS a, s - 1 AS b FROM x),
      gp AS (SELECT chrom, list({{'a': a, 'b': b}}) AS gaps FROM y WHERE b - a + 1 >= 50 GROUP BY 1), w AS (SELECT chrom, length, unnest(range(0, (length - 1) // 100 + 1)) AS bin FROM ln), c AS (SELECT chrom, (pos - 1) // 100 AS bin, min(d) AS low, count(*) AS seen FROM dep GROUP BY 1, 2),
      pr AS (SELECT chrom, list(CASE WHEN seen >= least(length, (bin + 1) * 100) - bin * 100 THEN low ELSE 0 END ORDER BY bin) AS depth FROM w LEFT JOIN c USING (chrom, bin) GROUP BY 1),
      sq AS MATERIALIZED (SELECT chrom, length, coalesce(gaps, []) AS gaps, depth FROM ln JOIN pr USING (chrom) LEFT JOIN gp USING (chrom))"""
ORACLES = {
    # one tile of every sequence in each step
    "sequence_tiles": f"""WITH RECURSIVE {_LISTS},
      t AS (SELECT chrom, 0::BIGINT AS tile, 1::BIGINT AS s, false AS fin FROM sq
        UNION ALL SELECT chrom, tile + 1, s, fin FROM (SELECT t.chrom, t.tile, cut.nxt AS s, cut.nxt > q.length AS fin FROM t JOIN sq q USING (chrom),
          LATERAL (SELECT CASE WHEN q.length - t.s < 3000 THEN q.length + 1 WHEN g IS NOT NULL THEN g + 1 ELSE greatest(least((high - (list_position(list_reverse(near), list_min(near)) - 1)) * 100 + 51, t.s + 2999), t.s) + 1 END AS nxt FROM
            (SELECT list_max(list_transform(list_filter(q.gaps, lambda z: z.a <= t.s + 2999 AND z.b >= t.s), lambda z: least(z.b, t.s + 2999))) AS g, (t.s + 2998) // 100 AS high, q.depth[(greatest(t.s, t.s + 2000) - 1) // 100 + 1:(t.s + 2998) // 100 + 1] AS near)) AS cut WHERE NOT t.fin) WHERE NOT fin)
      SELECT chrom AS seqid, tile, s AS "start", coalesce(lead(s) OVER (PARTITION BY chrom ORDER BY tile) - 1, length) AS "end" FROM t JOIN ln USING (chrom)""",
    "read_cuts": f"""WITH RECURSIVE {CDS_SQL}, t AS (SELECT chrom, s + kind * 7 AS pos FROM ev), b AS (SELECT chrom, min(pos) AS lo, max(pos) + 1 AS hi FROM t GROUP BY 1), n AS (SELECT chrom, (pos - lo) // 50 AS bin, count(*) AS n FROM t JOIN b USING (chrom) GROUP BY 1, 2),
      p AS (SELECT chrom, lo, hi, ceil((hi - lo) / 20000)::BIGINT AS parts, (hi - lo) / ceil((hi - lo) / 20000) AS piece FROM b), k AS (SELECT *, unnest(range(1, parts)) AS k FROM p), i AS (SELECT *, lo + floor(piece * k)::BIGINT AS ideal, floor(piece * 0.25)::BIGINT AS away FROM k),
      r AS (SELECT *, (greatest(lo + 1, ideal - away) - lo) // 50 AS ia, (least(hi - 1, ideal + away) - lo) // 50 AS ib FROM i), v AS (SELECT *, unnest(range(ia, ib + 1)) AS bin FROM r WHERE ib > ia),
      z AS (SELECT v.chrom, k, arg_min(v.bin, {{'a': coalesce(n, 0), 'b': abs(lo + v.bin * 50 - ideal), 'c': v.bin}}) AS best FROM v LEFT JOIN n ON n.chrom = v.chrom AND n.bin = v.bin GROUP BY 1, 2),
      y AS (SELECT r.chrom, r.k, hi, CASE WHEN best IS NULL THEN ideal ELSE lo + best * 50 + 25 END AS want FROM r LEFT JOIN z ON z.chrom = r.chrom AND z.k = r.k),
      c AS (SELECT chrom, k, least(want, hi - 1) AS cut FROM y WHERE k = 1 UNION ALL SELECT y.chrom, y.k, least(CASE WHEN want <= cut THEN cut + 50 ELSE want END, hi - 1) FROM c JOIN y ON y.chrom = c.chrom AND y.k = c.k + 1)
      SELECT chrom AS seqid, k::INT AS k, cut FROM c""",
    "coarse_bins": """WITH RECURSIVE c AS (SELECT 'scaf|' || c_custkey AS seqid, c_custkey * 7919 % 10007 + 1 AS length FROM customer), room AS (SELECT min(length) AS room FROM c WHERE length > 9000),
      s AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY length DESC, seqid) AS k FROM c WHERE length <= 9000),
      b AS (SELECT k, 0 AS bin, length AS used FROM s WHERE k = 1 UNION ALL SELECT s.k, CASE WHEN used + s.length <= room THEN bin ELSE bin + 1 END, CASE WHEN used + s.length <= room THEN used + s.length ELSE s.length END FROM b JOIN s ON s.k = b.k + 1, room),
      a AS (SELECT replace(seqid, '|', '_') AS bin, length FROM c WHERE length > 9000 UNION ALL SELECT 'small_' || b.bin, s.length FROM b JOIN s USING (k)) SELECT bin, count(*) AS n, sum(length)::BIGINT AS length FROM a GROUP BY 1""",
    "segment_depth": f"""WITH {CDS_SQL}, v AS (SELECT chrom, s AS pos, 1 AS d FROM ev UNION ALL SELECT chrom, e, -1 FROM ev), p AS (SELECT chrom, pos, sum(d) AS d FROM v GROUP BY 1, 2 HAVING sum(d) <> 0),
      r AS (SELECT chrom, pos, sum(d) OVER (PARTITION BY chrom ORDER BY pos) AS depth, lead(pos) OVER (PARTITION BY chrom ORDER BY pos) AS nxt FROM p) SELECT chrom AS seqid, pos + 1 AS "start", nxt + 1 AS "end", depth::BIGINT AS depth FROM r WHERE depth > 0""",
    "segment_evidence": f"""WITH {CDS_SQL}, ln AS (SELECT chrom, max(e) AS length FROM ev GROUP BY 1), g AS (SELECT chrom, length, unnest(range(1, greatest(1, length - 600) + 1, 9400)) AS lo FROM ln), h AS (SELECT chrom, ((lo - 1) // 9400)::INT AS segment, lo, least(lo + 9999, length) AS hi FROM g)
      SELECT h.chrom AS seqid, segment, count(*) AS n, sum(greatest(s + 1, lo) - lo + 1)::BIGINT AS starts, sum(least(e, hi) - lo + 1)::BIGINT AS ends FROM h JOIN ev ON ev.chrom = h.chrom AND s + 1 <= hi AND e >= lo GROUP BY 1, 2""",
    "isoform_scores": f"WITH {_SCORES} SELECT * FROM iso",
    "selected_sources": f"""WITH {_SCORES}, ch AS (SELECT locus, source FROM (SELECT *, row_number() OVER (PARTITION BY locus ORDER BY norm_score DESC NULLS LAST, source) AS rn FROM iso) WHERE rn = 1),
      w AS (SELECT locus, source, gene, min("start") OVER (PARTITION BY gene) AS min_start FROM cd JOIN ch USING (locus, source)) SELECT locus, source, min_start, count(*) AS n FROM w GROUP BY 1, 2, 3""",
    "repeat_genes": f"""WITH {CDS_SQL}, u AS (SELECT DISTINCT chrom, unnest(range(s, e)) AS pos FROM ev WHERE kind > 1), b AS (SELECT gene, chrom, unnest(range("start", "end" + 1)) AS pos FROM cd),
      c AS (SELECT gene, count(u.pos) AS overlap, count(*) AS cds_bp FROM b LEFT JOIN u USING (chrom, pos) GROUP BY 1) SELECT gene, overlap, cds_bp, round(overlap / cds_bp, 6) AS share FROM c WHERE overlap / cds_bp < 0.8""",
    "region_clusters": f"WITH {REGION_SQL}, {_CLUSTERS.format(t=2000)} SELECT * FROM gp",
    "overlapping_regions": f"""WITH {REGION_SQL}, {_CLUSTERS.format(t=60)}, gq AS (SELECT * REPLACE (chrom || '.' || right(gene, 1) AS chrom) FROM gp), h AS (SELECT *, max("end") OVER (PARTITION BY chrom ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM gq),
      h2 AS (SELECT *, sum(CASE WHEN m IS NULL OR "start" > m THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY "start", "end" ROWS UNBOUNDED PRECEDING) AS k2 FROM h) SELECT chrom, strand, string_agg(DISTINCT gene, ', ' ORDER BY gene) AS genes, min("start") AS "start", max("end") AS "end" FROM h2 GROUP BY chrom, strand, k2""",
    "regions_by_row": f"""WITH {REGION_SQL}, l1 AS (SELECT *, lag("end") OVER (PARTITION BY chrom, gene ORDER BY "start", "end", prot, strand) AS b FROM rr), l2 AS (SELECT *, sum(CASE WHEN b IS NULL OR abs("start" - b) > 60 THEN 1 ELSE 0 END) OVER (PARTITION BY chrom, gene ORDER BY "start", "end", prot, strand) AS k FROM l1),
      gp AS (SELECT chrom || '.' || right(gene, 1) AS chrom, gene, strand, string_agg(DISTINCT prot, ', ' ORDER BY prot) AS proteins, min("start") AS "start", max("end") AS "end" FROM l2 GROUP BY l2.chrom, gene, strand, k),
      h AS (SELECT *, lag("end") OVER (PARTITION BY chrom ORDER BY "start", "end", gene, strand, proteins) AS b FROM gp), h2 AS (SELECT *, sum(CASE WHEN b IS NULL OR "start" > b THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY "start", "end", gene, strand, proteins) AS k FROM h)
      SELECT chrom, strand, string_agg(DISTINCT gene, ', ' ORDER BY gene) AS genes, min("start") AS "start", max("end") AS "end" FROM h2 GROUP BY chrom, strand, k""",
    "region_neighbours": f"""WITH {REGION_SQL}, d AS (SELECT DISTINCT chrom, gene, "start" AS s, "end" AS e FROM rr)
      SELECT a.chrom, a.gene, count(*) AS n FROM d a JOIN d b ON a.chrom = b.chrom AND a.gene = b.gene AND (a.s <> b.s OR a.e <> b.e) AND (abs(a.s - b.s) <= 500 OR abs(a.s - b.e) <= 500 OR abs(a.e - b.s) <= 500 OR abs(a.e - b.e) <= 500) GROUP BY 1, 2""",
    "best_region": "SELECT prot, rank, score, line_no FROM (SELECT l_partkey AS prot, l_suppkey % 3 AS rank, l_quantity AS score, (l_orderkey * 10 + l_linenumber) * 1000 + l_suppkey AS line_no, row_number() OVER (PARTITION BY l_partkey ORDER BY l_suppkey % 3, l_quantity DESC, (l_orderkey * 10 + l_linenumber) * 1000 + l_suppkey) AS rn FROM lineitem) WHERE rn = 1",
    "merged_partitions": f"""WITH {PART_SQL}, np AS (SELECT seqid, count(DISTINCT part) AS parts, min(part) AS f FROM g GROUP BY 1), m AS (SELECT g.*, parts, line_no = max(line_no) OVER (PARTITION BY seqid, part) OR (line_no = min(line_no) OVER (PARTITION BY seqid, part) AND part > f) AS margin FROM g JOIN np USING (seqid)),
      o AS (SELECT seqid, strand, s, e, min(part) AS part, bool_or(margin) AS margin, arg_min(zone, {{'a': part, 'b': line_no}}) AS zone, max(parts) AS parts FROM m GROUP BY 1, 2, 3, 4),
      l AS (SELECT * FROM o WHERE NOT (parts > 1 AND margin AND EXISTS (SELECT 1 FROM o x WHERE x.seqid = o.seqid AND x.s <= o.e AND o.s <= x.e AND (x.s <> o.s OR x.e <> o.e OR x.strand <> o.strand))))
      SELECT seqid, strand, s AS "start", e AS "end", part FROM l WHERE NOT (parts > 1 AND zone AND EXISTS (SELECT 1 FROM l x WHERE x.seqid = l.seqid AND x.s <= l.e AND l.s <= x.e AND (x.s <> l.s OR x.e <> l.e OR x.strand <> l.strand)))""",
    "depth_windows": f"""WITH {CDS_SQL}, b AS (SELECT chrom, pos, count(*) AS d FROM (SELECT chrom, unnest(range(s + 1, e + 1)) AS pos FROM ev) GROUP BY 1, 2), ln AS (SELECT chrom, max(e) + 501 AS length FROM ev GROUP BY 1), w AS (SELECT chrom, length, unnest(range(0, (length - 1) // 100 + 1)) AS bin FROM ln),
      c AS (SELECT chrom, (pos - 1) // 100 AS bin, min(d) AS low, count(*) AS seen FROM b GROUP BY 1, 2) SELECT chrom, bin, CASE WHEN seen >= least(length, (bin + 1) * 100) - bin * 100 THEN low ELSE 0 END AS depth FROM w LEFT JOIN c USING (chrom, bin)""",
    "uncovered_stretches": f"""WITH {CDS_SQL}, t AS (SELECT chrom || '.' || kind AS chrom, s + 1 AS s, e FROM ev), ln AS (SELECT chrom, max(e) + 500 AS length FROM t GROUP BY 1), x AS (SELECT chrom, s, e FROM t UNION ALL SELECT chrom, 0, 0 FROM ln UNION ALL SELECT chrom, length + 1, length + 1 FROM ln),
      y AS (SELECT chrom, max(e) OVER (PARTITION BY chrom ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 AS gap_start, s - 1 AS gap_end FROM x) SELECT * FROM y WHERE gap_end - gap_start + 1 >= 25""",
    "routed_reads": f"""WITH {CDS_SQL}, t AS (SELECT chrom AS seqid, s + 1 AS pos FROM ev), ln AS (SELECT seqid, max(pos) - 5000 AS length FROM t GROUP BY 1), p AS (SELECT seqid, unnest(range(0, (length - 1) // 10000 + 1)) AS piece, length FROM ln)
      SELECT t.seqid, piece::INT AS piece, count(*) AS n FROM t JOIN p ON p.seqid = t.seqid AND piece = least((pos - 1) // 10000, (length - 1) // 10000) GROUP BY 1, 2""",
    "predictor_segments": f"""WITH {CDS_SQL}, ln AS (SELECT chrom AS seqid, max(e) AS length FROM ev GROUP BY 1), s AS (SELECT seqid, length, unnest(range(1, greatest(1, length - 600) + 1, 9400)) AS "start" FROM ln)
      SELECT seqid, (("start" - 1) // 9400)::INT AS segment, "start", least("start" + 9999, length) AS "end" FROM s""",
}
