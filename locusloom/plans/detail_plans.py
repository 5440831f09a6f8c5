"""Queries over pseudogene rules fed from joins, depth of protein alignments, and features numbered within their model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ends
from ..operators import evidence as ev
from ..sources import gff3
from .adapters import read
from .evidence_plans import EV, evidence
from .tree_plans import GFF_SQL, gff


def pseudogenes_from_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudogene reasons from alignments with frame shifts (items) and from the exons of the best hit's transcript (orders)."""
    l, o = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "orders")
    t = evidence(spark, sf_dir).withColumn("protected", F.col("transcript_id") % 17 == 0)
    chrom = lambda c: F.concat(F.lit("c"), (F.col(c) % 5).cast("string")).alias("chrom")
    start = F.col("transcript_id") * 613 % 400_000
    places = t.select("transcript_id", chrom("transcript_id"), start.alias("start"), (start + 300).alias("end"))
    at = F.col("l_orderkey") * 29 % 400_000
    shifted = l.where((F.col("l_suppkey") * 7 + F.col("l_linenumber")) % 9 > 0).select(chrom("l_partkey"), at.alias("b_start"), (at + F.col("l_quantity").cast("long")).alias("b_end"))
    hits = l.select(F.col("l_partkey").alias("query"), F.col("l_suppkey").alias("subject"), "l_extendedprice", "l_orderkey", "l_linenumber")
    best = ev.first_by(hits, "query", F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber")).select("query", "subject")
    proteins = o.select((F.col("o_orderkey") % 120).alias("protein"), F.col("o_orderkey").alias("transcript"), F.col("o_orderkey").alias("line_no"))
    fed = ev.pseudogene_evidence(t, places, shifted, best, proteins, l.select(F.col("l_orderkey").alias("transcript")))
    return ev.pseudogene_reason(fed, tpm_cutoff=5.0, support=4).select("transcript_id", "frameshifts", "subject_exons", "reason")


def protein_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of depth of coding rows."""
    return gff3.protein_depth(gff(spark, sf_dir))


def depth_of_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The depth of protein alignments at the start of every order's item."""
    t = gff(spark, sf_dir)
    at = t.where("type = 'exon'").select("line_no", "seqid", F.col("start").alias("position"))
    return gff3.with_depth(at, gff3.protein_depth(t), "depth").select("line_no", "depth")


def numbered_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exons, coding parts, introns and untranslated pieces of models, numbered and in order; coding parts with a score keep it."""
    l = read(spark, sf_dir, "lineitem")
    start = F.col("l_linenumber").cast("long") * 100 + F.col("l_partkey") % 150
    t = l.select(F.col("l_orderkey").cast("string").alias("mrna"), "l_linenumber", start.alias("start"), (start + F.col("l_quantity").cast("long") * 2).alias("end"), "l_suppkey")
    models = t.select("mrna").distinct().select("mrna", F.lit("s").alias("seqid"), F.when(F.col("mrna").cast("long") % 2 == 0, "+").otherwise("-").alias("strand"))
    coding = F.col("l_linenumber").isin(1, 3, 7)
    cds, given = t.where(coding).select("mrna", "start", "end"), t.where(~coding).select("mrna", "start", "end")
    exons, introns = ends.repaired_exons(cds, given)
    utrs = ends.outside(cds, exons, models)
    parts = utrs.unionByName(exons.withColumn("type", F.lit("exon"))).unionByName(introns.withColumn("type", F.lit("intron"))).unionByName(cds.withColumn("type", F.lit("CDS"))).repartition("mrna").distinct()  # repeats are found where their model is
    known = t.where(coding).join(models, "mrna").select("mrna", "seqid", "strand", F.lit("CDS").alias("type"), "start", "end", F.col("l_suppkey").cast("double").alias("score"), F.concat(F.lit(" ID=x;Note="), F.col("l_suppkey").cast("string"), F.lit(";parent=y;;")).alias("attributes"), F.struct("l_suppkey", "l_linenumber").alias("line_no"))
    return ends.numbered(models, parts, known)


QUERIES = {f.__name__: f for f in (pseudogenes_from_joins, protein_depth, depth_of_positions, numbered_features)}
_DEPTH = """dv AS (SELECT seqid, "start" AS pos, 1 AS d FROM gff WHERE type = 'CDS' UNION ALL SELECT seqid, "end", -1 FROM gff WHERE type = 'CDS'), dp AS (SELECT seqid, pos, sum(d) AS d FROM dv GROUP BY 1, 2 HAVING sum(d) <> 0),
  dr AS (SELECT seqid, pos AS "start", lead(pos) OVER (PARTITION BY seqid ORDER BY pos) AS "end", (sum(d) OVER (PARTITION BY seqid ORDER BY pos))::BIGINT AS depth FROM dp)"""
ORACLES = {
    "pseudogenes_from_joins": f"""WITH {EV}, pl AS (SELECT transcript_id, transcript_id % 5 AS c, transcript_id * 613 % 400000 AS s FROM ev), sh AS (SELECT l_partkey % 5 AS c, l_orderkey * 29 % 400000 AS s, l_orderkey * 29 % 400000 + l_quantity::BIGINT AS e FROM lineitem WHERE (l_suppkey * 7 + l_linenumber) % 9 > 0),
      fs AS (SELECT transcript_id, count(*) AS n FROM pl JOIN sh ON pl.c = sh.c AND pl.s <= sh.e AND sh.s <= pl.s + 300 GROUP BY 1), b AS (SELECT l_partkey AS query, arg_min(l_suppkey, {{'a': -l_extendedprice, 'b': l_orderkey, 'c': l_linenumber}}) AS subject FROM lineitem GROUP BY 1),
      m AS (SELECT o_orderkey % 120 AS protein, min(o_orderkey) AS transcript FROM orders GROUP BY 1), x AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1), h AS (SELECT query, CASE WHEN protein IS NOT NULL THEN coalesce(n, 0) END AS exons FROM b LEFT JOIN m ON protein = subject LEFT JOIN x ON l_orderkey = transcript),
      f AS (SELECT ev.*, coalesce(n, 0) AS frameshifts, exons AS subject_exons FROM ev LEFT JOIN fs USING (transcript_id) LEFT JOIN h ON query = transcript_id)
      SELECT transcript_id, frameshifts, subject_exons, CASE WHEN transcript_id % 17 = 0 THEN NULL WHEN frameshifts >= 4 AND coalesce(tpm, 0) < 5 AND pfam IS NULL THEN 'B' WHEN single_exon AND subject_exons >= 2 AND coalesce(tpm, 0) < 5 AND pfam IS NULL THEN 'C'
        WHEN coalesce(tpm, 0) = 0 AND pfam IS NULL AND coalesce(coverage, 0) < 0.5 AND blast_pident IS NOT NULL THEN 'A' END AS reason FROM f""",
    "protein_depth": f"WITH {GFF_SQL}, {_DEPTH} SELECT * FROM dr WHERE depth > 0",
    "depth_of_positions": f"""WITH {GFF_SQL}, {_DEPTH}, p AS (SELECT line_no, seqid, "start" - 1 AS pos FROM gff WHERE type = 'exon') SELECT line_no, CASE WHEN pos < dr."end" THEN coalesce(depth, 0) ELSE 0 END AS depth FROM p ASOF LEFT JOIN dr ON dr.seqid = p.seqid AND dr."start" <= p.pos""",
    "numbered_features": """WITH t AS (SELECT l_orderkey AS mrna, l_linenumber IN (1, 3, 7) AS cds, l_linenumber * 100 + l_partkey % 150 AS s, l_linenumber * 100 + l_partkey % 150 + l_quantity::BIGINT * 2 AS e, l_suppkey AS sup, l_linenumber AS ln FROM lineitem), c0 AS (SELECT mrna, s, e FROM t WHERE cds),
      g AS (SELECT mrna, cds, e + 1 AS s, lead(s) OVER (PARTITION BY mrna, cds ORDER BY s, e) - 1 AS e FROM t), k AS (SELECT * FROM g WHERE e >= s),
      i AS (SELECT mrna, s, e FROM k WHERE cds UNION SELECT mrna, s, e FROM k a WHERE NOT cds AND NOT EXISTS (SELECT 1 FROM k b WHERE b.cds AND b.mrna = a.mrna AND b.s <= a.e AND b.e >= a.s)
        AND NOT EXISTS (SELECT 1 FROM k b WHERE NOT b.cds AND b.mrna = a.mrna AND b.s <= a.e AND b.e >= a.s AND b.s < a.s)),
      b AS (SELECT mrna, min(s) AS lo, max(e) AS hi FROM t GROUP BY 1), c AS (SELECT mrna, lo AS p, 0 AS o FROM b UNION ALL SELECT mrna, e + 1, 1 FROM i), f AS (SELECT mrna, hi AS p, 1 AS o FROM b UNION ALL SELECT mrna, s - 1, 0 FROM i),
      c1 AS (SELECT *, row_number() OVER (PARTITION BY mrna ORDER BY o, p) AS k FROM c), f1 AS (SELECT *, row_number() OVER (PARTITION BY mrna ORDER BY o, p) AS k FROM f), x AS (SELECT mrna, c1.p AS s, f1.p AS e FROM c1 JOIN f1 USING (mrna, k)),
      u AS (SELECT x.mrna, x.s, c0.s - 1 AS e FROM x JOIN c0 ON c0.mrna = x.mrna AND c0.e = x.e AND x.s < c0.s UNION ALL SELECT x.mrna, c0.e + 1, x.e FROM x JOIN c0 ON c0.mrna = x.mrna AND c0.s = x.s AND x.e > c0.e
        UNION ALL SELECT mrna, s, e FROM x WHERE NOT EXISTS (SELECT 1 FROM c0 WHERE c0.mrna = x.mrna AND c0.s <= x.e AND c0.e >= x.s)),
      mk AS (SELECT mrna, list_sort(list(DISTINCT p)) AS p FROM (SELECT mrna, s AS p FROM c0 UNION ALL SELECT mrna, e FROM c0) GROUP BY 1),
      ut AS (SELECT mrna, CASE WHEN mrna % 2 = 0 THEN CASE WHEN e <= p[1] THEN 'five_prime_UTR' WHEN s >= p[2] THEN 'three_prime_UTR' END ELSE CASE WHEN s >= p[2] THEN 'five_prime_UTR' WHEN e <= p[1] THEN 'three_prime_UTR' END END AS type, s, e FROM u JOIN mk USING (mrna)),
      pt AS (SELECT * FROM ut WHERE type IS NOT NULL UNION SELECT mrna, 'exon', s, e FROM x UNION SELECT mrna, 'intron', s, e FROM i UNION SELECT mrna, 'CDS', s, e FROM c0),
      nm AS (SELECT *, mrna % 2 = 1 AS minus, CASE type WHEN 'five_prime_UTR' THEN 1 WHEN 'exon' THEN 2 WHEN 'CDS' THEN 3 WHEN 'intron' THEN 4 ELSE 5 END AS rank, CASE type WHEN 'five_prime_UTR' THEN 'utr5p' WHEN 'three_prime_UTR' THEN 'utr3p' ELSE type END AS name FROM pt),
      nn AS (SELECT *, row_number() OVER (PARTITION BY mrna, type ORDER BY CASE WHEN minus AND NOT ends_with(type, '_UTR') THEN -s ELSE s END, e) AS k, row_number() OVER (PARTITION BY mrna ORDER BY CASE WHEN minus THEN -s ELSE s END, rank, e) AS place FROM nm),
      od AS (SELECT mrna, s, e, arg_max(sup, {'a': sup, 'b': ln}) AS sup FROM t WHERE cds GROUP BY 1, 2, 3)
      SELECT nn.mrna::VARCHAR AS mrna, place::INT AS place, 's' AS seqid, type, nn.s AS "start", nn.e AS "end", CASE WHEN type = 'CDS' THEN sup::DOUBLE END AS score, CASE WHEN minus THEN '-' ELSE '+' END AS strand,
        'ID=' || nn.mrna || '.' || name || k || ';Parent=' || nn.mrna || ';' || CASE WHEN type = 'CDS' THEN 'Note=' || sup || ';' ELSE '' END AS attributes FROM nn LEFT JOIN od ON od.mrna = nn.mrna AND od.s = nn.s AND od.e = nn.e AND type = 'CDS'""",
}
