"""Queries over merging and refining gene models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import merge
from .adapters import read

#: Genes of two sets, with protein hits. Positions are spread so that a gene meets a few of the other set.
SETS_SQL = """
a AS (SELECT 'a' || o_orderkey AS gene, 'c' || (o_orderkey % 7) AS chrom, CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand, (o_orderkey * 37 % 900000)::BIGINT AS s, (o_orderkey * 37 % 900000 + 100 + o_custkey % 400)::BIGINT AS e, (o_custkey % 6)::BIGINT AS n_cds, CASE WHEN o_orderkey % 5 > 0 THEN pow(7.0, -(o_custkey % 12)) END AS ev, (o_custkey % 90)::BIGINT AS len FROM orders),
b AS (SELECT 'b' || o_orderkey AS gene, 'c' || (o_orderkey % 7) AS chrom, CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand, ((o_orderkey * 37 + o_custkey % 300) % 900000)::BIGINT AS s, ((o_orderkey * 37 + o_custkey % 300) % 900000 + 100 + o_custkey * 7 % 900)::BIGINT AS e, (o_custkey % 5)::BIGINT AS n_cds, CASE WHEN o_orderkey % 6 > 0 THEN pow(7.0, -(o_custkey % 11)) END AS ev, (o_custkey % 80)::BIGINT AS len, o_orderkey AS line_no FROM orders)"""


def _sets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    o = read(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    place = [F.concat(F.lit("c"), (k % 7).cast("string")).alias("chrom"), F.when(k % 2 == 0, "+").otherwise("-").alias("strand")]
    base = F.lit(7.0)
    sa, sb = k * 37 % 900_000, (k * 37 + c % 300) % 900_000
    a = o.select(F.concat(F.lit("a"), k.cast("string")).alias("gene"), *place, sa.alias("start"), (sa + 100 + c % 400).alias("end"), (c % 6).alias("n_cds"), F.when(k % 5 > 0, F.pow(base, -(c % 12))).alias("evalue"), (c % 90).alias("length"))
    b = o.select(F.concat(F.lit("b"), k.cast("string")).alias("gene"), *place, sb.alias("start"), (sb + 100 + c * 7 % 900).alias("end"), (c % 5).alias("n_cds"), F.when(k % 6 > 0, F.pow(base, -(c % 11))).alias("evalue"), (c % 80).alias("length"), k.alias("line_no"))
    hit = lambda t: t.where("evalue IS NOT NULL").select("gene", "evalue", "length")
    return a, b, hit(a), hit(b)


def merge_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_decisions(*_sets(spark, sf_dir))


def merged_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged set, and how many isoforms of replaced genes were grafted."""
    a, b, ha, hb = _sets(spark, sf_dir)
    a, ha = (t.withColumn("gene", F.when(F.pmod(F.substring("gene", 2, 20).cast("long"), F.lit(10)) == 0, F.concat(F.lit("b"), F.substring("gene", 2, 20))).otherwise(F.col("gene"))) for t in (a, ha))
    return merge.merged_genes(a, b, merge.merge_decisions(a, b, ha, hb))


def grafted_isoforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b, ha, hb = _sets(spark, sf_dir)
    mrnas = b.select("gene", F.concat("gene", F.lit(".t1")).alias("mrna"), "start", (F.col("start") + 150).alias("end")).unionByName(b.select("gene", F.concat("gene", F.lit(".t2")).alias("mrna"), (F.col("start") + 20).alias("start"), "end"))
    return merge.grafted(a, mrnas, merge.merge_decisions(a, b, ha, hb))


MODELS_SQL = """
gn AS (SELECT 'g' || o_orderkey AS gene, 'c' || (o_orderkey % 5) AS chrom, CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand, (o_orderkey * 131 % 4000000)::BIGINT AS s, (o_orderkey * 131 % 4000000 + 299)::BIGINT AS e FROM orders),
gc AS (SELECT gene, s + 20 * k AS s, s + 20 * k + 9 AS e FROM gn, (SELECT unnest([1, 5, 9]) AS k)),
al AS (SELECT 'x' || o_orderkey || '.' || r AS alt, ['helixer', 'augustus', 'miniprot'][r + 1] AS source, CASE WHEN r = 2 THEN (o_custkey % 10) / 10.0 END AS identity, r AS rank, 'c' || (o_orderkey % 5) AS chrom, CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand,
  (o_orderkey * 131 % 4000000 - (o_custkey % 3) * 40)::BIGINT AS s, (o_orderkey * 131 % 4000000 + 299 + (o_custkey % 7) * 30)::BIGINT AS e, o_custkey % 4 AS extra, (o_orderkey * 131 % 4000000)::BIGINT AS base FROM orders, (SELECT unnest([0, 1, 2]) AS r) WHERE (o_custkey + r) % 3 > 0),
ac AS (SELECT alt, base + 20 * k + (rank * extra) % 3 AS s, base + 20 * k + 11 + extra AS e FROM al, (SELECT unnest([1, 5, 9, 12, 15]) AS k) WHERE k < 12 OR k < 12 + extra * 2),
jn AS (SELECT DISTINCT chrom, CASE WHEN base % 3 = 0 THEN '.' ELSE strand END AS strand, base + 32 + extra + (base % 4) AS s, base + 99 AS e FROM al WHERE extra > 0 UNION SELECT DISTINCT chrom, strand, base + 112 + extra, base + 180 FROM al)"""


def _models(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    """Genes with three CDS each, up to three alternatives with three to five, and junctions between some of them."""
    o = read(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    base = k * 131 % 4_000_000
    place = [F.concat(F.lit("c"), (k % 5).cast("string")).alias("chrom"), F.when(k % 2 == 0, "+").otherwise("-").alias("strand")]
    genes = o.select(F.concat(F.lit("g"), k.cast("string")).alias("gene"), *place, base.alias("start"), (base + 299).alias("end"))
    gene_cds = genes.select("gene", "start", F.explode(F.array(*[F.lit(x) for x in (1, 5, 9)])).alias("k")).select("gene", (F.col("start") + 20 * F.col("k")).alias("start"), (F.col("start") + 20 * F.col("k") + 9).alias("end"))
    r = F.col("rank")
    three = o.select("*", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("rank")).where((c + r) % 3 > 0)
    alts = three.select(
        F.concat(F.lit("x"), k.cast("string"), F.lit("."), r.cast("string")).alias("alt"), F.element_at(F.array(F.lit("helixer"), F.lit("augustus"), F.lit("miniprot")), r + 1).alias("source"), F.when(r == 2, (c % 10) / 10).alias("identity"), "rank", *place,
        (base - (c % 3) * 40).alias("start"), (base + 299 + (c % 7) * 30).alias("end"), (c % 4).alias("extra"), base.alias("base"),
    )
    n = F.col("k")
    alt_cds = alts.select("alt", "base", "rank", "extra", F.explode(F.array(*[F.lit(x) for x in (1, 5, 9, 12, 15)])).alias("k")).where((n < 12) | (n < 12 + F.col("extra") * 2))
    alt_cds = alt_cds.select("alt", (F.col("base") + 20 * n + (F.col("rank") * F.col("extra")) % 3).alias("start"), (F.col("base") + 20 * n + 11 + F.col("extra")).alias("end"))
    j = alts.where("extra > 0").select("chrom", F.when(F.col("base") % 3 == 0, ".").otherwise(F.col("strand")).alias("strand"), (F.col("base") + 32 + F.col("extra") + F.col("base") % 4).alias("start"), (F.col("base") + 99).alias("end"))
    j = j.unionByName(alts.select("chrom", "strand", (F.col("base") + 112 + F.col("extra")).alias("start"), (F.col("base") + 180).alias("end"))).distinct()
    return genes, gene_cds, gene_cds.limit(0), alts, alt_cds, alt_cds.limit(0), j


def splice_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Introns of the alternatives that junctions support."""
    _, _, _, alts, cds, exons, j = _models(spark, sf_dir)
    return merge.splice_support(alts, exons, cds, j, "alt").select("alt", F.round("splice", 6).alias("splice"))


def truncated_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    genes, gene_cds, _, alts, cds, _, _ = _models(spark, sf_dir)
    return merge.truncated_by_any(genes, alts, gene_cds, cds)


def refined_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genes whose model an alternative replaces."""
    return merge.refinements(*_models(spark, sf_dir)).select("gene", "alt", F.round("composite", 6).alias("composite"))


def rebuilt_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of rebuilt models by type, with phases and UTRs."""
    genes, _, _, alts, cds, _, _ = _models(spark, sf_dir)
    chosen = genes.select("gene", F.concat(F.lit("x"), F.substring("gene", 2, 20), F.lit(".1")).alias("alt"))
    exons = cds.join(alts.where("extra > 0").select("alt", "extra").hint("merge"), "alt").select("alt", (F.col("start") - F.col("extra")).alias("start"), F.col("end").alias("end"))
    return merge.rebuilt(chosen, alts, cds, exons)


QUERIES = {f.__name__: f for f in (merge_decisions, merged_genes, grafted_isoforms, splice_support, truncated_genes, refined_genes, rebuilt_genes)}
_DEC = """bp AS (SELECT a.gene, arg_max(b.gene, {'x': (least(a.e, b.e) - greatest(a.s, b.s) + 1) / (a.e - a.s + 1), 'y': -b.line_no}) AS partner, max((least(a.e, b.e) - greatest(a.s, b.s) + 1) / (a.e - a.s + 1)) AS share FROM a JOIN b ON a.chrom = b.chrom AND a.strand = b.strand AND a.s <= b.e AND b.s <= a.e GROUP BY 1),
dc AS (SELECT a.gene, partner, CASE WHEN coalesce(share, 0) < 0.5 THEN 'rescued' WHEN NOT (b.e - b.s + 1 > 2 * (a.e - a.s + 1) OR (a.n_cds > 0 AND abs(b.n_cds - a.n_cds) > greatest(1.0, a.n_cds * 0.3))) THEN 'same'
  WHEN a.ev IS NULL AND b.ev IS NULL THEN 'tie' WHEN a.ev IS NULL THEN 'keeps_partner' WHEN b.ev IS NULL THEN 'replaces' WHEN a.ev * 10 < b.ev THEN 'replaces' WHEN b.ev * 10 < a.ev THEN 'keeps_partner' WHEN a.len > b.len * 1.1 THEN 'replaces' WHEN b.len > a.len * 1.1 THEN 'keeps_partner' ELSE 'tie' END AS status
  FROM a LEFT JOIN bp ON bp.gene = a.gene LEFT JOIN b ON b.gene = partner),
ds AS (SELECT gene, CASE WHEN status <> 'rescued' THEN partner END AS partner, status FROM dc)"""
_REFINE = MODELS_SQL + """,
gz AS (SELECT gene, count(*) AS n, sum(e - s + 1) AS bp FROM gc GROUP BY 1), az AS (SELECT alt, count(*) AS n, sum(e - s + 1) AS bp FROM ac GROUP BY 1),
pr AS (SELECT gn.gene, gn.s, gn.e, al.alt, al.source, al.identity, al.rank, al.s AS bs, al.e AS be FROM gn JOIN al ON gn.chrom = al.chrom AND gn.strand = al.strand AND gn.s <= al.e AND al.s <= gn.e
  WHERE (least(gn.e, al.e) - greatest(gn.s, al.s) + 1) / (gn.e - gn.s + 1) >= 0.3 AND (least(gn.e, al.e) - greatest(gn.s, al.s) + 1) / (al.e - al.s + 1) >= 0.3),
gb AS (SELECT gene, s AS p FROM gc UNION SELECT gene, e FROM gc), sh AS (SELECT gene, alt, count(*) AS n FROM (SELECT DISTINCT pr.gene, pr.alt, ac.s, ac.e FROM pr JOIN ac USING (alt) JOIN gb ON gb.gene = pr.gene AND (abs(ac.s - p) <= 10 OR abs(ac.e - p) <= 10)) GROUP BY 1, 2),
tr AS (SELECT DISTINCT pr.gene FROM pr JOIN gz USING (gene) JOIN az USING (alt) LEFT JOIN sh ON sh.gene = pr.gene AND sh.alt = pr.alt WHERE az.bp >= gz.bp * 1.2 AND (az.bp >= gz.bp * 1.5 OR ((pr.bs < pr.s - 100 OR pr.be > pr.e + 100) AND coalesce(sh.n, 0) >= 2) OR az.n >= gz.n + 2))"""
_SPLICE = """ix AS (SELECT alt, e + 1 AS s, lead(s) OVER (PARTITION BY alt ORDER BY s, e) - 1 AS e FROM ac), ii AS (SELECT ix.*, chrom, strand FROM ix JOIN al USING (alt) WHERE ix.e > ix.s),
ih AS (SELECT alt, count(*) AS n, count(*) FILTER (EXISTS (SELECT 1 FROM jn WHERE jn.chrom = ii.chrom AND jn.strand IN (ii.strand, '.') AND abs(jn.s - ii.s) <= 5 AND abs(jn.e - ii.e) <= 5)) AS hit FROM ii GROUP BY 1), sp AS (SELECT alt, coalesce(hit / n, 0.5) AS splice FROM al LEFT JOIN ih USING (alt))"""
ORACLES = {
    "merge_decisions": f"WITH {SETS_SQL}, {_DEC} SELECT * FROM ds",
    "merged_genes": f"""WITH {SETS_SQL.replace("'a' || o_orderkey AS gene", "(CASE WHEN o_orderkey % 10 = 0 THEN 'b' ELSE 'a' END) || o_orderkey AS gene")}, {_DEC}, rp AS (SELECT partner FROM ds WHERE status = 'replaces'),
      k AS (SELECT 'b' AS origin, gene, gene AS new_id FROM b WHERE gene NOT IN (SELECT partner FROM rp) UNION ALL SELECT 'a', gene, gene FROM ds WHERE status = 'replaces')
      SELECT * FROM k UNION ALL SELECT 'rescued', gene, CASE WHEN gene IN (SELECT gene FROM k) THEN gene || '.rescued' ELSE gene END FROM ds WHERE status = 'rescued'""",
    "grafted_isoforms": f"""WITH {SETS_SQL}, {_DEC}, m AS (SELECT gene, gene || '.t1' AS mrna, s, s + 150 AS e FROM b UNION ALL SELECT gene, gene || '.t2', s + 20, e FROM b)
      SELECT a.gene, m.mrna FROM ds JOIN a USING (gene) JOIN m ON m.gene = ds.partner WHERE status = 'replaces' AND m.s >= a.s AND m.e <= a.e""",
    "splice_support": f"WITH {MODELS_SQL}, {_SPLICE} SELECT alt, round(splice, 6) AS splice FROM sp",
    "truncated_genes": f"WITH {_REFINE} SELECT gene FROM tr",
    "refined_genes": f"""WITH {_REFINE}, {_SPLICE}, p2 AS (SELECT pr.* FROM pr JOIN tr USING (gene)),
      fo AS (SELECT DISTINCT p2.gene, p2.alt FROM p2 JOIN al USING (alt) JOIN gn o ON o.chrom = al.chrom AND o.strand = al.strand AND o.gene <> p2.gene AND (least(al.e, o.e) - greatest(al.s, o.s) + 1) / (o.e - o.s + 1) > 0.3 AND al.s <= o.e AND o.s <= al.e),
      cd AS (SELECT p2.* FROM p2 JOIN gz USING (gene) JOIN az USING (alt) WHERE az.bp > gz.bp AND coalesce(identity, 1.0) >= 0.4 AND NOT EXISTS (SELECT 1 FROM fo WHERE fo.gene = p2.gene AND fo.alt = p2.alt)),
      mm AS (SELECT x.alt, m.alt AS hit FROM (SELECT DISTINCT alt FROM cd) q JOIN al x USING (alt) JOIN al m ON m.source = 'miniprot' AND m.identity >= 0.4 AND m.chrom = x.chrom AND m.strand = x.strand AND m.s <= x.e AND x.s <= m.e AND (least(m.e, x.e) - greatest(m.s, x.s) + 1) / (x.e - x.s + 1) >= 0.2 AND (least(m.e, x.e) - greatest(m.s, x.s) + 1) / (m.e - m.s + 1) >= 0.2),
      mo AS (SELECT mm.alt, hit, sum(greatest(0, least(u.e, v.e) - greatest(u.s, v.s) + 1)) AS n FROM mm JOIN ac u ON u.alt = mm.alt JOIN ac v ON v.alt = mm.hit GROUP BY 1, 2), mp AS (SELECT alt, max(n) AS n FROM mo GROUP BY 1),
      bd AS (SELECT DISTINCT p2.gene, p2.alt, p2.source, side, pos FROM p2 JOIN (SELECT alt, 's' AS side, s AS pos FROM ac UNION ALL SELECT alt, 'e', e FROM ac) USING (alt)),
      xs AS (SELECT gene, alt, count(*) AS n, count(*) FILTER (EXISTS (SELECT 1 FROM bd o WHERE o.gene = bd.gene AND o.source <> bd.source AND o.side = bd.side AND abs(o.pos - bd.pos) <= 10)) AS hit FROM bd GROUP BY 1, 2),
      gi AS (SELECT gene, e + 1 AS s, lead(s) OVER (PARTITION BY gene ORDER BY s, e) - 1 AS e FROM gc), gj AS (SELECT gi.*, chrom, strand FROM gi JOIN gn USING (gene) WHERE gi.e > gi.s),
      gs AS (SELECT gene, count(*) FILTER (EXISTS (SELECT 1 FROM jn WHERE jn.chrom = gj.chrom AND jn.strand IN (gj.strand, '.') AND abs(jn.s - gj.s) <= 5 AND abs(jn.e - gj.e) <= 5)) / count(*) AS before FROM gj GROUP BY 1),
      sc AS (SELECT cd.*, splice, coalesce(mp.n, 0) / az.bp AS protein, xs.hit / xs.n AS cr, before FROM cd JOIN sp USING (alt) JOIN az USING (alt) LEFT JOIN mp USING (alt) JOIN xs ON xs.gene = cd.gene AND xs.alt = cd.alt JOIN gs ON gs.gene = cd.gene),
      fi AS (SELECT *, 0.4 * splice + 0.3 * protein + 0.3 * cr AS composite FROM sc WHERE (splice >= 0.3)::INT + (protein >= 0.3)::INT + (cr >= 0.3)::INT >= 2 AND splice >= before - 0.1),
      tp AS (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY round(composite, 9) DESC, rank, bs, be, alt) AS rn FROM fi) SELECT gene, alt, round(composite, 6) AS composite FROM tp WHERE rn = 1 AND composite >= 0.6 AND source <> 'miniprot'""",
    "rebuilt_genes": f"""WITH {MODELS_SQL}, ch AS (SELECT gn.gene, al.* FROM gn JOIN al ON al.alt = 'x' || gn.gene[2:] || '.1'), c AS (SELECT gene, strand, ac.s, ac.e FROM ch JOIN ac USING (alt)),
      ex AS (SELECT gene, strand, ac.s - extra AS s, ac.e FROM ch JOIN ac USING (alt)), sn AS (SELECT gene, min(s) AS lo, max(e) AS hi FROM c GROUP BY 1),
      ut AS (SELECT gene, CASE WHEN strand = '-' THEN 'three_prime_UTR' ELSE 'five_prime_UTR' END AS type, s, least(e, lo - 1) AS e, strand FROM ex JOIN sn USING (gene) WHERE s < lo UNION ALL SELECT gene, CASE WHEN strand = '-' THEN 'five_prime_UTR' ELSE 'three_prime_UTR' END, greatest(s, hi + 1), e, strand FROM ex JOIN sn USING (gene) WHERE e > hi)
      SELECT gene, t AS type, s AS "start", e AS "end", strand, NULL::INT AS phase, 1 AS number FROM ch, (SELECT unnest(['gene', 'mRNA']) AS t)
      UNION ALL SELECT gene, 'exon', s, e, strand, NULL, row_number() OVER (PARTITION BY gene ORDER BY s, e)::INT FROM ex
      UNION ALL SELECT gene, 'CDS', s, e, strand, ((3 - coalesce(sum(e - s + 1) OVER (PARTITION BY gene ORDER BY CASE WHEN strand = '-' THEN -s ELSE s END ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) % 3) % 3)::INT, row_number() OVER (PARTITION BY gene ORDER BY s, e)::INT FROM c
      UNION ALL SELECT gene, type, s, e, strand, NULL, row_number() OVER (PARTITION BY gene ORDER BY s, e)::INT FROM ut""",
}
