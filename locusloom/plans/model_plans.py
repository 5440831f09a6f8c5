"""Queries over gene models, attributes and sequences. A gene is an order, an mRNA an (order, supplier), its CDS the line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import attributes as at
from ..functions import sequences as sq
from ..operators import loci, models, sets
from .adapters import FEATURES_SQL, features, hours, read

#: Children: closed intervals of line items by order and supplier.
CDS_SQL = """
cds AS (SELECT l_orderkey AS gene, concat_ws('.', l_orderkey, l_suppkey % 5) AS mrna, CASE WHEN l_linestatus = 'F' THEN '+' ELSE '-' END AS strand, l_returnflag AS chrom, concat_ws('_', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS name,
  (date_diff('day', DATE '1995-01-01', l_shipdate::DATE) * 24 + l_linenumber)::BIGINT AS "start", (date_diff('day', DATE '1995-01-01', l_shipdate::DATE) * 24 + l_linenumber + l_quantity::BIGINT)::BIGINT AS "end" FROM lineitem)"""


def cds(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = read(spark, sf_dir, "lineitem")
    start = hours("l_shipdate") + F.col("l_linenumber")
    return l.select(
        F.col("l_orderkey").alias("gene"), F.concat_ws(".", "l_orderkey", (F.col("l_suppkey") % 5)).alias("mrna"), F.when(F.col("l_linestatus") == "F", "+").otherwise("-").alias("strand"), F.col("l_returnflag").alias("chrom"),
        F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("name"), start.alias("start"), (start + F.col("l_quantity").cast("long")).alias("end"),
    )


def overlapping_cds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.overlapping_cds(cds(spark, sf_dir))


def strand_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.strand_conflicts(cds(spark, sf_dir))


def chimera_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.chimeras(cds(spark, sf_dir), 4, 40).select("mrna", "exons", "bp")


def childless_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that no child on the plus strand names; the others name a model of the minus strand."""
    genes = read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("mrna"))
    return models.childless(genes, cds(spark, sf_dir).select(F.concat(F.col("gene").cast("string"), F.when(F.col("strand") == "+", "").otherwise(".minus")).alias("mrna")))


def phase_calc(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = cds(spark, sf_dir).groupBy("mrna", "start", "end").agg(F.min("strand").alias("strand"))
    one = c.join(c.groupBy("mrna").agg(F.min("strand").alias("st")), "mrna").select("mrna", "start", "end", F.col("st").alias("strand"))
    return models.phases(one).select("mrna", "start", "end", "phase")


def utr_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = cds(spark, sf_dir)
    spans = c.groupBy("mrna").agg((F.min("start") + 7).alias("cds_start"), (F.max("end") - 9).alias("cds_end"))
    return models.utrs(c.select("mrna", "strand", "start", "end"), spans).groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("end") - F.col("start") + 1).alias("bp"))


def isoform_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = cds(spark, sf_dir).groupBy("gene", "mrna").agg(F.min("start").alias("start"))
    return models.number_isoforms(m, "start", "mrna").select("gene", "mrna", "isoform")


def intron_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.introns(cds(spark, sf_dir)).groupBy("mrna").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("i_end") - F.col("i_start") + 1).alias("bp"))


def single_exon(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = cds(spark, sf_dir).groupBy("mrna").agg(F.count_if(F.col("strand") == "+").alias("n_exon"), F.count(F.lit(1)).alias("n_cds"))
    return g.select("mrna", models.single_exon().alias("single"))


def merge_winner(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part").select("p_partkey", F.expr("CASE WHEN p_partkey % 5 > 0 THEN (p_partkey * 7 % 50) / 1000.0D END").alias("ea"), F.expr("CASE WHEN p_partkey % 7 > 0 THEN (p_partkey * 11 % 50) / 1000.0D END").alias("eb"), (F.col("p_partkey") % 30).alias("la"), (F.col("p_partkey") * 3 % 31).alias("lb"))
    return p.select("p_partkey", models.pick_winner("ea", "eb", "la", "lb").alias("winner"))


def attr_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("GeneID=x;ID=g"), F.col("o_orderkey"), F.lit(";Name="), F.col("o_orderstatus"), F.lit(";Parent=a"), F.col("o_custkey"), F.lit(",b.t1;")).alias("attr"))
    return o.select("o_orderkey", at.attribute("attr", "ID").alias("id"), at.attribute("attr", "Gene").alias("gene"), at.replace_attribute("attr", "ID", F.lit("new")).alias("replaced"), at.drop_attribute("attr", "Name").alias("dropped"), F.element_at(at.attribute_map("attr"), "Name").alias("name"), F.array_join(F.transform(at.parents("attr"), lambda p: F.regexp_replace(p, r"\.t\d+$", "")), "|").alias("parents"), at.padded_id("OsaG", F.col("o_orderkey")).alias("padded"))


def revcomp(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select("doc_id", sq.clean_genome("text").alias("s"))
    s = F.regexp_replace("s", "N", "")
    d = d.select("doc_id", s.alias("s"))
    return d.select("doc_id", F.sha2(sq.reverse_complement("s"), 256).alias("rc"), sq.next_stop("s", F.lit(1)).cast("long").alias("stop"), sq.codon_at("s", F.lit(4)).alias("codon"))


def peptide_qc(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select("doc_id", F.regexp_replace("text", "[ .]", "*").alias("p"))
    return d.select("doc_id", sq.peptide_length("p").cast("long").alias("aa_len"), sq.has_internal_stop("p").alias("internal_stop"), (sq.peptide_length("p") < 100).cast("int").alias("short_orf"))


def locus_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = loci.clusters(cds(spark, sf_dir), ["chrom", "strand"])
    return k.groupBy("chrom", "strand", "cluster").agg(F.count(F.lit(1)).alias("n"), F.min("start").alias("start"), F.max("end").alias("end"))


def depth_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loci.depth_runs(features(spark, sf_dir), ["chrom", "strand"]).groupBy("chrom", "strand").agg(F.count(F.lit(1)).alias("runs"), F.max("depth").alias("deepest"), F.sum(F.col("depth") * (F.col("end") - F.col("start"))).alias("bases"))


def zero_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loci.gaps(cds(spark, sf_dir), ["chrom"], 10)


def evidence_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of each source (ship mode of the test data: the line number) in each locus (part), and the best of them."""
    l = read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("locus"), F.concat(F.lit("s"), F.col("l_linenumber")).alias("source"), (F.col("l_quantity") % 7).alias("depth"))
    s = l.groupBy("locus", "source").agg(F.round(F.sum(loci.log_evidence("depth")), 6).alias("score"))
    return loci.best_source(s).select("locus", "source", "score")


def ntile_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loci.split_evenly(read(spark, sf_dir, "orders").select("o_orderkey"), 7, "o_orderkey").groupBy("part").agg(F.count(F.lit(1)).alias("n"))


def mate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count_if(F.col("turn") % 2 == 0).alias("one"), F.count_if(F.col("turn") % 2 == 1).alias("two"))
    return c.agg(F.count_if(F.expr("one > 0 AND two > 0")).alias("pairs"), F.count_if(F.expr("one = 0 OR two = 0")).alias("orphans"), F.sum(F.greatest(F.col("one") - 1, F.lit(0)) + F.greatest(F.col("two") - 1, F.lit(0))).alias("dups"))


def dedup_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first id of each distinct sequence."""
    return sets.first_of_equal_texts(read(spark, sf_dir, "documents").select("doc_id", "text"), "text", "doc_id").select("doc_id")


QUERIES = {f.__name__: f for f in (overlapping_cds, strand_conflict, chimera_filter, childless_strict, phase_calc, utr_split, isoform_number, intron_lengths, single_exon, merge_winner, attr_parse, revcomp, peptide_qc, locus_clusters, depth_sweep, zero_gaps, evidence_score, ntile_split, mate_pairs, dedup_sequence)}
ORACLES = {
    "overlapping_cds": f'WITH {CDS_SQL}, x AS (SELECT mrna, "start" AS s, lag("end") OVER (PARTITION BY mrna ORDER BY "start", "end") AS p FROM cds) SELECT DISTINCT mrna FROM x WHERE s <= p',
    "strand_conflict": f"WITH {CDS_SQL} SELECT mrna, count(DISTINCT strand) AS strands FROM cds GROUP BY 1 HAVING count(DISTINCT strand) > 1",
    "chimera_filter": f'WITH {CDS_SQL} SELECT mrna, count(*) AS exons, sum("end" - "start" + 1)::BIGINT AS bp FROM cds GROUP BY 1 HAVING exons > 4 OR bp / 3 > 40',
    "childless_strict": f"WITH {CDS_SQL} SELECT o_orderkey::VARCHAR AS mrna FROM orders WHERE o_orderkey NOT IN (SELECT gene FROM cds WHERE strand = '+')",
    "phase_calc": f"""WITH {CDS_SQL}, u AS (SELECT DISTINCT mrna, "start", "end" FROM cds), m AS (SELECT mrna, min(strand) AS strand FROM cds GROUP BY 1)
      SELECT mrna, "start", "end", ((3 - coalesce(sum("end" - "start" + 1) OVER (PARTITION BY mrna ORDER BY CASE WHEN strand = '-' THEN -"start" ELSE "start" END, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) % 3) % 3)::INT AS phase FROM u JOIN m USING (mrna)""",
    "utr_split": f"""WITH {CDS_SQL}, sp AS (SELECT mrna, min("start") + 7 AS cs, max("end") - 9 AS ce FROM cds GROUP BY 1),
      u AS (SELECT CASE WHEN strand = '-' THEN 'three_prime_UTR' ELSE 'five_prime_UTR' END AS type, "start" AS s, least("end", cs - 1) AS e FROM cds JOIN sp USING (mrna)
        UNION ALL SELECT CASE WHEN strand = '-' THEN 'five_prime_UTR' ELSE 'three_prime_UTR' END, greatest("start", ce + 1), "end" FROM cds JOIN sp USING (mrna))
      SELECT type, count(*) AS n, sum(e - s + 1)::BIGINT AS bp FROM u WHERE s <= e GROUP BY 1""",
    "isoform_number": f'WITH {CDS_SQL}, m AS (SELECT gene, mrna, min("start") AS s FROM cds GROUP BY 1, 2) SELECT gene, mrna, row_number() OVER (PARTITION BY gene ORDER BY s, mrna)::INT AS isoform FROM m',
    "intron_lengths": f'WITH {CDS_SQL}, x AS (SELECT mrna, "end" + 1 AS a, lead("start") OVER (PARTITION BY mrna ORDER BY "start", "end") - 1 AS b FROM cds) SELECT mrna, count(*) AS n, sum(b - a + 1)::BIGINT AS bp FROM x WHERE b > a GROUP BY 1',
    "single_exon": f"WITH {CDS_SQL} SELECT mrna, CASE WHEN count(*) FILTER (strand = '+') > 0 THEN count(*) FILTER (strand = '+') ELSE count(*) END <= 1 AS single FROM cds GROUP BY 1",
    "merge_winner": """WITH x AS (SELECT p_partkey, CASE WHEN p_partkey % 5 > 0 THEN (p_partkey * 7 % 50) / 1000.0::DOUBLE END AS a, CASE WHEN p_partkey % 7 > 0 THEN (p_partkey * 11 % 50) / 1000.0::DOUBLE END AS b, p_partkey % 30 AS la, p_partkey * 3 % 31 AS lb FROM part)
      SELECT p_partkey, CASE WHEN a IS NULL AND b IS NULL THEN 'tie' WHEN b IS NULL THEN 'A' WHEN a IS NULL THEN 'B' WHEN a * 10 < b THEN 'A' WHEN b * 10 < a THEN 'B' WHEN la > lb * 1.1 THEN 'A' WHEN lb > la * 1.1 THEN 'B' ELSE 'tie' END AS winner FROM x""",
    "attr_parse": """SELECT o_orderkey, 'g' || o_orderkey AS id, NULL::VARCHAR AS gene, 'GeneID=x;ID=new;Name=' || o_orderstatus || ';Parent=a' || o_custkey || ',b.t1;' AS replaced,
      'GeneID=x;ID=g' || o_orderkey || ';Parent=a' || o_custkey || ',b.t1;' AS dropped, o_orderstatus AS name, 'a' || o_custkey || '|b' AS parents, 'OsaG' || lpad(o_orderkey::VARCHAR, greatest(7, strlen(o_orderkey::VARCHAR))::INT, '0') || '0' AS padded FROM orders""",
    "revcomp": """WITH d AS (SELECT doc_id, regexp_replace(upper(regexp_replace(text, '[^ATCGatcg]', 'N', 'g')), 'N', '', 'g') AS s FROM documents)
      SELECT doc_id, sha256(translate(reverse(s), 'ACGT', 'TGCA')) AS rc, (SELECT min(p) FROM (SELECT unnest(range(1, strlen(s) - 1, 3)) AS p) WHERE s[p:p+2] IN ('TAA', 'TAG', 'TGA')) AS stop, s[4:6] AS codon FROM d""",
    "peptide_qc": "WITH d AS (SELECT doc_id, regexp_replace(text, '[ .]', '*', 'g') AS p FROM documents) SELECT doc_id, length(replace(p, '*', '')) AS aa_len, (contains(p[:-2], '*'))::INT AS internal_stop, (length(replace(p, '*', '')) < 100)::INT AS short_orf FROM d",
    "locus_clusters": f"""WITH {CDS_SQL}, x AS (SELECT *, max("end") OVER (PARTITION BY chrom, strand ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM cds),
      y AS (SELECT *, (sum(CASE WHEN m IS NULL OR "start" > m THEN 1 ELSE 0 END) OVER (PARTITION BY chrom, strand ORDER BY "start", "end" ROWS UNBOUNDED PRECEDING))::BIGINT AS cluster FROM x)
      SELECT chrom, strand, cluster, count(*) AS n, min("start") AS "start", max("end") AS "end" FROM y GROUP BY 1, 2, 3""",
    "depth_sweep": f"""WITH {FEATURES_SQL}, e AS (SELECT chrom, strand, pos, sum(d) AS d FROM (SELECT chrom, strand, "start" AS pos, 1 AS d FROM features UNION ALL SELECT chrom, strand, "end", -1 FROM features) GROUP BY 1, 2, 3 HAVING sum(d) <> 0),
      r AS (SELECT chrom, strand, pos, lead(pos) OVER w AS nxt, (sum(d) OVER (PARTITION BY chrom, strand ORDER BY pos))::BIGINT AS depth FROM e WINDOW w AS (PARTITION BY chrom, strand ORDER BY pos))
      SELECT chrom, strand, count(*) AS runs, max(depth) AS deepest, sum(depth * (nxt - pos))::BIGINT AS bases FROM r WHERE depth > 0 GROUP BY 1, 2""",
    "zero_gaps": f"""WITH {CDS_SQL}, x AS (SELECT chrom, max("end") OVER (PARTITION BY chrom ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 AS gap_start, "start" - 1 AS gap_end FROM cds)
      SELECT chrom, gap_start, gap_end FROM x WHERE gap_end - gap_start + 1 >= 10""",
    "evidence_score": """WITH s AS (SELECT l_partkey AS locus, 's' || l_linenumber AS source, round(sum(log10(CASE WHEN l_quantity % 7 = 0 THEN 0.01 ELSE l_quantity % 7 END) + 1), 6) AS score FROM lineitem GROUP BY 1, 2)
      SELECT locus, source, score FROM (SELECT *, row_number() OVER (PARTITION BY locus ORDER BY score DESC NULLS LAST, source) AS rn FROM s) WHERE rn = 1""",
    "ntile_split": "WITH n AS (SELECT count(*) AS n FROM orders) SELECT k::INT AS part, (n // 7 + CASE WHEN k < n % 7 THEN 1 ELSE 0 END)::BIGINT AS n FROM n, (SELECT unnest(range(0, 7)) AS k)",
    "mate_pairs": """WITH c AS (SELECT conv_id, count(*) FILTER (turn % 2 = 0) AS one, count(*) FILTER (turn % 2 = 1) AS two FROM conversations GROUP BY 1)
      SELECT count(*) FILTER (one > 0 AND two > 0) AS pairs, count(*) FILTER (one = 0 OR two = 0) AS orphans, sum(greatest(one - 1, 0) + greatest(two - 1, 0))::BIGINT AS dups FROM c""",
    "dedup_sequence": "SELECT min(doc_id) AS doc_id FROM documents GROUP BY text",
}
