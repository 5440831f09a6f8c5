"""Queries over the filter workflow's rules beyond the seed labels; transcripts are made from ``part``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evidence as ev
from .adapters import read
from .evidence_plans import EV, FLAGS, LABEL, evidence

#: Further evidence of a transcript, read the same way by both engines.
MORE = {
    "noncoding_prob": "CASE WHEN transcript_id % 8 = 0 THEN NULL ELSE (transcript_id * 71 % 101) / 100.0 END",
    "hexamer": "CASE WHEN transcript_id % 12 = 0 THEN NULL ELSE (transcript_id * 73 % 101) / 400.0 END",
    "cpc2": "transcript_id % 3 > 0",
    "curated": "CASE WHEN transcript_id % 4 = 0 THEN TRUE END",
    "subject_exons": "CASE WHEN transcript_id % 5 > 0 THEN transcript_id % 4 END",
    "busco": "transcript_id % 19 = 0",
    "prob": "(transcript_id * 61 % 101) / 100.0",
    "miniprot": "CASE WHEN transcript_id % 14 > 0 THEN (transcript_id * 79 % 101) / 100.0 END",
}
MORE_SQL = "mr AS (SELECT *, " + ", ".join(f"{v} AS {k}" for k, v in MORE.items()) + " FROM fl)"
BASE = f"WITH {EV}, {FLAGS}, {MORE_SQL}"
STRICT = """st AS (SELECT * REPLACE ((coalesce(single_exon, false) AND coalesce(curated, false)) OR (NOT coalesce(single_exon, false) AND blast AND NOT coalesce(subject_exons = 1, false)) AS blast) FROM mr)"""


def more_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ev.flags(evidence(spark, sf_dir))
    double = ("noncoding_prob", "hexamer", "prob", "miniprot")
    return t.select("*", *(F.expr(v).cast("double").alias(k) if k in double else F.expr(v).alias(k) for k, v in MORE.items()))


def homology_flag_miniprot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Protein alignment coverage as a flag, strictly above its cutoff."""
    return more_evidence(spark, sf_dir).select("transcript_id", ev.above("miniprot", ev.Cutoffs().miniprot).alias("f_miniprot"))


def strict_homology(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.strict_single_exon(more_evidence(spark, sf_dir)).select("transcript_id", "f_blast", "f_noblast")


def noncoding_single_exon(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ev.noncoding_single(more_evidence(spark, sf_dir), ev.Cutoffs(noncoding=0.5), "cpc2")
    return t.select("transcript_id", "f_noncoding")


def seed_labels_opt_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed labels with strict single-exon homology and the non-coding path."""
    t = ev.noncoding_single(ev.strict_single_exon(more_evidence(spark, sf_dir)), ev.Cutoffs(noncoding=0.5))
    return ev.seed_with_noncoding(t).select("transcript_id", "label")


#: Domain names that a transcript's line items stand for.
DOMAIN = "['RVT_1', 'zf-BED', 'PF_kinase', 'hATC', 'SWIM', 'DDE_Tnp_4', 'GAGA_bind', 'DUF4218', 'rve', 'RVE6', 'Retrotran_gag_2']"


def domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*[F.lit(x.strip(" '")) for x in DOMAIN[1:-1].split(",")])
    return read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("transcript_id"), F.get(names, F.least(F.pmod("l_suppkey", F.lit(11)), F.pmod("l_linenumber", F.lit(11))).cast("int")).alias("domain"))


def te_domain_withdrawal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain evidence without transcripts that carry transposon domains only; borderline names count."""
    d = domains(spark, sf_dir)
    d = d.withColumn("domain", F.when((F.col("transcript_id") % 3 == 0) | F.col("domain").isin("RVT_1", "zf-BED", "hATC", "SWIM"), F.col("domain")).otherwise("RVT_1"))
    out = ev.withdraw_te_domains(more_evidence(spark, sf_dir), ev.te_only(d, borderline=True))
    return out.select("transcript_id", "f_pfam")


def te_domain_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = domains(spark, sf_dir).select("domain", ev.te_domain("domain").alias("te"), ev.te_domain("domain", True).alias("te_or_borderline"))
    return d.groupBy("domain", "te", "te_or_borderline").agg(F.count(F.lit(1)).alias("n"))


def two_hop_subject_exons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best hit -> its transcript (first mapping) -> exons of that transcript."""
    l = read(spark, sf_dir, "lineitem")
    hits = l.select(F.col("l_partkey").alias("query"), F.col("l_suppkey").alias("subject"), "l_extendedprice", "l_orderkey", "l_linenumber")
    best = ev.first_by(hits, "query", F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber")).select("query", "subject")
    o = read(spark, sf_dir, "orders")
    proteins = o.select((F.col("o_orderkey") % 120).alias("protein"), F.col("o_orderkey").alias("transcript"), F.col("o_orderkey").alias("line_no"))
    return ev.subject_exons(best, proteins, l.select(F.col("l_orderkey").alias("transcript")))


def rule_overlap_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.rule_overlaps(more_evidence(spark, sf_dir), F.col("f_cov") & F.col("f_aug"), F.col("f_pfam"), F.col("f_lnc"))


def rescue_with_busco_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiers of the undecided, and conserved genes back from any label."""
    t = ev.rescued(ev.seed_label(more_evidence(spark, sf_dir)))
    return t.select("transcript_id", "label", "tier", "kept")


def curation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genes to publish: kept, or undecided with a flag or coverage."""
    t = ev.seed_label(more_evidence(spark, sf_dir)).select("transcript_id", "label", "coverage", (F.col("transcript_id") % 7 == 0).alias("augustus"), F.when(F.col("transcript_id") % 9 == 0, "1.0").otherwise("0.4").alias("helixer"), F.lit(None).cast("string").alias("blast_pident"))
    return ev.curated(t, 0.9).select("transcript_id", "label")


HMM = """hm AS (SELECT l_partkey AS gene, l_suppkey % 4 AS domain, (l_quantity::BIGINT % 40) + 1 AS hmm_start, (l_quantity::BIGINT % 40) + l_linenumber * 4 AS hmm_end, 60 + (l_suppkey % 4) * 20 AS hmm_len, pow(10.0, -(l_orderkey % 8)) AS evalue FROM lineitem)"""


def hmm_domain_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain matches by united model coverage and e-value."""
    q = F.col("l_quantity").cast("long") % 40
    hits = read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("gene"), (F.col("l_suppkey") % 4).alias("domain"), (q + 1).alias("hmm_start"), (q + F.col("l_linenumber") * 4).alias("hmm_end"), (60 + (F.col("l_suppkey") % 4) * 20).alias("hmm_len"), F.pow(F.lit(10.0), -(F.col("l_orderkey") % 8)).alias("evalue"))
    return ev.domain_hits(hits).select("gene", "domain", "covered", F.round("coverage", 6).alias("coverage"))


def feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features as numbers with missing flags; text that is no number counts as missing."""
    t = more_evidence(spark, sf_dir).withColumn("tpm", F.when(F.col("transcript_id") % 17 == 0, "n/a").otherwise(F.col("tpm").cast("string")))
    return ev.feature_matrix(t, ["tpm", "coverage", "augustus"])


def curve_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = evidence(spark, sf_dir).where("coverage IS NOT NULL").select(F.col("coverage").alias("score"), F.coalesce("pfam", F.lit(False)).cast("int").alias("label"))
    return ev.curve_summary(t).select(*(F.round(c, 6).alias(c) for c in ("roc_auc", "average_precision", "f1", "threshold")))


def busco_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a conserved-gene table that are not missing, with those that protect a transcript."""
    p = read(spark, sf_dir, "part").select("p_partkey", F.get(F.array(*[F.lit(x) for x in ("Complete", "Duplicated", "Fragmented", "Missing")]), (F.col("p_partkey") % 4).cast("int")).alias("status"))
    return p.where("status <> 'Missing'").select("p_partkey", "status", F.col("status").isin("Complete", "Duplicated").alias("protects"))


def single_or_best_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-labels for training: a domain or a homologue is positive, a transposon hit negative, both positive."""
    t = more_evidence(spark, sf_dir)
    pos = F.col("f_pfam") | (F.coalesce("blast_pident", F.lit(0.0)) > 0)
    neg = F.coalesce("rex_pident", F.lit(0.0)) > 0
    return t.where(pos | neg).select("transcript_id", pos.cast("int").alias("label"))


QUERIES = {f.__name__: f for f in (homology_flag_miniprot, strict_homology, noncoding_single_exon, seed_labels_opt_in, te_domain_withdrawal, te_domain_names, two_hop_subject_exons, rule_overlap_counts, rescue_with_busco_net, curation, hmm_domain_filter, feature_matrix, curve_summary, busco_table, single_or_best_label)}
_DOM = f"SELECT l_partkey AS transcript_id, {DOMAIN}[least(l_suppkey % 11, l_linenumber % 11) + 1] AS domain FROM lineitem"
_TE = "(domain IN ('zf-BED', 'hATC', 'DUF4218', 'rve') OR starts_with(domain, 'RVT_') OR starts_with(domain, 'DDE_Tnp_') OR starts_with(domain, 'Retrotran_gag'))"
ORACLES = {
    "homology_flag_miniprot": f"{BASE} SELECT transcript_id, coalesce(miniprot > 0.5, false) AS f_miniprot FROM mr",
    "strict_homology": f"{BASE}, {STRICT} SELECT transcript_id, blast AS f_blast, NOT blast AS f_noblast FROM st",
    "noncoding_single_exon": f"{BASE} SELECT transcript_id, coalesce(single_exon, false) AND coalesce(noncoding_prob, 0) >= 0.5 AND coalesce(hexamer, 1) < 0.15 AND cpc2 AS f_noncoding FROM mr",
    "seed_labels_opt_in": f"""{BASE}, {STRICT}, fl2 AS (SELECT * REPLACE (NOT blast AS noblast) FROM st), {LABEL.replace(' FROM fl)', ' FROM fl2)')}
      SELECT transcript_id, CASE WHEN coalesce(single_exon, false) AND coalesce(noncoding_prob, 0) >= 0.5 AND coalesce(hexamer, 1) < 0.15 AND NOT pf AND noblast THEN 'Discard' ELSE label END AS label FROM lb""",
    "te_domain_withdrawal": f"""{BASE}, d AS (SELECT transcript_id, CASE WHEN transcript_id % 3 = 0 OR domain IN ('RVT_1', 'zf-BED', 'hATC', 'SWIM') THEN domain ELSE 'RVT_1' END AS domain FROM ({_DOM})), te AS (SELECT transcript_id FROM d GROUP BY 1 HAVING bool_and({_TE} OR domain = 'SWIM'))
      SELECT transcript_id, pf AND transcript_id NOT IN (SELECT transcript_id FROM te) AS f_pfam FROM mr""",
    "te_domain_names": f"SELECT domain, {_TE} AS te, {_TE} OR domain = 'SWIM' AS te_or_borderline, count(*) AS n FROM ({_DOM}) GROUP BY 1, 2, 3",
    "two_hop_subject_exons": """WITH b AS (SELECT l_partkey AS query, arg_min(l_suppkey, {'a': -l_extendedprice, 'b': l_orderkey, 'c': l_linenumber}) AS subject FROM lineitem GROUP BY 1),
      m AS (SELECT o_orderkey % 120 AS protein, min(o_orderkey) AS transcript FROM orders GROUP BY 1), x AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)
      SELECT query, subject, CASE WHEN protein IS NOT NULL THEN coalesce(n, 0) END AS subject_exons FROM b LEFT JOIN m ON protein = subject LEFT JOIN x ON l_orderkey = transcript""",
    "rule_overlap_counts": f"{BASE} SELECT count(*) FILTER (cov AND aug AND pf) AS ab, count(*) FILTER (cov AND aug AND lncf) AS ac, count(*) FILTER (pf AND lncf) AS bc FROM mr",
    "rescue_with_busco_net": f"""{BASE}, {LABEL.replace(' FROM fl)', ' FROM mr)')}, t AS (SELECT *, CASE WHEN label <> 'None' THEN 'none' WHEN prob > 0.6 AND NOT (coalesce(rex_pident, 0) > 0 AND NOT coalesce(blast_pident, 0) > 0) THEN 'classifier'
      WHEN pf AND coalesce(repeat, 0) <= 0.5 AND NOT coalesce(rex_pident, 0) > 0 THEN 'domain' WHEN busco THEN 'busco' ELSE 'none' END AS tier FROM lb) SELECT transcript_id, label, tier, label = 'Keep' OR tier <> 'none' OR busco AS kept FROM t""",
    "curation": f"{BASE}, {LABEL.replace(' FROM fl)', ' FROM mr)')} SELECT transcript_id, label FROM lb WHERE label = 'Keep' OR (label = 'None' AND (transcript_id % 7 = 0 OR transcript_id % 9 = 0 OR coalesce(coverage > 0.9, false)))",
    "hmm_domain_filter": f"""WITH {HMM}, u AS (SELECT DISTINCT gene, domain, hmm_len, unnest(range(hmm_start, hmm_end + 1)) AS p FROM hm), c AS (SELECT gene, domain, count(p) AS covered FROM u GROUP BY 1, 2), e AS (SELECT gene, domain, min(evalue) AS ev, max(hmm_len) AS len FROM hm GROUP BY 1, 2)
      SELECT gene, domain, covered, round(covered / len, 6) AS coverage FROM c JOIN e USING (gene, domain) WHERE covered / len >= 0.25 AND ev <= 1e-3 AND (len < 80 OR ev <= 1e-5)""",
    "feature_matrix": f"""{BASE}, x AS (SELECT *, CASE WHEN transcript_id % 17 > 0 THEN tpm END AS t FROM mr) SELECT transcript_id, coalesce(t, 0)::DOUBLE AS tpm, coalesce(coverage, 0)::DOUBLE AS coverage, coalesce(augustus, 0)::DOUBLE AS augustus,
      (t IS NULL)::INT AS tpm_missing, (coverage IS NULL)::INT AS coverage_missing, (augustus IS NULL)::INT AS augustus_missing FROM x""",
    "curve_summary": f"""WITH {EV}, s AS (SELECT coverage::DOUBLE AS score, coalesce(pfam, false)::INT AS y FROM ev WHERE coverage IS NOT NULL), g AS (SELECT score, sum(y) AS p, count(*) AS n FROM s GROUP BY 1), c AS (SELECT *, sum(p) OVER w AS rp, sum(n) OVER w AS rn FROM g WINDOW w AS (ORDER BY score DESC)),
      t AS (SELECT sum(y) AS tp, count(*) AS tn FROM s), u AS (SELECT (SELECT sum(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0 END) FROM s a, s b WHERE a.y = 1 AND b.y = 0) AS auc)
      SELECT round((SELECT auc FROM u) / max(tp * (tn - tp)), 6) AS roc_auc, round(sum(p / tp * rp / rn), 6) AS average_precision, round(max(2 * rp / (rn + tp)), 6) AS f1, round(arg_max(score, {{'a': 2 * rp / (rn + tp), 'b': score}}), 6) AS threshold FROM c, t""",
    "busco_table": "WITH p AS (SELECT p_partkey, ['Complete', 'Duplicated', 'Fragmented', 'Missing'][p_partkey % 4 + 1] AS status FROM part) SELECT p_partkey, status, status IN ('Complete', 'Duplicated') AS protects FROM p WHERE status <> 'Missing'",
    "single_or_best_label": f"{BASE} SELECT transcript_id, (pf OR coalesce(blast_pident, 0) > 0)::INT AS label FROM mr WHERE pf OR coalesce(blast_pident, 0) > 0 OR coalesce(rex_pident, 0) > 0",
}
