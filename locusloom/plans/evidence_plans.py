"""Queries over the evidence operators; transcripts are made from ``part``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evidence as ev
from .adapters import read

#: Evidence columns in SQL that both engines read the same way.
COLUMNS = {
    "transcript_id": "p_partkey",
    "tpm": "CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE (p_partkey * 7 % 40) / 4.0 END",
    "coverage": "CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE (p_partkey * 17 % 101) / 100.0 END",
    "augustus": "CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE (p_partkey * 29 % 101) / 100.0 END",
    "helixer": "CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE (p_partkey * 31 % 101) / 100.0 END",
    "repeat": "CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE (p_partkey * 37 % 101) / 100.0 END",
    "pfam": "CASE WHEN p_partkey % 3 = 0 THEN TRUE END",
    "lnc": "CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE (p_partkey * 41 % 101) / 100.0 END",
    "single_exon": "CASE WHEN p_size <= 10 THEN TRUE END",
    "blast_pident": "CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE (p_partkey * 43 % 101) * 1.0 END",
    "blast_qcovs": "CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE (p_partkey * 47 % 101) * 1.0 END",
    "rex_pident": "CASE WHEN p_partkey % 6 = 0 THEN (p_partkey * 53 % 101) * 1.0 END",
    "rex_qcovs": "CASE WHEN p_partkey % 6 = 0 THEN (p_partkey * 59 % 101) * 1.0 END",
}
EV = "ev AS (SELECT " + ", ".join(f"{v} AS {k}" for k, v in COLUMNS.items()) + " FROM part)"
FLAGS = """
fl AS (SELECT *, coalesce(tpm > 3, false) AS tpm_ok, coalesce(coverage > 0.5, false) AS cov, coalesce(augustus > 0.8, false) AS aug, coalesce(helixer > 0.8, false) AS hel,
  coalesce(repeat < 0.5, false) AS notrep, coalesce(pfam, false) AS pf, coalesce(lnc > 0.5, false) AS lncf, NOT coalesce(single_exon, false) AS multi,
  coalesce(blast_pident > 60, false) AND coalesce(blast_qcovs > 60, false) AS blast, NOT coalesce(blast_pident > 60, false) AND NOT coalesce(blast_qcovs > 60, false) AS noblast,
  coalesce(rex_pident > 60, false) AND coalesce(rex_qcovs > 60, false) AS rex FROM ev)"""


def evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    double = {k for k in COLUMNS} - {"transcript_id", "pfam", "single_exon"}
    return read(spark, sf_dir, "part").select(*(F.expr(v).cast("double").alias(k) if k in double else F.expr(v).alias(k) for k, v in COLUMNS.items()))


def threshold_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ev.flags(evidence(spark, sf_dir))
    return t.select("transcript_id", *(F.col(c) for c in t.columns if c.startswith("f_")))


def seed_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.seed_label(ev.flags(evidence(spark, sf_dir))).select("transcript_id", "label")


def discard_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ev.seed_label(ev.flags(evidence(spark, sf_dir))).where("label = 'Discard'")
    return t.groupBy(ev.discard_class().alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def pseudogene_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = evidence(spark, sf_dir).select("*", (F.col("transcript_id") % 4).cast("int").alias("frameshifts"), F.when(F.col("transcript_id") % 5 != 0, (F.col("transcript_id") % 6).cast("int")).alias("subject_exons"), (F.col("transcript_id") % 17 == 0).alias("protected"))
    return ev.pseudogene_reason(t, tpm_cutoff=5.0).select("transcript_id", "reason")


def rescue_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = evidence(spark, sf_dir).select("*", ((F.col("transcript_id") * 61 % 101) / 100).alias("prob"), (F.col("transcript_id") % 19 == 0).alias("busco"))
    return t.select("transcript_id", ev.rescue_tier().alias("tier"))


def soft_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = evidence(spark, sf_dir).select("transcript_id", F.coalesce("rex_pident", F.lit(0.0)).alias("rex"), F.coalesce("repeat", F.lit(0.0)).alias("repeat"), F.coalesce("lnc", F.lit(0.0)).alias("lnc"), (F.col("transcript_id") % 23 == 0).cast("int").alias("internal_stop"), (F.col("transcript_id") % 29 == 0).cast("int").alias("short_orf"), (F.coalesce("pfam", F.lit(False)) | (F.coalesce("blast_pident", F.lit(0.0)) > 50)).alias("keep"))
    cut = ev.quantile_cutoffs(t, "repeat", floor_high=0.05)
    return t.crossJoin(F.broadcast(cut)).select("transcript_id", ev.soft_vote(F.col("p_high"), F.col("keep")).alias("vote"))


def quantile_cutoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = ev.quantile_cutoffs(evidence(spark, sf_dir).where("coverage IS NOT NULL"), "coverage")
    return q.select(F.round("p_low", 6).alias("p_low"), F.round("p_high", 6).alias("p_high"))


def pr_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = evidence(spark, sf_dir).where("coverage IS NOT NULL").select(F.col("coverage").alias("score"), F.coalesce("pfam", F.lit(False)).cast("int").alias("label"))
    return ev.pr_curve(t).select("score", "tp", "seen", *(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")))


def best_hit_bitscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("query"), F.col("l_suppkey").alias("subject"), F.col("l_extendedprice").alias("bitscore"), "l_orderkey", "l_linenumber")
    best = ev.first_by(hits, "query", F.desc("bitscore"), F.asc("l_orderkey"), F.asc("l_linenumber"), F.asc("subject"))
    return best.select("query", "subject", "bitscore")


def te_only_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    return ev.only_in(e.select((F.col("event_id") % 3000).alias("gene"), "event_type"), "gene", "event_type", ["click", "view"], ["pur"])


def evidence_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left joins of per-transcript evidence; missing evidence stays null."""
    p = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("transcript_id"))
    l = read(spark, sf_dir, "lineitem")
    hits = l.where("l_quantity > 45").groupBy(F.col("l_partkey").alias("transcript_id")).agg(F.count(F.lit(1)).alias("hits"), F.max("l_extendedprice").alias("best"))
    reads = l.where("l_returnflag = 'R'").groupBy(F.col("l_partkey").alias("transcript_id")).agg(F.sum(F.col("l_quantity").cast("long")).alias("reads"))
    return ev.merge_evidence(p, [hits, reads]).select("transcript_id", "hits", "best", "reads")


def outer_feature_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full outer chain on the gene id; gaps become 0."""
    l = read(spark, sf_dir, "lineitem")
    a = l.where("l_quantity > 48").groupBy(F.col("l_suppkey").alias("gene_id")).agg(F.count(F.lit(1)).alias("a"))
    b = l.where("l_discount > 0.08").groupBy(F.col("l_suppkey").alias("gene_id")).agg(F.count(F.lit(1)).alias("b"))
    c = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("gene_id"), F.lit(1).cast("long").alias("c"))
    return ev.merge_features([a, b, c])


def mean_across_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean per id over all samples; samples without the id count as 0."""
    e = read(spark, sf_dir, "events")
    n = e.agg(F.count_distinct("event_type").alias("n"))
    return ev.mean_over_samples(e, "user_id", F.lit(1), n).select("user_id", F.round("mean", 6).alias("mean"))


QUERIES = {f.__name__: f for f in (threshold_flags, seed_labels, discard_reason, pseudogene_rules, rescue_tiers, soft_vote, quantile_cutoffs, pr_curve, best_hit_bitscore, te_only_domains, evidence_merge, outer_feature_merge, mean_across_samples)}
LABEL = """
lb AS (SELECT *, CASE WHEN (NOT cov AND NOT aug AND NOT hel AND noblast AND NOT pf) OR (NOT multi AND noblast AND NOT pf AND NOT cov) OR (rex AND noblast AND NOT pf)
    OR (lncf AND NOT multi AND NOT pf AND NOT aug AND NOT hel) OR (aug AND NOT hel AND noblast AND NOT pf AND NOT cov) THEN 'Discard'
  WHEN (cov AND ((blast AND pf) OR (aug AND hel))) OR (multi AND NOT lncf AND cov AND tpm_ok) OR (multi AND pf AND blast) OR (aug AND hel AND NOT rex AND notrep AND NOT lncf AND multi) OR (blast AND pf) THEN 'Keep'
  ELSE 'None' END AS label FROM fl)"""
ORACLES = {
    "threshold_flags": f"WITH {EV}, {FLAGS} SELECT transcript_id, tpm_ok AS f_tpm, cov AS f_cov, aug AS f_aug, hel AS f_hel, notrep AS f_notrep, pf AS f_pfam, lncf AS f_lnc, multi AS f_multi, blast AS f_blast, noblast AS f_noblast, rex AS f_rex FROM fl",
    "seed_labels": f"WITH {EV}, {FLAGS}, {LABEL} SELECT transcript_id, label FROM lb",
    "discard_reason": f"WITH {EV}, {FLAGS}, {LABEL} SELECT CASE WHEN rex_pident > 0 THEN 'TE_related' WHEN lnc > 0.5 THEN 'lncRNA' ELSE 'pseudogene' END AS reason, count(*) AS n FROM lb WHERE label = 'Discard' GROUP BY 1",
    "pseudogene_rules": f"""WITH {EV} SELECT transcript_id, CASE WHEN transcript_id % 17 = 0 THEN NULL
      WHEN transcript_id % 4 >= 2 AND coalesce(tpm, 0) < 5 AND pfam IS NULL THEN 'B'
      WHEN single_exon AND transcript_id % 5 <> 0 AND transcript_id % 6 >= 2 AND coalesce(tpm, 0) < 5 AND pfam IS NULL THEN 'C'
      WHEN coalesce(tpm, 0) = 0 AND pfam IS NULL AND coalesce(coverage, 0) < 0.5 AND blast_pident IS NOT NULL THEN 'A' END AS reason FROM ev""",
    "rescue_tiers": f"""WITH {EV} SELECT transcript_id, CASE WHEN (transcript_id * 61 % 101) / 100.0 > 0.6 AND NOT (coalesce(rex_pident, 0) > 0 AND NOT coalesce(blast_pident > 0, false)) THEN 'classifier'
      WHEN coalesce(pfam, false) AND coalesce(repeat, 0) <= 0.5 AND coalesce(rex_pident, 0) = 0 THEN 'domain' WHEN transcript_id % 19 = 0 THEN 'busco' ELSE 'none' END AS tier FROM ev""",
    "soft_vote": f"""WITH {EV}, q AS (SELECT greatest(0.05, quantile_cont(coalesce(repeat, 0)::DOUBLE, 0.95)) AS h FROM ev)
      SELECT transcript_id, CASE WHEN (coalesce(rex_pident, 0) > 0 AND coalesce(repeat, 0) >= h) OR coalesce(lnc, 0) >= 0.6 OR transcript_id % 23 = 0 OR transcript_id % 29 = 0 THEN 'drop' WHEN pfam OR coalesce(blast_pident, 0) > 50 THEN 'keep' ELSE 'unsure' END AS vote FROM ev, q""",
    "quantile_cutoffs": f"WITH {EV} SELECT round(quantile_cont(coverage::DOUBLE, 0.05), 6) AS p_low, round(quantile_cont(coverage::DOUBLE, 0.95), 6) AS p_high FROM ev",
    "pr_curve": f"""WITH {EV}, g AS (SELECT coverage::DOUBLE AS score, sum(coalesce(pfam, false)::INT)::BIGINT AS p, count(*) AS n FROM ev WHERE coverage IS NOT NULL GROUP BY 1),
      c AS (SELECT score, (sum(p) OVER (ORDER BY score DESC))::BIGINT AS tp, (sum(n) OVER (ORDER BY score DESC))::BIGINT AS seen, (SELECT sum(p) FROM g) AS allp FROM g)
      SELECT score, tp, seen, round(tp / seen, 6) AS precision, round(tp / allp, 6) AS recall, round(2 * tp / (seen + allp), 6) AS f1 FROM c""",
    "best_hit_bitscore": "SELECT l_partkey AS query, arg_min(l_suppkey, {'a': -l_extendedprice, 'b': l_orderkey, 'c': l_linenumber, 'd': l_suppkey}) AS subject, max(l_extendedprice) AS bitscore FROM lineitem GROUP BY 1",
    "te_only_domains": "SELECT event_id % 3000 AS gene FROM events GROUP BY 1 HAVING bool_and(coalesce(event_type IN ('click', 'view') OR event_type LIKE 'pur%', false))",
    "evidence_merge": """SELECT p_partkey AS transcript_id, hits, best, reads FROM part LEFT JOIN (SELECT l_partkey, count(*) AS hits, max(l_extendedprice) AS best FROM lineitem WHERE l_quantity > 45 GROUP BY 1) h ON h.l_partkey = p_partkey
      LEFT JOIN (SELECT l_partkey, sum(l_quantity::BIGINT)::BIGINT AS reads FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) r ON r.l_partkey = p_partkey""",
    "outer_feature_merge": """SELECT gene_id, coalesce(a, 0) AS a, coalesce(b, 0) AS b, coalesce(c, 0) AS c FROM (SELECT l_suppkey AS gene_id, count(*) AS a FROM lineitem WHERE l_quantity > 48 GROUP BY 1)
      FULL JOIN (SELECT l_suppkey AS gene_id, count(*) AS b FROM lineitem WHERE l_discount > 0.08 GROUP BY 1) USING (gene_id) FULL JOIN (SELECT s_suppkey AS gene_id, 1::BIGINT AS c FROM supplier) USING (gene_id)""",
    "mean_across_samples": "SELECT user_id, round(count(*) / (SELECT count(DISTINCT event_type) FROM events), 6) AS mean FROM events GROUP BY 1",
}
