"""Queries over id sets, updates and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sets, tree
from .adapters import read
from .tree_plans import GFF_SQL, gff


def set_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part as a member of two id sets, their union, intersection and difference."""
    l = read(spark, sf_dir, "lineitem")
    a, b = (l.where(w).select(F.col("l_partkey").alias("p_partkey")) for w in ("l_quantity > 49", "l_discount > 0.09"))
    t = sets.membership(read(spark, sf_dir, "part").select("p_partkey"), {"in_a": a, "in_b": b}, "p_partkey")
    return t.select("*", (F.col("in_a") | F.col("in_b")).alias("in_any"), (F.col("in_a") & F.col("in_b")).alias("in_both"), (F.col("in_a") & ~F.col("in_b")).alias("only_a"))


def update_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts whose size is replaced by their largest quantity where that is known."""
    q = read(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.max(F.col("l_quantity")).cast("long").alias("p_size"))
    return sets.updated(read(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("long").alias("p_size")), q, "p_partkey", ["p_size"])


def union_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of equal part and quantity once, from the first supplier."""
    l = read(spark, sf_dir, "lineitem").select("l_partkey", F.col("l_quantity").cast("long").alias("q"), "l_suppkey")
    return sets.first_of_equal(l, ["l_partkey", "q"], F.asc("l_suppkey")).select("l_partkey", "q", "l_suppkey")


def summed_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities of two samples added up by part."""
    l = read(spark, sf_dir, "lineitem").select("l_partkey", F.col("l_quantity").cast("long").alias("tpm"), "l_returnflag")
    return sets.summed([l.where(f"l_returnflag = '{x}'") for x in "AR"], "l_partkey", "tpm")


def childless_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = gff(spark, sf_dir)
    return sets.childless_report(t, tree.childless(t))


def primary_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First isoforms by name, renamed to their gene."""
    o = read(spark, sf_dir, "orders").select(F.concat(F.lit("g"), F.col("o_custkey").cast("string"), F.lit(".t"), (F.col("o_orderkey") % 3).cast("string")).alias("id"))
    return sets.primary_names(o, "id")


def domains_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The domains of a gene by e-value, with their place."""
    l = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("gene"), F.col("l_partkey").alias("domain"), (F.col("l_extendedprice")).alias("evalue"), "l_suppkey")
    return sets.numbered_within(l, ["gene"], "evalue", "domain", "l_suppkey").select("gene", "domain", "place")


def removed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the removal of childless mRNAs took away."""
    t = gff(spark, sf_dir)
    return tree.lost_with_mrnas(t, tree.childless(t)).withColumn("why", F.lit("childless"))


def ordered_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each prediction on its sequence by start, end, strand and line."""
    t = gff(spark, sf_dir).where("type = 'mRNA'")
    return sets.placed(t, ["seqid"], "start", "end", "strand", "line_no").select("line_no", "place")


def sequence_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How long all sequences are together, and the transcripts that evidence is looked up for."""
    lengths = gff(spark, sf_dir).groupBy("seqid").agg(F.max("end").alias("length"))
    return lengths.agg(F.sum("length").alias("bases"), F.count(F.lit(1)).alias("sequences"), F.max("length").alias("longest"))


def looked_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer with what orders say about the part of that number."""
    ids = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"))
    t = read(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return sets.looked_up(ids, t, "key")


QUERIES = {f.__name__: f for f in (set_membership, update_by_key, union_first, summed_samples, childless_report, primary_names, domains_in_order, removed_ids, ordered_models, sequence_totals, looked_up)}
ORACLES = {
    "set_membership": """WITH m AS (SELECT p_partkey, p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49) AS in_a, p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_discount > 0.09) AS in_b FROM part)
      SELECT *, in_a OR in_b AS in_any, in_a AND in_b AS in_both, in_a AND NOT in_b AS only_a FROM m""",
    "update_by_key": "SELECT p_partkey, coalesce(q, p_size)::BIGINT AS p_size FROM part LEFT JOIN (SELECT l_partkey, max(l_quantity)::BIGINT AS q FROM lineitem GROUP BY 1) ON l_partkey = p_partkey",
    "union_first": "SELECT l_partkey, l_quantity::BIGINT AS q, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY 1, 2",
    "summed_samples": "SELECT l_partkey, sum(l_quantity::BIGINT)::BIGINT AS tpm FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY 1",
    "childless_report": f"""WITH {GFF_SQL}, m AS (SELECT id AS mrna, parents[1] AS gene, seqid, "start", "end", 'src' AS source, count(*) OVER (PARTITION BY parents[1]) - 1 AS siblings FROM gff WHERE type = 'mRNA')
      SELECT mrna, gene, seqid, "start", "end", source, siblings FROM m WHERE mrna NOT IN (SELECT unnest(parents) FROM gff WHERE type IN ('exon', 'CDS'))""",
    "primary_names": "WITH o AS (SELECT 'g' || o_custkey || '.t' || (o_orderkey % 3) AS id, 'g' || o_custkey AS gene FROM orders WHERE o_orderkey % 3 = 1) SELECT gene, id, count(*) OVER (PARTITION BY gene) AS copies FROM o",
    "removed_ids": f"""WITH {GFF_SQL}, kd AS (SELECT unnest(parents) AS m FROM gff WHERE type IN ('exon', 'CDS')), bad AS (SELECT id AS mrna FROM gff WHERE type = 'mRNA' AND id NOT IN (SELECT m FROM kd)), em AS (SELECT parents[1] AS gene FROM gff WHERE type = 'mRNA' GROUP BY 1 HAVING bool_and(id IN (SELECT mrna FROM bad))),
      kp AS (SELECT type, id FROM gff WHERE type IN ('gene', 'mRNA') AND id NOT IN (SELECT mrna FROM bad) AND id NOT IN (SELECT gene FROM em) UNION SELECT type, id FROM gff WHERE type NOT IN ('gene', 'mRNA') AND (parents IS NULL OR EXISTS (SELECT 1 FROM (SELECT unnest(parents) AS p) WHERE p NOT IN (SELECT mrna FROM bad))))
      SELECT type, id, 'childless' AS why FROM (SELECT DISTINCT type, id FROM gff EXCEPT SELECT type, id FROM kp)""",
    "ordered_models": f"WITH {GFF_SQL} SELECT line_no, row_number() OVER (PARTITION BY seqid ORDER BY \"start\", \"end\", strand, line_no) AS place FROM gff WHERE type = 'mRNA'",
    "sequence_totals": f"WITH {GFF_SQL}, l AS (SELECT seqid, max(\"end\") AS length FROM gff GROUP BY 1) SELECT sum(length)::BIGINT AS bases, count(*) AS sequences, max(length) AS longest FROM l",
    "looked_up": "SELECT c_custkey AS key, n FROM customer LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_partkey = c_custkey",
    "domains_in_order": "SELECT l_orderkey AS gene, l_partkey AS domain, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice, l_partkey, l_suppkey)::INT AS place FROM lineitem",
}
