"""Queries over sequence and name functions; sequences are made from the documents' texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sequences as sq
from ..operators.tree import chromosome_tag
from ..written import written
from .adapters import read

_SEQ = "regexp_replace(upper(regexp_replace(text, '[^ATCGatcg]', 'N', 'g')), 'N', '', 'g')"


def _seq(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select("doc_id", sq.clean_genome("text").alias("s"))
    return d.select("doc_id", F.regexp_replace("s", "N", "").alias("s")).withColumn("n", F.length("s"))


def spliced_codons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last codon of a CDS of two parts, whose places follow from the length, on both strands; what is missing."""
    part = lambda a, b: F.struct(a.cast("int").alias("start"), b.cast("int").alias("end"))
    n = F.col("n")
    places = F.array(part(F.floor(n / 4) + 1, F.floor(n / 4) + F.floor(n / 8)), part(F.floor(n / 2) + 1, F.floor(n / 2) + F.floor(n / 5)))
    d = _seq(spark, sf_dir).select("doc_id", "s", F.when(F.col("doc_id") % 2 == 0, "+").otherwise("-").alias("strand"), places.alias("parts"))
    d = written(d.select("doc_id", sq.spliced("s", "parts", "strand").alias("cds")), "coding")
    first, last = sq.end_codons(F.col("cds"), 1)
    return d.select("doc_id", first.alias("first"), last.alias("last"), sq.fill_plan(first, last).alias("fill"))


def upstream_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The start codon that a model's first codon, in the middle of the sequence, can be moved to."""
    return _seq(spark, sf_dir).select("doc_id", sq.previous_start("s", F.floor(F.col("n") / 2)).cast("long").alias("start"))


def name_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of reads, sequences, regions, features and chromosomes."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("r"), F.col("o_orderkey"), F.lit("/"), F.col("o_orderkey") % 4, F.lit(" x")).alias("a"), F.concat(F.lit("d/chr."), F.col("o_orderkey") % 9, F.lit(".v2."), F.col("o_custkey"), F.lit("-"), F.col("o_orderkey"), F.lit(".sam")).alias("b"), F.concat(F.lit("g1.CDS"), F.col("o_orderkey") % 3).alias("c"))
    o = o.withColumn("b2", F.regexp_extract("a", r"^(\S*)", 1)).withColumn("p", F.concat(F.lit("MK*L."), F.col("o_orderkey") % 3, F.lit("*")))
    return o.select("o_orderkey", sq.clean_header("a").alias("header"), sq.mate("b2").alias("mate"), sq.safe_name("b").alias("safe"), *sq.split_region("b"), sq.feature_suffix("c").alias("suffix"), chromosome_tag(F.concat(F.lit("Chr"), (F.col("o_orderkey") % 12).cast("string")), 2).alias("tag"), sq.clean_protein("p").alias("protein"))


QUERIES = {f.__name__: f for f in (spliced_codons, upstream_start, name_cleanup)}
ORACLES = {
    "spliced_codons": f"""WITH d AS (SELECT doc_id, {_SEQ} AS s FROM documents), l AS (SELECT *, strlen(s) AS n FROM d), c AS (SELECT doc_id, s[n // 4 + 1:n // 4 + n // 8] || s[n // 2 + 1:n // 2 + n // 5] AS j FROM l), e AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN j ELSE translate(reverse(j), 'ACGT', 'TGCA') END AS j FROM c),
      f AS (SELECT doc_id, j[2:4] AS first, (strlen(j) - 1) // 3 * 3 AS w, j FROM e), g AS (SELECT doc_id, first, CASE WHEN w > 0 THEN j[w - 1:w + 1] WHEN j IS NOT NULL THEN '' END AS last FROM f)
      SELECT doc_id, first, last, CASE WHEN first = 'ATG' AND last IN ('TAA', 'TAG', 'TGA') THEN 'none' WHEN last IN ('TAA', 'TAG', 'TGA') THEN 'start' WHEN first = 'ATG' THEN 'stop' ELSE 'both' END AS fill FROM g""",
    "upstream_start": f"""WITH d AS (SELECT doc_id, {_SEQ} AS s FROM documents), l AS (SELECT *, strlen(s) // 2 AS mid FROM d), p AS (SELECT doc_id, s, mid, unnest(range((mid - 1) % 3 + 1, mid + 1, 3)) AS p FROM l WHERE mid > 0), q AS (SELECT doc_id, mid, p, s[p:p + 2] AS c FROM p),
      t AS (SELECT doc_id, max(p) FILTER (p < mid AND c IN ('TAA', 'TAG', 'TGA')) AS stop FROM q GROUP BY 1), u AS (SELECT q.doc_id, min(p) FILTER (p > coalesce(stop, 0) AND c = 'ATG') AS start FROM q JOIN t USING (doc_id) GROUP BY 1) SELECT doc_id, start FROM d LEFT JOIN u USING (doc_id)""",
    "name_cleanup": """SELECT o_orderkey, 'r' || o_orderkey || '_' || (o_orderkey % 4) AS header, CASE WHEN o_orderkey % 4 IN (1, 2) THEN (o_orderkey % 4)::INT END AS mate, 'd_chr.' || (o_orderkey % 9) || '.v2.' || o_custkey || '-' || o_orderkey || '.sam' AS safe, 'chr.' || (o_orderkey % 9) || '.v2' AS seqid,
      o_custkey AS start, o_orderkey AS "end", 'cds' || (o_orderkey % 3) AS suffix, lpad((o_orderkey % 12)::VARCHAR, 2, '0') || 'G' AS tag, 'MKL' || (o_orderkey % 3) AS protein FROM orders""",
}
