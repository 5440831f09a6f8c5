"""Queries over mended model ends and repaired exons. A document's letters A, C, G and T are a sequence with one model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ends, genome
from ..written import written
from .adapters import read

#: Models of one or two coding parts whose places follow from the length of the sequence.
MODELS_SQL = """
d AS (SELECT doc_id, upper(regexp_replace(text, '[^ATCGatcg]', '', 'g')) AS s FROM documents WHERE text IS NOT NULL),
m AS (SELECT doc_id, s, strlen(s) AS n, CASE WHEN doc_id % 2 = 0 THEN '+' ELSE '-' END AS strand, (doc_id % 3)::INT AS f, strlen(s) // 4 + 1 AS a, strlen(s) // 4 + 1 + strlen(s) // 8 AS b, strlen(s) // 2 + 1 AS c, strlen(s) // 2 + strlen(s) // 5 AS e FROM d WHERE s <> ''),
p AS (SELECT doc_id, a AS "start", b AS "end", f AS phase FROM m UNION ALL SELECT doc_id, c, e, ((f + 1) % 3)::INT FROM m WHERE e >= c)"""


def _models(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Models, coding parts and the genome; texts are read once, and models follow from the genome's lengths."""
    d = read(spark, sf_dir, "documents").where("text IS NOT NULL").select(F.col("doc_id").cast("string").alias("seqid"), F.regexp_replace("text", "[^ATCGatcg]", "").alias("seq"))
    store = written(genome.from_rows(d), "genome")
    d = genome.lengths(store).select(F.col("seqid").cast("long").alias("mrna"), "seqid", F.col("length").alias("n"))
    f = (F.col("mrna") % 3).cast("int")
    a, c = F.floor(F.col("n") / 4) + 1, F.floor(F.col("n") / 2) + 1
    part = lambda s, e, p: F.struct(s.alias("start"), e.alias("end"), p.alias("phase"))
    both = F.array(part(a, a + F.floor(F.col("n") / 8), f), part(c, c - 1 + F.floor(F.col("n") / 5), ((f + 1) % 3).cast("int")))
    d = written(d.select("mrna", "seqid", F.when(F.col("mrna") % 2 == 0, "+").otherwise("-").alias("strand"), F.filter(both, lambda x: x["end"] >= x["start"]).alias("parts")), "models")
    return d.select("mrna", "seqid", "strand"), d.select("mrna", F.inline("parts")), store


def mended_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coding parts after the search for missing stop and start codons, and whether all was found."""
    models, cds, store = _models(spark, sf_dir)
    status, parts = ends.mended(models, cds, store)
    return parts.join(status, "mrna").select(F.col("mrna").alias("doc_id"), "start", "end", "phase", "needed", "ok")


def repaired_exons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exons that agree with the coding parts of their model: items of an order, three lines as coding parts, the rest as exons."""
    l = read(spark, sf_dir, "lineitem")
    start = F.col("l_linenumber").cast("long") * 100 + F.col("l_partkey") % 150
    t = l.select(F.col("l_orderkey").alias("mrna"), "l_linenumber", start.alias("start"), (start + F.col("l_quantity").cast("long") * 2).alias("end"))
    parts = t.where("l_linenumber IN (1, 3, 7)").drop("l_linenumber"), t.where("l_linenumber NOT IN (1, 3, 7)").drop("l_linenumber")
    exons, introns = ends.repaired_exons(*parts)
    return exons.withColumn("type", F.lit("exon")).unionByName(introns.withColumn("type", F.lit("intron")))


QUERIES = {f.__name__: f for f in (mended_ends, repaired_exons)}
ORACLES = {
    # everything on a plus strand: models on the other are mirrored first, and mirrored back at the end
    "mended_ends": f"""WITH {MODELS_SQL}, o AS (SELECT doc_id, n, strand, CASE WHEN strand = '+' THEN s ELSE translate(reverse(s), 'ACGT', 'TGCA') END AS r, e >= c AS two, f, (f + 1) % 3 AS f2, a, b, c, e FROM m),
      q AS (SELECT doc_id, n, strand, r, two, CASE WHEN strand = '+' OR NOT two THEN f ELSE f2 END::INT AS f1, CASE WHEN strand = '+' AND two THEN f2 ELSE f END::INT AS fl, CASE WHEN strand = '+' THEN a WHEN two THEN n + 1 - e ELSE n + 1 - b END AS a1, CASE WHEN strand = '+' THEN b WHEN two THEN n + 1 - c ELSE n + 1 - a END AS b1,
        CASE WHEN strand = '+' THEN CASE WHEN two THEN c ELSE a END ELSE n + 1 - b END AS a2, CASE WHEN strand = '+' THEN CASE WHEN two THEN e ELSE b END ELSE n + 1 - a END AS b2 FROM o),
      j AS (SELECT *, CASE WHEN two THEN r[a1:b1] || r[a2:b2] ELSE r[a1:b1] END AS sp FROM q),
      w AS (SELECT *, NOT (strlen(sp) - f1 >= 3 AND sp[f1 + 1:f1 + 3] = 'ATG') AS no_start, NOT (strlen(sp) - f1 >= 3 AND right(sp, 3) IN ('TAA', 'TAG', 'TGA')) AS no_stop, b2 - (((b2 - a2 - fl + 1) % 3) + 3) % 3 AS cut FROM j),
      x AS (SELECT *, regexp_extract(r[cut + 1:], '^((?:...)*?)(TAA|TAG|TGA)', ['skip', 'hit']) AS ahead FROM w), y AS (SELECT *, CASE WHEN no_stop AND ahead.hit <> '' THEN cut + strlen(ahead.skip) + 3 ELSE b2 END AS e2, no_stop AND ahead.hit = '' AS lost_stop FROM x),
      z AS (SELECT *, CASE WHEN two THEN b1 ELSE e2 END AS e1, greatest(a1 + f1 - 1, 0) // 3 * 3 AS room FROM y), z1 AS (SELECT *, regexp_extract(r[a1 + f1 - room:a1 + f1 - 1], '^((?:...)*)(TAA|TAG|TGA)', ['skip', 'hit']) AS back FROM z),
      z2 AS (SELECT *, a1 + f1 - room + strlen(back.skip) AS up FROM z1), z3 AS (SELECT *, CASE WHEN two THEN r[up:e1] || r[a2:e2] ELSE r[up:e1] END AS wide FROM z2),
      z4 AS (SELECT *, regexp_extract(wide, '^((?:...)*?)(ATG)', ['skip', 'hit']) AS st FROM z3),
      z5 AS (SELECT *, no_start AND NOT (back.hit <> '' AND st.hit <> '' AND strlen(wide) - strlen(st.skip) >= 6) AS lost_start, strlen(st.skip) AS rem FROM z4), z6 AS (SELECT *, no_start AND NOT lost_start AS moved, e1 - up + 1 AS len1 FROM z5),
      z7 AS (SELECT *, CASE WHEN moved THEN up + rem ELSE a1 END AS s1, NOT moved OR len1 > rem AS has1, CASE WHEN moved THEN 0 ELSE f1 END AS g1, CASE WHEN moved AND rem > len1 THEN a2 + rem - len1 ELSE a2 END AS s2, CASE WHEN moved AND rem > len1 THEN 0 ELSE fl END AS g2 FROM z6),
      u AS (SELECT doc_id, n, strand, s1 AS s, e1 AS e, g1 AS g, no_stop OR no_start AS needed, NOT (lost_stop OR lost_start) AS ok FROM z7 WHERE has1 UNION ALL SELECT doc_id, n, strand, s2, e2, g2, no_stop OR no_start, NOT (lost_stop OR lost_start) FROM z7 WHERE two)
      SELECT doc_id, CASE WHEN strand = '+' THEN s ELSE n + 1 - e END AS "start", CASE WHEN strand = '+' THEN e ELSE n + 1 - s END AS "end", g::INT AS phase, needed, ok FROM u""",
    "repaired_exons": """WITH t AS (SELECT l_orderkey AS mrna, l_linenumber IN (1, 3, 7) AS cds, l_linenumber * 100 + l_partkey % 150 AS s, l_linenumber * 100 + l_partkey % 150 + l_quantity::BIGINT * 2 AS e FROM lineitem),
      g AS (SELECT mrna, cds, e + 1 AS s, lead(s) OVER (PARTITION BY mrna, cds ORDER BY s, e) - 1 AS e FROM t), k AS (SELECT * FROM g WHERE e >= s),
      i AS (SELECT mrna, s, e FROM k WHERE cds UNION SELECT mrna, s, e FROM k a WHERE NOT cds AND NOT EXISTS (SELECT 1 FROM k b WHERE b.cds AND b.mrna = a.mrna AND b.s <= a.e AND b.e >= a.s)
        AND NOT EXISTS (SELECT 1 FROM k b WHERE NOT b.cds AND b.mrna = a.mrna AND b.s <= a.e AND b.e >= a.s AND b.s < a.s)),
      b AS (SELECT mrna, min(s) AS lo, max(e) AS hi FROM t GROUP BY 1), c AS (SELECT mrna, lo AS p, 0 AS o FROM b UNION ALL SELECT mrna, e + 1, 1 FROM i), f AS (SELECT mrna, hi AS p, 1 AS o FROM b UNION ALL SELECT mrna, s - 1, 0 FROM i),
      c1 AS (SELECT *, row_number() OVER (PARTITION BY mrna ORDER BY o, p) AS k FROM c), f1 AS (SELECT *, row_number() OVER (PARTITION BY mrna ORDER BY o, p) AS k FROM f)
      SELECT mrna, c1.p AS "start", f1.p AS "end", 'exon' AS type FROM c1 JOIN f1 USING (mrna, k) UNION ALL SELECT mrna, s, e, 'intron' FROM i""",
}
