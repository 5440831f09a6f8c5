"""Queries over gene trees. An order is a gene, an (order, supplier group) an mRNA, a line item a child."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import tree
from ..written import written
from .adapters import hours, read

ITEM_SQL = """
it AS (SELECT l_orderkey AS k, l_suppkey % 5 AS s, l_linenumber AS n, l_partkey AS p, l_suppkey // 5 % 1000 AS u, 'Chr' || (l_orderkey % 12 + 1) AS seqid, CASE WHEN l_linestatus = 'F' THEN '+' ELSE '-' END AS strand, 'g' || l_orderkey AS gene, 'm' || l_orderkey || '.' || (l_suppkey % 5) AS mrna,
  ['CDS', 'exon', 'CDS', 'exon', 'five_prime_UTR', 'intron', 'CDS'][l_linenumber] AS type, (date_diff('day', DATE '1992-01-01', l_shipdate::DATE) * 60 + l_linenumber)::BIGINT AS "start", (date_diff('day', DATE '1992-01-01', l_shipdate::DATE) * 60 + l_linenumber + l_quantity::BIGINT)::BIGINT AS "end",
  CASE WHEN l_partkey % 10 = 0 THEN ['m' || l_orderkey || '.' || (l_suppkey % 5), 'm' || l_orderkey || '.' || ((l_suppkey + 1) % 5)] ELSE ['m' || l_orderkey || '.' || (l_suppkey % 5)] END AS parents FROM lineitem)"""
GFF_SQL = ITEM_SQL + """,
gff AS (SELECT ((k * 1000 + 100 + s * 100 + n) * 100000 + p) * 1000 + u AS line_no, seqid, type, "start", "end", strand, 'c' || k || '.' || (n % 3) AS id, parents FROM it
  UNION ALL SELECT (k * 1000 + 100 + s * 100) * 100000000, min(seqid), 'mRNA', min("start"), max("end"), min(strand), min(mrna), [min(gene)] FROM it GROUP BY k, s
  UNION ALL SELECT k * 100000000000, min(seqid), CASE WHEN k % 40 = 0 THEN 'ncRNA_gene' ELSE 'gene' END, min("start"), max("end"), min(strand), min(gene), NULL FROM it WHERE k % 50 <> 0 GROUP BY k)"""


def gff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feature table with shared children, children that repeat ids, mRNAs without a gene and non-coding genes."""
    l = read(spark, sf_dir, "lineitem")
    start = F.datediff(F.to_date("l_shipdate"), F.lit("1992-01-01").cast("date")).cast("long") * 60 + F.col("l_linenumber")
    k, s, n = F.col("l_orderkey"), F.col("l_suppkey") % 5, F.col("l_linenumber")
    mrna = lambda x: F.concat(F.lit("m"), k.cast("string"), F.lit("."), x.cast("string"))
    kinds = F.array(*[F.lit(x) for x in ("CDS", "exon", "CDS", "exon", "five_prime_UTR", "intron", "CDS")])
    it = l.select(
        k.alias("k"), s.alias("s"), n.alias("n"), F.col("l_partkey").alias("p"), F.floor(F.col("l_suppkey") / 5 % 1000).alias("u"), F.concat(F.lit("Chr"), (k % 12 + 1).cast("string")).alias("seqid"), F.when(F.col("l_linestatus") == "F", "+").otherwise("-").alias("strand"),
        F.element_at(kinds, n.cast("int")).alias("type"), start.alias("start"), (start + F.col("l_quantity").cast("long")).alias("end"),
        F.when(F.col("l_partkey") % 10 == 0, F.array(mrna(s), mrna((F.col("l_suppkey") + 1) % 5))).otherwise(F.array(mrna(s))).alias("parents"),
    )
    line = F.col("k") * 1000 + 100 + F.col("s") * 100
    cols = ["seqid", "type", "start", "end", "strand", "id", "parents"]
    # what follows from the order and the group is made after both are summed up, so that only numbers are shuffled
    span = [F.min("start").alias("start"), F.max("end").alias("end"), F.min("strand").alias("strand")]
    seqid, gene = F.concat(F.lit("Chr"), (F.col("k") % 12 + 1).cast("string")).alias("seqid"), F.concat(F.lit("g"), F.col("k").cast("string"))
    of = F.concat(F.lit("m"), F.col("k").cast("string"), F.lit("."), F.col("s").cast("string"))
    rest = it.withColumn("id", F.concat(F.lit("c"), F.col("k").cast("string"), F.lit("."), (F.col("n") % 3).cast("string"))).select((((line + F.col("n")) * 100_000 + F.col("p")) * 1000 + F.col("u")).alias("line_no"), *cols)
    mrnas = it.groupBy("k", "s").agg(*span).select((line * 100_000_000).alias("line_no"), seqid, F.lit("mRNA").alias("type"), "start", "end", "strand", of.alias("id"), F.array(gene).alias("parents"))
    genes = it.where("k % 50 <> 0").groupBy("k").agg(*span).select((F.col("k") * 100_000_000_000).alias("line_no"), seqid, F.when(F.col("k") % 40 == 0, "ncRNA_gene").otherwise("gene").alias("type"), "start", "end", "strand", gene.alias("id"), F.lit(None).cast("array<string>").alias("parents"))
    return rest.unionByName(mrnas).unionByName(genes).withColumn("source", F.lit("src"))


def linked_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree.linked(gff(spark, sf_dir)).select("line_no", "type", "id", "gene", "mrna")


def _after(t: DataFrame) -> DataFrame:
    """What a cascade leaves: rows, lines and genes by type."""
    return t.groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("line_no") % 1_000_003).alias("lines"))


def childless_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without mRNAs that have no exon or CDS, genes emptied by that, and children of dropped mRNAs only."""
    t = gff(spark, sf_dir)
    return _after(tree.without_mrnas(t, tree.childless(t)))


def childless_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without mRNAs that have no child of any kind; exons and CDS of many parts name a parent that isn't there."""
    t = gff(spark, sf_dir)
    lost = F.col("type").isin("CDS", "exon") & (F.expr("line_no div 1000") % 10 >= 4)  # as whole numbers: doubles don't hold long lines
    t = t.withColumn("parents", F.when(lost, F.array(F.lit("lost"))).otherwise(F.col("parents")))
    return _after(tree.without_mrnas(t, tree.childless(t, any_child=True)))


def strand_against_mrna(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree.strand_conflicts(gff(spark, sf_dir))


def chimera_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = gff(spark, sf_dir)
    return _after(tree.without_mrnas(t, tree.chimeric(t, 1, 25)))


def training_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = gff(spark, sf_dir)
    return _after(tree.without_mrnas(t, tree.invalid_training(t)))


def phantom_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genes past the end of their sequence go, and all below them."""
    t = gff(spark, sf_dir)
    lengths = t.where("type = 'mRNA'").groupBy("seqid").agg((F.max("end") - 3000).alias("length"))
    return _after(tree.beyond_end(t, lengths))


def renumber_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The id map after renumbering genes by sequence, isoforms by gene, and children by mRNA and type."""
    t = tree.linked_apart(gff(spark, sf_dir))
    return tree.renumbered(t, "Osa", digits=2).select("line_no", "type", F.col("id").alias("old_id"), "new_id")


def file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each line stands in the sorted file."""
    t = tree.places(tree.linked_apart(gff(spark, sf_dir)))
    return t.select("line_no", "seq_place", "gene_place", "inner_place")


def transcript_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree.transcripts(gff(spark, sf_dir)).drop("line_no")


def primary_isoform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree.primary(gff(spark, sf_dir))


def exon_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree.single_exon_mrnas(gff(spark, sf_dir))


def benchmark_gene_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = gff(spark, sf_dir)
    return tree.benchmark_count(t).select(F.lit("with genes").alias("table"), "n").unionByName(tree.benchmark_count(t.where("type <> 'gene'")).select(F.lit("without").alias("table"), "n"))


def training_flank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree.flank_length(gff(spark, sf_dir).where("type IN ('gene', 'ncRNA_gene')"), least=2)


def stretched_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds of mRNAs and outer exons after a third of the genes got a longer span."""
    t = tuple(x.where("gene IS NOT NULL") for x in tree.linked_apart(gff(spark, sf_dir)))
    spans = t[0].where("line_no % 300000000000 = 0").select("gene", (F.col("start") - 9).alias("new_start"), (F.col("end") + 7).alias("new_end"))
    return tree.stretched(t, spans).select("line_no", "type", "start", "end")


def last_gene_above(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line with the last gene line before it, by carrying a header forward."""
    t = gff(spark, sf_dir).withColumn("head", F.when(F.col("type") == "gene", F.col("id")))
    return tree.forward_fill(t, "head", "block").select("line_no", "block")


QUERIES = {f.__name__: f for f in (linked_tree, childless_cascade, childless_any, strand_against_mrna, chimera_cascade, training_sanitize, phantom_genes, renumber_ids, file_order, transcript_spans, primary_isoform, exon_counts, benchmark_gene_count, training_flank, stretched_genes, last_gene_above)}
_LINKED = GFF_SQL + """,
o AS (SELECT *, last_value(CASE WHEN type IN ('gene', 'ncRNA_gene') THEN type END IGNORE NULLS) OVER (ORDER BY line_no) AS top FROM gff),
gn AS (SELECT seqid AS gs, id AS gid FROM o WHERE type = 'gene'), mr AS (SELECT o.*, gid AS gene, id AS mrna FROM o LEFT JOIN gn ON gs = seqid AND gid = parents[1] WHERE type = 'mRNA'),
ch AS (SELECT o.*, m.gene, m.mrna FROM o JOIN mr m ON m.seqid = o.seqid AND m.id = o.parents[1] WHERE o.type NOT IN ('gene', 'mRNA', 'ncRNA_gene') AND coalesce(o.top, 'gene') = 'gene'),
cn AS (SELECT *, row_number() OVER (PARTITION BY seqid, mrna, id ORDER BY line_no) AS rn FROM ch),
tr AS (SELECT line_no, seqid, type, "start", "end", id, id AS gene, NULL AS mrna FROM o WHERE type = 'gene' UNION ALL SELECT line_no, seqid, type, "start", "end", id, gene, mrna FROM mr
  UNION ALL SELECT line_no, seqid, type, "start", "end", CASE WHEN rn > 1 THEN id || '_' || rn ELSE id END, gene, mrna FROM cn)"""


def _cascade(bad: str, base: str = "gff") -> str:
    return f"""bad AS ({bad}), em AS (SELECT parents[1] AS gene FROM {base} WHERE type = 'mRNA' GROUP BY 1 HAVING bool_and(id IN (SELECT mrna FROM bad))),
      kp AS (SELECT type, line_no FROM {base} WHERE type IN ('gene', 'mRNA') AND id NOT IN (SELECT mrna FROM bad) AND id NOT IN (SELECT gene FROM em)
        UNION ALL SELECT type, line_no FROM {base} WHERE type NOT IN ('gene', 'mRNA') AND (parents IS NULL OR EXISTS (SELECT 1 FROM (SELECT unnest(parents) AS p) WHERE p NOT IN (SELECT mrna FROM bad))))
      SELECT type, count(*) AS n, sum(line_no % 1000003)::BIGINT AS lines FROM kp GROUP BY 1"""


_KIDS = "kd AS (SELECT unnest(parents) AS mrna, type, strand, \"start\", \"end\" FROM gff WHERE type IN ('exon', 'CDS'))"
ORACLES = {
    "linked_tree": f"WITH {_LINKED} SELECT line_no, type, id, gene, mrna FROM tr",
    "childless_cascade": f"WITH {GFF_SQL}, {_KIDS}, " + _cascade("SELECT id AS mrna FROM gff WHERE type = 'mRNA' AND id NOT IN (SELECT mrna FROM kd)"),
    "childless_any": f"WITH {GFF_SQL}, g2 AS (SELECT * REPLACE (CASE WHEN type IN ('CDS', 'exon') AND line_no // 1000 % 10 >= 4 THEN ['lost'] ELSE parents END AS parents) FROM gff), " + _cascade("SELECT id AS mrna FROM g2 WHERE type = 'mRNA' AND id NOT IN (SELECT unnest(parents) FROM g2 WHERE type NOT IN ('gene', 'mRNA'))", "g2"),
    "strand_against_mrna": f"WITH {GFF_SQL}, {_KIDS}, b AS (SELECT mrna, strand FROM kd WHERE mrna IN (SELECT id FROM gff WHERE type = 'mRNA') UNION ALL SELECT id, strand FROM gff WHERE type = 'mRNA') SELECT mrna FROM b GROUP BY 1 HAVING count(DISTINCT strand) > 1",
    "chimera_cascade": f"WITH {GFF_SQL}, {_KIDS}, " + _cascade("SELECT mrna FROM kd GROUP BY 1 HAVING count(*) FILTER (type = 'exon') > 1 OR coalesce(sum(\"end\" - \"start\" + 1) FILTER (type = 'CDS'), 0) / 3 > 25"),
    "training_sanitize": f"WITH {GFF_SQL}, {_KIDS}, lg AS (SELECT mrna, \"start\", lag(\"end\") OVER (PARTITION BY mrna ORDER BY \"start\", \"end\") AS p FROM kd WHERE type = 'CDS'), " + _cascade("SELECT id AS mrna FROM gff WHERE type = 'mRNA' AND (id NOT IN (SELECT mrna FROM lg) OR id IN (SELECT mrna FROM lg WHERE \"start\" <= p))"),
    "phantom_genes": f"""WITH {GFF_SQL}, ln AS (SELECT seqid, max("end") - 3000 AS length FROM gff WHERE type = 'mRNA' GROUP BY 1), g0 AS (SELECT id FROM gff JOIN ln USING (seqid) WHERE type = 'gene' AND "end" > length),
      g1 AS (SELECT id FROM (SELECT id, unnest(parents) AS p FROM gff WHERE type <> 'gene') WHERE p IN (SELECT id FROM g0)), al AS (SELECT id FROM g0 UNION SELECT id FROM g1)
      SELECT type, count(*) AS n, sum(line_no % 1000003)::BIGINT AS lines FROM gff WHERE id NOT IN (SELECT id FROM al) AND line_no NOT IN (SELECT line_no FROM (SELECT line_no, unnest(parents) AS p FROM gff) WHERE p IN (SELECT id FROM al)) GROUP BY 1""",
    "renumber_ids": f"""WITH {_LINKED}, g AS (SELECT seqid, gene, 'Osa' || lpad(regexp_extract(seqid, '[0-9]+'), 2, '0') || 'G' || lpad(row_number() OVER (PARTITION BY seqid ORDER BY "start", line_no)::VARCHAR, 6, '0') || '0' AS ng FROM tr WHERE type = 'gene'),
      m AS (SELECT seqid, mrna, row_number() OVER (PARTITION BY seqid, gene ORDER BY "start", line_no) AS iso FROM tr WHERE type = 'mRNA')
      SELECT line_no, type, id AS old_id, CASE WHEN type = 'gene' THEN ng WHEN type = 'mRNA' THEN ng || '.t' || iso ELSE ng || '.t' || iso || '.' || lower(type) || row_number() OVER (PARTITION BY t.seqid, t.mrna, lower(type) ORDER BY line_no) END AS new_id FROM tr t JOIN g USING (seqid, gene) LEFT JOIN m USING (seqid, mrna)""",
    "file_order": f"""WITH {_LINKED}, q AS (SELECT seqid, row_number() OVER (ORDER BY seqid[4:])::INT AS seq_place FROM (SELECT DISTINCT seqid FROM tr)),
      t AS (SELECT seqid, coalesce(gene, mrna) AS top, row_number() OVER (PARTITION BY seqid ORDER BY "start", line_no) AS gene_place FROM tr WHERE type = 'gene' OR (type = 'mRNA' AND gene IS NULL)), m AS (SELECT seqid, mrna, "start" AS ms, line_no AS ml FROM tr WHERE type = 'mRNA')
      SELECT line_no, seq_place, gene_place, row_number() OVER (PARTITION BY x.seqid, coalesce(x.gene, x.mrna) ORDER BY CASE WHEN type = 'gene' THEN 0 ELSE 1 END, ms, ml, CASE WHEN type IN ('gene', 'mRNA') THEN 0 ELSE 1 END, line_no)::INT AS inner_place
      FROM tr x JOIN q USING (seqid) JOIN t ON t.seqid = x.seqid AND t.top = coalesce(x.gene, x.mrna) LEFT JOIN m ON m.seqid = x.seqid AND m.mrna = x.mrna""",
    "transcript_spans": f"WITH {GFF_SQL} SELECT id AS transcript_id, parents[1] AS gene, seqid, \"start\", \"end\" FROM gff WHERE type = 'mRNA'",
    "primary_isoform": f"""WITH {GFF_SQL}, {_KIDS}, c AS (SELECT mrna, sum("end" - "start" + 1)::BIGINT AS bp FROM kd WHERE type = 'CDS' GROUP BY 1), m AS (SELECT id, parents[1] AS gene, line_no, bp FROM gff JOIN c ON mrna = id WHERE type = 'mRNA')
      SELECT gene, arg_min(id, {{'a': -bp, 'b': line_no}}) AS mrna, max(bp) AS cds_bp FROM m GROUP BY 1""",
    "exon_counts": f"""WITH {GFF_SQL}, {_KIDS}, c AS (SELECT mrna, count(*) FILTER (type = 'exon') AS e, count(*) FILTER (type = 'CDS') AS c FROM kd GROUP BY 1)
      SELECT id AS mrna, coalesce(CASE WHEN e > 0 THEN e ELSE c END, 0) AS exons, coalesce(CASE WHEN e > 0 THEN e ELSE c END, 0) <= 1 AS single FROM gff LEFT JOIN c ON mrna = id WHERE type = 'mRNA'""",
    "benchmark_gene_count": f"WITH {GFF_SQL} SELECT 'with genes' AS \"table\", count(*) AS n FROM gff WHERE type = 'gene' UNION ALL SELECT 'without', count(*) FROM gff WHERE type = 'mRNA'",
    "training_flank": f"""WITH {GFF_SQL}, x AS (SELECT *, "start" - max("end") OVER (PARTITION BY seqid ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1 AS gap FROM gff WHERE type IN ('gene', 'ncRNA_gene')),
      a AS (SELECT list_sort(list("end" - "start" + 1)) AS l FROM x), b AS (SELECT list_sort(list(greatest(gap, 0))) AS l FROM x WHERE gap IS NOT NULL), c AS (SELECT a.l[len(a.l) // 2 + 1] AS gm, b.l[len(b.l) // 2 + 1] AS pm FROM a, b)
      SELECT gm AS gene_median, pm AS gap_median, greatest(2, least(pm // 8, gm))::BIGINT AS flank FROM c""",
    "stretched_genes": f"""WITH {_LINKED}, s AS (SELECT gene, "start" - 9 AS ns, "end" + 7 AS ne FROM tr WHERE type = 'gene' AND line_no % 300000000000 = 0),
      w AS (SELECT *, min("start") FILTER (type = 'exon') OVER (PARTITION BY seqid, mrna) AS lo, max("end") FILTER (type = 'exon') OVER (PARTITION BY seqid, mrna) AS hi FROM tr LEFT JOIN s USING (gene) WHERE gene IS NOT NULL)
      SELECT line_no, type, CASE WHEN ns IS NOT NULL AND (type IN ('gene', 'mRNA') OR (type = 'exon' AND "start" = lo)) THEN ns ELSE "start" END AS "start", CASE WHEN ns IS NOT NULL AND (type IN ('gene', 'mRNA') OR (type = 'exon' AND "end" = hi)) THEN ne ELSE "end" END AS "end" FROM w""",
    "last_gene_above": f"WITH {GFF_SQL} SELECT line_no, last_value(CASE WHEN type = 'gene' THEN id END IGNORE NULLS) OVER (ORDER BY line_no) AS block FROM gff",
}
