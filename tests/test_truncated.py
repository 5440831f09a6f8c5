"""Truncated genes without pairs of genes and alternatives."""

import random
import time

from locusloom.operators import merge


def models(spark, r, name, n, span):
    rows, parts = [], []
    for k in range(n):
        s = r.randrange(span)
        rows.append((f"{name}{k}", "c", "+-"[k % 2], s, s + r.randrange(80, 420)))
        parts.extend((f"{name}{k}", s + 40 * i + r.randrange(12), s + 40 * i + r.randrange(12, 40)) for i in range(r.randrange(0, 6)))
    key = "gene" if name == "g" else "alt"
    return spark.createDataFrame(rows, f"{key} string, chrom string, strand string, start long, end long"), spark.createDataFrame(parts, f"{key} string, start long, end long")


def test_same_genes_as_from_pairs(spark):
    r = random.Random(4)
    (genes, gene_cds), (alts, alt_cds) = models(spark, r, "g", 150, 6000), models(spark, r, "x", 90, 6000)
    pairs = merge.reciprocal(genes, alts.withColumnsRenamed({"start": "b_start", "end": "b_end"}), 0.3)
    want = {x.gene for x in merge.truncated(pairs.select("gene", "start", "end", "alt", "b_start", "b_end"), gene_cds, alt_cds).collect()}
    got = [x.gene for x in merge.truncated_by_any(genes, alts, gene_cds, alt_cds).collect()]
    assert set(got) == want and len(got) == len(want) and 10 < len(want) < 140


def test_registered_query_makes_no_pairs(spark, tmp_path):
    from locusloom.plans import catalogue

    # 3000 genes and 6000 alternatives at each of four places: 72 million pairs
    spark.range(12_000).selectExpr("id % 4 * 10 + id div 4 * 4000000 AS o_orderkey", "id % 97 AS o_custkey").write.parquet(f"{tmp_path}/orders.parquet")
    began = time.monotonic()
    assert catalogue.QUERIES["truncated_genes"](spark, str(tmp_path)).count() == 12_000
    assert time.monotonic() - began < 60
