"""Refining where genes lie on one another: no alternative is left, and no pairs are made to see that."""

import random
import time

from locusloom.operators import merge


def test_places_that_meet_one_gene_at_most(spark):
    r = random.Random(8)
    genes = [(f"g{k}", "c", "+-"[k % 2], s := r.randrange(3000), s + r.randrange(60, 300)) for k in range(60)]
    genes += [(f"h{k}", *g[1:]) for k, g in enumerate(genes[:8])]
    alts = [(f"x{k}", "c", "+-"[k % 2], s := r.randrange(3000), s + r.randrange(20, 250)) for k in range(300)]
    cols = "chrom string, strand string, start long, end long"
    got = merge.unblocked(spark.createDataFrame(alts, f"alt string, {cols}"), spark.createDataFrame(genes, f"gene string, {cols}"), 0.3)
    want = set()
    for _, c, st, s, e in alts:
        met = {g for g, gc, gst, gs, ge in genes if (gc, gst) == (c, st) and gs <= e and s <= ge and (min(e, ge) - max(s, gs) + 1) / (ge - gs + 1) > 0.3}
        if len(met) < 2:
            want.add((c, st, s, e, min(met, default=None)))
    rows = [tuple(x) for x in got.select("chrom", "strand", "start", "end", "only").collect()]
    assert set(rows) == want and len(rows) == len(want) and 20 < len(want) < 290


def test_registered_query_makes_no_pairs(spark, tmp_path):
    from locusloom.plans import catalogue

    # 3000 genes and 6000 alternatives at each of four places, and one gene that lies alone
    places = spark.range(12_000).selectExpr("id % 4 * 10 + id div 4 * 4000000 AS o_orderkey", "id % 97 AS o_custkey")
    places.unionByName(spark.createDataFrame([(20_000, 3)], "o_orderkey long, o_custkey long")).write.parquet(f"{tmp_path}/orders.parquet")
    began = time.monotonic()
    assert {x.gene for x in catalogue.QUERIES["refined_genes"](spark, str(tmp_path)).collect()} <= {"g20000"}
    assert time.monotonic() - began < 60
