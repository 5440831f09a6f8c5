"""Ids that are lost with mRNAs."""

import random

from locusloom.operators import sets, tree


def test_ids_lost_with_mrnas(spark):
    random.seed(5)
    rows = []
    for g in range(60):
        rows.append((f"g{g}", "gene", None))
        for m in range(random.choice((1, 1, 2, 3))):
            rows.append((f"m{g}.{m}", "mRNA", [f"g{g}"]))
            for _ in range(random.choice((0, 1, 2))):
                parents = random.choice(([f"m{g}.{m}"], [f"m{g}.{m}", f"m{(g + 1) % 60}.0"], None, []))
                rows.append((random.choice((f"c{g}.{random.randrange(3)}", None, f"m{g}.{m}")), random.choice(("exon", "CDS", "intron")), parents))
    t = spark.createDataFrame([(k, "s", kind, 1, 9, "+", i, p) for k, (i, kind, p) in enumerate(rows)], "line_no long, seqid string, type string, start long, end long, strand string, id string, parents array<string>")
    bad = tree.childless(t)
    want = {(r.type, r.id) for r in sets.removed(t, tree.without_mrnas(t, bad), "x").collect()}
    got = [(r.type, r.id) for r in tree.lost_with_mrnas(t, bad).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 20
