"""Steps over many small groups shuffle them once; large groups go by ranges, with the same result."""

import random

from locusloom.operators import scoring


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def tables(spark):
    rng = random.Random(5)
    rows = [(f"c{rng.randrange(2)}", s, s + rng.randrange(1, 50), rng.choice("+-"), f"p{rng.randrange(30)}") for s in (rng.randrange(20_000) for _ in range(900))]
    genes = [(f"p{k}", f"G{k // 4}" if k % 3 else None) for k in range(30)]
    return spark.createDataFrame(rows + rows[:20], "chrom string, start long, end long, strand string, prot string"), spark.createDataFrame(genes, "transcript_id string, gene_id string")


def test_small_groups_are_shuffled_once(spark, monkeypatch):
    regions, genes = tables(spark)
    for parity in (False, True):
        small = scoring.region_clusters(regions, genes, 60, parity)
        assert exchanges(small) == 1
        monkeypatch.setattr(scoring, "WHOLE", 1)
        large = scoring.region_clusters(regions, genes, 60, parity)
        monkeypatch.undo()
        assert sorted(small.collect()) == sorted(large.collect())


def test_neighbours_are_told_once_without_comparing_pairs(spark):
    regions, _ = tables(spark)
    r = regions.withColumnRenamed("prot", "gene")
    near = scoring.neighbours(r, 70)
    rows = {(x.chrom, x.gene, x.start, x.end) for x in r.collect()}
    want = sorted((*a, *b[2:]) for a in rows for b in rows if a[:2] == b[:2] and a != b and any(abs(x - y) <= 70 for x in a[2:] for y in b[2:]))
    assert sorted(map(tuple, near.collect())) == want
    plan = near._jdf.queryExecution().optimizedPlan().toString()
    assert plan.splitlines()[0].startswith("Project")  # pairs used to be made distinct, in a shuffle of their own
