"""Numbered features stay where their model is: few sorts, and the same rows as counted one by one."""

import random

from pyspark.sql import functions as F

from locusloom.operators import ends


def test_numbering_stays_with_the_model(spark):
    random.seed(9)
    models, cds, exons = [], [], []
    for k in range(60):
        m = (f"m{k}", "s", random.choice("+-"))
        models.append(m)
        for out in (cds, exons):
            at = random.randrange(50)
            for _ in range(random.randrange(4)):
                at += random.randrange(1, 20)
                out.append((m[0], at, at + random.randrange(12)))
                at = out[-1][2]
    part = "mrna string, start long, end long"
    ms, c, e = spark.createDataFrame(models, "mrna string, seqid string, strand string"), spark.createDataFrame(cds, part), spark.createDataFrame(exons, part)
    x, i = ends.repaired_exons(c, e)
    u = ends.outside(c, x, ms)
    coding = {m: [d[1:] for d in cds if d[0] == m] for m, _, _ in models}
    want = set()
    for m, s, t in {(r.mrna, r.start, r.end) for r in x.collect()}:
        own, marks = coding[m], sorted({p for d in coding[m] for p in d})
        met = [d for d in own if d[0] <= t and d[1] >= s]
        pieces = [(s, t)] if not met else [(s, d[0] - 1) for d in met if s < d[0] and t == d[1]] + [(d[1] + 1, t) for d in met if s == d[0] and t > d[1]]
        for a, b in pieces if marks else []:
            low, high = b <= marks[0], len(marks) > 1 and a >= marks[1]
            minus = dict((n, st) for n, _, st in models)[m] == "-"
            kind = ("five_prime_UTR" if high else "three_prime_UTR" if low else None) if minus else ("five_prime_UTR" if low else "three_prime_UTR" if high else None)
            if kind:
                want.add((m, kind, a, b))
    assert {tuple(r) for r in u.collect()} == want and len(want) > 20
    parts = c.withColumn("type", F.lit("CDS")).unionByName(x.withColumn("type", F.lit("exon"))).distinct()
    known = c.where("start % 3 > 0").join(ms, "mrna").select("mrna", "seqid", "strand", F.lit("CDS").alias("type"), "start", "end", F.col("start").cast("double").alias("score"), F.lit("ID=1;Note=a").alias("attributes"), F.lit(1).alias("line_no"))
    out = ends.numbered(ms, parts, known)
    assert ", seqid" not in "".join(line for line in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line)  # rows are dealt by model alone
    got = out.collect()
    assert len(got) == parts.count()
    for r in got:
        kept = r.type == "CDS" and r.start % 3 > 0
        assert (r.score, r.attributes.endswith(";Note=a;")) == ((float(r.start), True) if kept else (None, False))
    assert all(sorted(r.place for r in got if r.mrna == m) == list(range(1, sum(r.mrna == m for r in got) + 1)) for m, _, _ in models)
