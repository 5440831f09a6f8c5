"""Rows are shuffled as often as needed and no more: disk goes by that."""

from pyspark.sql import functions as F

from locusloom.operators import tree
from locusloom.operators.sweep import carried, previous, within


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def rows(spark):
    return spark.range(5000).selectExpr("id % 3 AS g", "id AS start", "id + 5 AS end")


def test_ranges_meet_their_carry_where_windows_need_them(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        c = carried(rows(spark), ["g"], F.col("start"), 64, {"_b": F.count(F.lit(1))})
        assert exchanges(c.withColumn("n", F.sum("end").over(within(["g"], "start")))) == exchanges(c)
        p = previous(rows(spark), ["g"], F.col("start"), ["start"], "end", 64)
        assert exchanges(p) == 4  # rows; the last of each range, their group, and the join
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_groups_without_a_name_have_a_carry(spark):
    t = spark.range(300).selectExpr("CAST(NULL AS string) AS g", "id AS start", "1L AS n")
    c = carried(t, ["g"], F.col("start"), 64, {"_b": F.sum("n")})
    got = c.select((F.coalesce("_b", F.lit(0)) + F.sum("n").over(within(["g"], "start"))).alias("k"), "start").collect()
    assert all(r.k == r.start + 1 for r in got) and len(got) == 300


def features(spark):
    shape = "line_no long, seqid string, source string, type string, start long, end long, strand string, id string, parents array<string>"
    out = []
    for g in range(40):
        n, at = g * 100, g * 50
        out.append((n, "Chr1", "x", "gene", at, at + 40, "+", f"g{g}", None))
        for m in range(2):
            out.append((n + 10 * m + 1, "Chr1", "x", "mRNA", at + m, at + 40, "+", f"g{g}.{m}", [f"g{g}"]))
            out.extend((n + 10 * m + 2 + k, "Chr1", "x", "exon", at + m + 9 * k, at + m + 9 * k + 4, "+", f"e{g}.{m}.{k}", [f"g{g}.{m}"]) for k in range(3))
    return spark.createDataFrame(out, shape)


def test_rows_below_meet_their_mrna_once(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = tree.linked(features(spark))
        assert exchanges(tree.places(t)) <= 10
        assert exchanges(tree.renumbered(t, "A")) <= 8
        spans = t.where("type = 'gene' AND start % 100 = 0").select("gene", (F.col("start") - 1).alias("new_start"), (F.col("end") + 1).alias("new_end"))
        got = {r.id: (r.start, r.end) for r in tree.stretched(t, spans).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got["g2"] == got["g2.1"] == (99, 141) and got["e2.1.0"] == (99, 105) and got["e2.1.1"] == (110, 114) and got["e2.1.2"] == (119, 141) and got["g1"] == (50, 90)
    order = [r.id for r in tree.in_order(t).collect()]
    assert order[:9] == ["g0", "g0.0", "e0.0.0", "e0.0.1", "e0.0.2", "g0.1", "e0.1.0", "e0.1.1", "e0.1.2"] and len(order) == 40 * 9


def test_loci_are_not_gathered_again(spark):
    from locusloom.operators import assign

    genes = spark.range(300).selectExpr("id AS line_no", "'c' AS seqid", "'+' AS strand", "id * 7 AS start", "id * 7 + id % 20 AS end")
    _, loci = assign.assigned(genes)
    assert exchanges(loci) <= 2
    assert loci.agg(F.sum("genes")).first()[0] == 300


def test_rows_below_stay_where_their_mrna_is(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = tree.linked_apart(features(spark))
        spans = t[0].where("start % 100 = 0").select("gene", (F.col("start") - 1).alias("new_start"), (F.col("end") + 1).alias("new_end"))
        below = t[2]
        assert exchanges(tree.stretched((t[0].limit(0), t[1], below), spans)) - exchanges(below) <= 5
        whole = tree.linked(features(spark))
        for f in (tree.places, lambda x: tree.renumbered(x, "A"), lambda x: tree.stretched(x, spans)):
            assert sorted(map(str, f(t).drop("parents").collect())) == sorted(map(str, f(whole).drop("parents").collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_whole_annotation_rows_are_shuffled_once(spark, monkeypatch):
    from locusloom.operators import assign

    seen, lines = [], assign._lines
    monkeypatch.setattr(assign, "_lines", lambda t, *more, **named: (seen.append("attributes" in t.columns), lines(t, *more, **named))[1])
    rows = [(1, "exon", "ID=e0"), (2, "mRNA", "ID=m0"), (3, "exon", "ID=e1"), (4, "gene", "ID=g1"), (5, "mRNA", "ID=m1"), (6, "ncRNA_gene", "ID=n"), (7, "mRNA", "ID=m2"), (8, "gene", "Name=x"), (9, "exon", "ID=e2"), (10, "gene", "ID=g2"), (11, "exon", "ID=e3"), (12, "mRNA", "ID=m3;primary=False"), (13, "CDS", "ID=c"), (14, "mRNA", "Name=y"), (15, "CDS", "ID=d")]
    t = spark.createDataFrame([(n, "c", "s", k, 10 * n, 10 * n + 5, None, "+", None, x) for n, k, x in rows], "line_no long, seqid string, source string, type string, start long, end long, score double, strand string, phase int, attributes string")
    got = sorted((r.line_no, r.gene_id, r.mrna_id, r.locus) for r in assign.annotated(t)[0].collect())
    assert got == [(1, None, None, None), (2, None, "m0", None), (3, None, "m0", None), (4, "g1", None, 1), (5, "g1", "m1", 1), (10, "g2", None, 2), (11, "g2", "m1", 2), (15, "g2", "m1", 2)]
    assert seen.count(True) == 1
