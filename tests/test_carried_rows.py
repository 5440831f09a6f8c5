"""Heads carried forward over rows, and merged sets, take each row through as few steps as they need."""

import pyspark.sql.functions as F

from locusloom.operators import modelset, tree

GFF = "line_no long, seqid string, source string, type string, start long, end long, score double, strand string, phase int, attributes string"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_heads_are_carried_by_one_sort(spark):
    t = spark.range(4000).selectExpr("id AS line_no", "IF(id % 700 = 5, CONCAT('h', id), NULL) AS head")
    got = tree._lines(t, F.when(F.col("head").isNotNull(), F.struct("line_no", F.col("head").alias("x"))), size=64)
    assert "Join" not in plan(got)  # a join sorts the rows a second time, in the same task
    rows = {r.line_no: r._last and r._last.x for r in got.collect()}
    assert len(rows) == 4000 and all(v == (f"h{(k - 5) // 700 * 700 + 5}" if k >= 5 else None) for k, v in rows.items())


def models(spark, name, n):
    rows = []
    for g in range(n):
        for k, (kind, text) in enumerate((("gene", f"ID={name}{g}"), ("mRNA", f"ID={name}{g}.t1;Parent={name}{g}"))):
            rows.append((10 * g + k, "c", "s", kind, 100 * g, 100 * g + 50, None, "+", None, text))
    return spark.createDataFrame(rows, GFF)


def test_decisions_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    def seen(status):
        made.add(1)
        return status

    status = F.udf(seen, "string").asNondeterministic()
    d = spark.createDataFrame([(f"a{g}", f"b{g}", "replaces" if g % 2 else "rescued") for g in range(6)], "gene string, partner string, status string")
    out = modelset.merged(models(spark, "a", 6), models(spark, "b", 6), d.withColumn("status", status("status")))
    got = sorted(r.attributes for r in out.where("type = 'gene'").collect())
    assert got == sorted([f"ID=b{g}" for g in (0, 2, 4)] + [f"ID=a{g}" for g in range(6)])
    assert made.value == 6
