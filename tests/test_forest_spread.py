"""The forest's rows are spread over the cluster's cores, however small their files are."""

from pyspark.sql import functions as F

from locusloom.ml import filtering


def test_forests_learn_from_rows_on_all_cores(spark, monkeypatch):
    t = spark.range(400).coalesce(1).select(F.col("id").alias("transcript_id"), (F.col("id") % 10 / 10.0).alias("tpm"), *(F.lit(None).cast(k).alias(c) for c, k in (("rex_pident", "double"), ("blast_pident", "double"), ("pfam", "boolean"), ("repeat", "double"))))
    t = t.withColumn("label", F.when(F.col("transcript_id") % 10 > 6, "Keep").when(F.col("transcript_id") % 10 < 3, "Discard").otherwise("None"))
    parts, grow = [], filtering._forest

    class Watched:
        def __init__(self, *a, **more):
            self.forest = grow(*a, **more)

        def fit(self, known):
            parts.append(known.rdd.getNumPartitions())
            return self.forest.fit(known)

    monkeypatch.setattr(filtering, "_forest", Watched)
    kept, process = filtering.semi_supervised(t, ["tpm"], spark.createDataFrame([], "transcript_id long, status string"), trees=5, per_split=1, max_iter=2, errors=False)
    assert parts and set(parts) == {spark.sparkContext.defaultParallelism}
    first = process.orderBy("round").first()
    assert (first.keep, first.discard, first.undecided) == (120, 120, 160)
    assert {r.transcript_id for r in kept.where("reason = 'seed'").collect()} == {i for i in range(400) if i % 10 > 6}
