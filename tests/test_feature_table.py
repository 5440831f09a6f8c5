"""What the feature table sends through its shuffles."""

from locusloom.plans.tree_plans import gff


def test_feature_table_shuffles_numbers_only(spark):
    plan = gff(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "min(start" in plan and "min(seqid" not in plan and "min(mrna" not in plan and "min(gene" not in plan
