"""Growing tables must not be broadcast because their file is small."""

import pytest

from locusloom.plans import catalogue


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("small"))
    spark.range(2000).selectExpr("id AS o_orderkey", "id % 97 AS o_custkey").write.parquet(f"{at}/orders.parquet")
    return at


def broadcasts(df):
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange")


@pytest.mark.parametrize("name", ["rebuilt_genes", "refined_rows", "refined_genes"])
def test_models_do_not_pass_the_driver(spark, tables, name):
    assert broadcasts(catalogue.QUERIES[name](spark, tables)) == 0
