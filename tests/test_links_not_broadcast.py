"""Tables of links grow with the rows: they must not be broadcast because their files are small."""

from locusloom.operators import chains, tree


def broadcasts(df):
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange")


def test_closures_do_not_pass_the_driver(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(chains, "written", lambda df, name: seen.append(broadcasts(df)) or df.localCheckpoint())
    t = spark.range(400).selectExpr("id AS line_no", "id AS start", "id AS end", "concat('n', id) AS id", "IF(id > 0, array(concat('n', id div 3)), NULL) AS parents")
    out = tree.closure(t)
    assert broadcasts(out) == 0 and sum(seen) == 0 and len(seen) > 2
    assert out.where("root = 'n0'").count() == 400
    seen.clear()
    links = spark.range(50).selectExpr("'c' AS g", "id AS at", "IF(id < 49, id + 1, NULL) AS to")
    assert chains.followed(spark.range(1).selectExpr("'c' AS g", "id AS at"), links, ["g"]).count() == 50 and sum(seen) == 0
