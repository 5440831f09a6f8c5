"""A forest of trees on bootstrap samples that are known afterwards, so that each row can be judged by the trees that
did not see it.

How often a tree draws a row follows from a hash of the row's key and the tree's number: Poisson with mean 1, the
limit of drawing with replacement. Nothing is stored, and any executor finds the same draws. Trees are fitted on
weighted rows, several at a time; votes of unseen trees are added up per row, some trees in each pass.
"""

from __future__ import annotations

from math import exp, factorial
from multiprocessing.pool import ThreadPool

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..written import written

#: A row is drawn at most this often; more has a probability below 1e-9.
MOST = 11


def draws(key: Column, tree: int, seed: int) -> Column:
    """How often a tree's sample holds the row."""
    u = F.pmod(F.xxhash64(key, F.lit(tree), F.lit(seed)), F.lit(1 << 53)) / float(1 << 53)
    below = [sum(exp(-1) / factorial(i) for i in range(k + 1)) for k in range(MOST)]
    return sum(((u >= p).cast("int") for p in below[1:]), (u >= below[0]).cast("int"))


def bag(rows: DataFrame, trees: int, per_split: int, seed: int, key: str = "transcript_id", at_once: int = 4) -> list[RandomForestClassificationModel | None]:
    """Trees on their samples of ``rows`` (``key``, ``x``, ``y``; a written table). A tree whose sample holds one class only, or
    no row, is None."""

    def grow(t: int) -> RandomForestClassificationModel | None:
        sample = rows.withColumn("w", draws(F.col(key), t, seed).cast("double")).where("w > 0")
        if sample.select("y").distinct().count() < 2:
            return None
        return RandomForestClassifier(featuresCol="x", labelCol="y", weightCol="w", numTrees=1, bootstrap=False, featureSubsetStrategy=str(per_split), seed=seed + t, maxDepth=20, minInstancesPerNode=1).fit(sample)

    with ThreadPool(at_once) as pool:
        return pool.map(grow, range(trees))


def out_of_bag(rows: DataFrame, models: list[RandomForestClassificationModel | None], seed: int, key: str = "transcript_id", together: int = 10) -> DataFrame:
    """``key, y, unseen, p``: how many trees did not see the row, and their mean probability of class 1 (null if all did)."""
    base = rows.select(key, "y", "x")
    passes = []
    some = [(t, m) for t, m in enumerate(models) if m is not None]
    for k in range(0, len(some), together):
        now, p, n = base, F.lit(0.0), F.lit(0)
        for t, m in some[k : k + together]:
            now = m.transform(now).withColumn(f"p{t}", vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction")
            unseen = draws(F.col(key), t, seed) == 0
            p, n = p + F.when(unseen, F.col(f"p{t}")).otherwise(0.0), n + unseen.cast("int")
        passes.append(written(now.select(key, "y", p.alias("p"), n.alias("n")), "votes"))
    if not passes:
        return base.select(key, "y", F.lit(0).cast("long").alias("unseen"), F.lit(None).cast("double").alias("p"))
    every = passes[0]
    for t in passes[1:]:
        every = every.unionByName(t)
    total = every.groupBy(key).agg(F.first("y").alias("y"), F.sum("n").alias("unseen"), F.sum("p").alias("p"))
    return total.select(key, "y", "unseen", F.when(F.col("unseen") > 0, F.col("p") / F.col("unseen")).alias("p"))


def error(votes: DataFrame) -> float | None:
    """The share of judged rows whose call is wrong; null if no row was judged."""
    wrong, seen = votes.where("unseen > 0").agg(F.count_if((F.col("p") > 0.5) != (F.col("y") == 1)), F.count(F.lit(1))).first()
    return wrong / seen if seen else None
