"""Following links from row to row by pointer doubling: as many rounds as the logarithm of the longest path.

Tables of links grow with the rows and their files are small: joins ask for a merge, or Spark would send them through the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..written import written

#: No path of links between rows can be longer than two to this power.
MOST_ROUNDS = 60


def followed(starts: DataFrame, links: DataFrame, by: Sequence[str], at: str = "at", to: str = "to") -> DataFrame:
    """All places (``by``, ``at``) that links (``by``, ``at``, ``to``; one for each place, ``to`` null at an end) lead to from
    ``starts``, which are among them. Paths of different starts must not meet, nor run in circles."""
    here = [*by, at]
    jump = written(links.where(F.col(to).isNotNull()).select(*here, to), "jump")
    path = written(starts.select(*here), "path")
    for _ in range(MOST_ROUNDS):
        # the path holds the first 2^k places of each chain, and a jump is 2^k links long
        more = written(path.join(jump.hint("merge"), here).select(*by, F.col(to).alias(at)), "path")
        if more.isEmpty():
            return path
        path = path.unionByName(more)
        over = jump.select(*by, F.col(at).alias(to), F.col(to).alias("_over"))
        jump = written(jump.join(over.hint("merge"), [*by, to]).select(*here, F.col("_over").alias(to)), "jump")
    raise ValueError("links run in circles")


def rooted(links: DataFrame, node: str = "id", parent: str = "parent") -> DataFrame:
    """The top of every node's line of parents: ``node, root, depth``. ``links``: one row per node, ``parent`` null or
    unknown at the top. Nodes on a circle of parents, and those below one, get a null root and depth.

    Every node holds a link to an ancestor 2^k steps up; each round joins it with that ancestor's own."""
    t = links.select(F.col(node).alias("node"), F.col(parent).alias("up")).dropDuplicates(["node"])
    known = t.select(F.col("node").alias("_n"))
    t = t.join(known.hint("merge"), F.col("up") == F.col("_n"), "left").select("node", F.col("_n").alias("up"), F.when(F.col("_n").isNotNull(), 1).otherwise(0).cast("long").alias("depth"))
    t = written(t.withColumn("root", F.when(F.col("up").isNull(), F.col("node"))), "links")
    count, k = None, 0
    while True:
        left = t.where(F.col("root").isNull()).count()
        k += 1
        if not left or (count == left and 1 << k > 2 * left) or k > MOST_ROUNDS:  # what is left after so many steps is a circle
            break
        count = left
        above = t.select(F.col("node").alias("_a"), F.col("up").alias("_up"), F.col("depth").alias("_d"), F.col("root").alias("_r"))
        t = written(t.join(above.hint("merge"), F.col("up") == F.col("_a"), "left").select("node", F.when(F.col("root").isNull(), F.col("_up")).otherwise(F.col("up")).alias("up"), F.when(F.col("root").isNull(), F.col("depth") + F.coalesce("_d", F.lit(0).cast("long"))).otherwise(F.col("depth")).alias("depth"), F.coalesce("root", "_r").alias("root")), "links")
    return t.select(F.col("node").alias(node), "root", F.when(F.col("root").isNotNull(), F.col("depth")).alias("depth"))


def components(links: DataFrame, node: str = "node", key: str = "key") -> DataFrame:
    """``node, component`` (its smallest node) of nodes that are tied by common keys (``node``, ``key``). Keys take the least
    label of their nodes and nodes the least of their keys, then every label is replaced by its own label: rounds grow
    with the logarithm of the longest way. Work is one row per link; a key with many nodes is an aggregation."""
    ties = written(links.select(F.col(node).alias("n"), F.col(key).alias("k")).distinct(), "ties")
    label = written(ties.select("n").distinct().withColumn("c", F.col("n")), "labels")
    while True:
        least = ties.join(label, "n").groupBy("k").agg(F.min("c").alias("c"))
        near = ties.join(least, "k").groupBy("n").agg(F.min("c").alias("near"))
        of = label.select(F.col("n").alias("_n"), F.col("c").alias("_c"))
        after = label.join(near, "n").join(of, F.col("near") == F.col("_n")).select("n", F.least("near", "_c").alias("c"), (F.least("near", "_c") < F.col("c")).alias("changed"))
        after = written(after, "labels")
        label = after.select("n", "c")
        if after.where("changed").isEmpty():
            return label.select(F.col("n").alias(node), F.col("c").alias("component"))
