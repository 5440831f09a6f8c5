"""Connected components of an edge table, by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def _mark(edges: DataFrame) -> tuple:
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.shiftright(h, 24)), F.bit_xor(h)).first())


def components(edges: DataFrame, scratch: Scratch, tag: str, max_rounds: int = 60) -> DataFrame:
    """``node, comp`` for every node of ``edges`` (``a``, ``b``); ``comp`` is the smallest node reachable.

    Each step replaces edges by edges to a smaller neighbour, so that hub nodes only ever meet their pre-aggregated
    minimum; the rounds grow with the logarithm of the longest path.
    """
    e = scratch.cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{tag}-0")
    mark = _mark(e)
    for k in range(1, max_rounds + 1):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        small = large.join(low, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct()
        e = scratch.cut(small, f"{tag}-{k}")
        scratch.drop(f"{tag}-{k - 1}")
        was, mark = mark, _mark(e)
        if was == mark:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(roots)


def split_buckets(rows: DataFrame, labels: DataFrame, salt: int) -> DataFrame:
    """The rows of buckets with several components: ``comp``, the bucket's largest component (``major``) and a member
    of it chosen by hash (``pivot``). Nodes without a row in ``labels`` are components of their own."""
    r = rows.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    per = r.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n_comp"), F.max_by("node", F.xxhash64("node", F.lit(salt))).alias("pivot"))
    keys = per.groupBy("key").agg(F.max_by(F.struct("comp", "pivot"), F.struct("n_comp", "comp")).alias("top"), F.count(F.lit(1)).alias("comps"))
    return r.join(keys.where("comps > 1").select("key", F.col("top.comp").alias("major"), F.col("top.pivot").alias("pivot")), "key")


def central_pairs(rows: DataFrame) -> DataFrame:
    """In each bucket, the pairs ``a < b`` of its most central node (which shares most buckets with others, by their
    sizes) and every other node: the original of a family of copies is likelier to be near all of them."""
    weight = rows.groupBy("node").agg(F.sum("size").alias("weight"))
    low = rows.select("key", "node").join(weight, "node").groupBy("key").agg(F.max_by("node", F.struct("weight", -F.col("node"))).alias("pivot"))
    r = rows.join(low, "key").where("node <> pivot")
    return r.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()


def pivot_pairs(rows: DataFrame, labels: DataFrame, salt: int) -> DataFrame:
    """In each bucket, the pairs ``a < b`` of one node of its largest component and every node outside of that."""
    r = split_buckets(rows, labels, salt).where("comp <> major")
    return r.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()


def cross_pairs(rows: DataFrame, labels: DataFrame, also: str) -> DataFrame:
    """All pairs of nodes that share a bucket but not yet a component: ``a < b``.

    ``rows`` has ``key, node`` and what the condition ``also`` (on aliases ``x`` and ``y``) names. In each bucket the
    largest component is only ever met from the other side, so a bucket of g copies and k others costs k * g and not
    g * g.
    """
    live = split_buckets(rows, labels, 0)
    x, y = live.where("comp <> major").alias("x"), live.alias("y")
    on = (F.col("x.key") == F.col("y.key")) & (F.col("x.comp") != F.col("y.comp")) & ((F.col("y.comp") == F.col("y.major")) | (F.col("x.node") < F.col("y.node"))) & F.expr(also)
    return x.join(y, on).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def link_buckets(rows: DataFrame, confirm, finish, scratch: Scratch, seed_links: DataFrame | None = None, rounds: int = 2, more_pairs: DataFrame | None = None) -> DataFrame:
    """Components (``node, comp``) of all links between nodes that share a bucket.

    ``rows``: ``key, node, size`` (of the bucket). ``confirm(pairs, tag)`` returns those of the pairs ``a, b`` that are
    links. First come stars around central nodes, then around members of each bucket's largest component; every round
    is linear in the rows. ``more_pairs`` are confirmed with the first stars. At last ``finish(labels)`` gives what is left to confirm of the pairs that share a bucket
    but not a component, so nothing is missed.
    """
    pairs_of = lambda k: scratch.spark.read.schema("a long, b long").parquet(scratch.path(f"star{k}-pairs"))
    first = central_pairs(rows) if more_pairs is None else central_pairs(rows).unionByName(more_pairs).distinct()
    links = confirm(first, "star0")
    labels = components(links if seed_links is None else links.unionByName(seed_links), scratch, "comp0")
    tried = pairs_of(0)
    for k in range(1, rounds + 2):
        pairs = pivot_pairs(rows, labels, k) if k <= rounds else finish(labels)
        more = confirm(pairs.join(tried, ["a", "b"], "left_anti"), f"star{k}")
        tried = tried.unionByName(pairs_of(k))
        if not more.isEmpty():
            labels = components(labels.select(F.col("node").alias("a"), F.col("comp").alias("b")).unionByName(more), scratch, f"comp{k}")
    return labels
