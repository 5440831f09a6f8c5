"""Loci: clustering of features, depth and gaps along chromosomes, evidence scores, the best source per locus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .sweep import carried, within


def clusters(t: DataFrame, by: Sequence[str], slack: int = 0, size: int = 4096) -> DataFrame:
    """Number the clusters of overlapping (or by ``slack`` neighbouring) closed intervals in each group: ``cluster``."""
    top = carried(t, by, F.col("start"), size, {"_top": F.max("end")}, "max")
    reach = F.greatest("_top", F.max("end").over(within(by, "start", "end", to=-1)))
    new = F.coalesce(F.col("start") > reach + slack, F.lit(True)).cast("long")
    flagged = carried(top.withColumn("_new", new).drop("_range", "_top"), by, F.col("start"), size, {"_before": F.sum("_new")})
    # equal intervals count together: which of them came first in the pass before is not told
    number = F.coalesce("_before", F.lit(0).cast("long")) + F.sum("_new").over(Window.partitionBy(*by, "_range").orderBy("start", "end").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return flagged.withColumn("cluster", number).drop("_new", "_range", "_before")


def depth_runs(t: DataFrame, by: Sequence[str], size: int = 4096) -> DataFrame:
    """Runs of equal depth > 0 of half-open intervals: ``start, end, depth``. Events are summed per position first."""
    events = t.select(*by, F.col("start").alias("pos"), F.lit(1).alias("d")).unionByName(t.select(*by, F.col("end").alias("pos"), F.lit(-1).alias("d")))
    events = events.groupBy(*by, "pos").agg(F.sum("d").alias("d")).where("d <> 0")
    # a range's last run ends where the next range with events begins: the negated maximum over the ranges after it
    events = carried(carried(events, by, F.col("pos"), size, {"_d": F.sum("d")}).drop("_range"), by, -F.floor(F.col("pos") / size), 1, {"_next": F.max(-F.col("pos"))}, "max")
    w = Window.partitionBy(*by, "_range").orderBy("pos")
    depth = F.coalesce("_d", F.lit(0)) + F.sum("d").over(within(by, "pos"))
    return events.select(*by, F.col("pos").alias("start"), F.coalesce(F.lead("pos").over(w), -F.col("_next")).alias("end"), depth.alias("depth")).where("depth > 0")


def gaps(t: DataFrame, by: Sequence[str], least: int, lengths: DataFrame | None = None, size: int = 4096) -> DataFrame:
    """Stretches ``gap_start, gap_end`` of at least ``least`` positions that no closed interval covers. With ``lengths``
    (``by``, ``length``) also those before the first and after the last interval, in [1, length]."""
    top = carried(t.select(*by, "start", "end"), by, F.col("start"), size, {"_top": F.max("end")}, "max")
    reach = F.greatest("_top", F.max("end").over(within(by, "start", "end", to=-1)))
    inner = top.select(*by, (reach + 1).alias("gap_start"), (F.col("start") - 1).alias("gap_end"))
    if lengths is not None:
        ends = lengths.join(t.groupBy(*by).agg(F.min("start").alias("lo"), F.max("end").alias("hi")), list(by), "left")
        one = F.lit(1).cast("long")
        whole = F.struct(one.alias("s"), F.col("length").alias("e"))
        pieces = F.when(F.col("lo").isNull(), F.array(whole)).otherwise(F.array(F.struct(one.alias("s"), (F.col("lo") - 1).alias("e")), F.struct((F.col("hi") + 1).alias("s"), F.col("length").alias("e"))))
        inner = inner.unionByName(ends.select(*by, F.inline(pieces)).toDF(*by, "gap_start", "gap_end"))
    return inner.where(F.col("gap_end") - F.col("gap_start") + 1 >= least)


def depth_profile(runs: DataFrame, lengths: DataFrame, by: Sequence[str], width: int = 10_000) -> DataFrame:
    """The least depth of every window of ``width`` positions of [1, length]: ``bin, depth``; windows that no run of
    ``runs`` (half-open, 1-based ``start``, ``end``, ``depth``) fully covers have 0."""
    bins = lengths.select(*by, "length", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / width))).alias("bin"))
    r = runs.select(*by, "start", "end", "depth", F.explode(F.sequence(F.floor((F.col("start") - 1) / width), F.floor((F.col("end") - 2) / width))).alias("bin"))
    low = r.groupBy(*by, "bin").agg(F.min("depth").alias("low"), F.sum(F.least(F.col("end"), (F.col("bin") + 1) * width + 1) - F.greatest(F.col("start"), F.col("bin") * width + 1)).alias("seen"))
    size = F.least(F.col("length"), (F.col("bin") + 1) * width) - F.col("bin") * width
    zero = F.lit(0).cast("long")
    return bins.join(low, [*by, "bin"], "left").select(*by, "bin", F.when(F.col("seen") >= size, F.col("low").cast("long")).otherwise(zero).alias("depth"))


def log_evidence(col: str, penalty: float = 0.01):
    """log10(x) + 1 with zero replaced by the penalty; null stays null."""
    return F.log10(F.when(F.col(col) == 0, F.lit(penalty)).otherwise(F.col(col))) + 1


def best_source(scored: DataFrame) -> DataFrame:
    """The source with the highest score of each locus; ties go to the alphabetically first, nulls last."""
    w = Window.partitionBy("locus").orderBy(F.desc_nulls_last("score"), F.asc_nulls_last("source"))
    return scored.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def split_evenly(t: DataFrame, parts: int, *order) -> DataFrame:
    """Deal rows to ``parts`` parts of sizes that differ by at most one: hash ranks are per part of a range split, so
    no single task orders all rows."""
    ranged = t.withColumn("_slot", F.pmod(F.xxhash64(*order), F.lit(1 << 16)))
    sizes = ranged.groupBy("_slot").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select(F.col("_slot").alias("_s"), (F.sum("n").over(Window.orderBy("_slot")) - F.col("n")).alias("_before"))
    w = Window.partitionBy("_slot").orderBy(*order)
    return ranged.withColumn("_rn", F.row_number().over(w)).join(F.broadcast(before), F.col("_slot") == F.col("_s")).withColumn("part", ((F.col("_before") + F.col("_rn") - 1) % parts).cast("int")).drop("_slot", "_s", "_rn", "_before")
