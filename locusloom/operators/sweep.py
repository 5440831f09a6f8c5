"""Running sums and maxima along chromosomes without one task per chromosome.

Positions are cut into ranges. Each range is summed up first; a window over these few rows gives what lies before each
range (its carry), and the detailed windows then run inside single ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ranged(by: Sequence[str], at: Column, size: int) -> Column:
    """The range of a row and its group as one key that is never null itself: a join on it also leaves rows where windows
    over the group's ranges need them, so they are shuffled once for both."""
    return F.struct(*by, F.floor(at / size).alias("_no"))


def carried(t: DataFrame, by: Sequence[str], at: Column, size: int, totals: dict[str, Column], carry: str = "sum") -> DataFrame:
    """``t`` with ``_range`` and, for each of ``totals``, the sum (or ``max``; names that end in ``_max`` always have that)
    over all earlier ranges of its group."""
    t = t.withColumn("_range", _ranged(by, at, size))
    per = t.groupBy(*by, "_range").agg(*(c.alias(k) for k, c in totals.items()))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col("_range").alias("_k"), *((F.max if carry == "max" or k.endswith("_max") else F.sum)(k).over(before).alias(k) for k in totals))
    return t.join(per, F.col("_range") == F.col("_k"), "left").drop("_k")


def within(by: Sequence[str], *order, to: int = 0):
    """Rows of the same group and range up to the current one (``to`` = 0) or before it (-1)."""
    return Window.partitionBy(*by, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, to)


def previous(t: DataFrame, by: Sequence[str], at: Column, order: Sequence[str], value: str, size: int) -> DataFrame:
    """``t`` with ``_previous``: ``value`` of the row before in the order of ``at`` and then ``order`` (total, beginning with what
    ``at`` grows with), within ``by``; null for the first. A range's first row takes it from the last row of the nearest
    range before that has any, so no task holds a group."""
    t = t.withColumn("_range", _ranged(by, at, size))
    last = t.groupBy(*by, "_range").agg(F.max(F.struct(*order, F.col(value).alias("_value"))).getField("_value").alias("_from"))
    last = last.select(F.col("_range").alias("_k"), F.lag("_from").over(Window.partitionBy(*by).orderBy("_range")).alias("_from"))
    inside = Window.partitionBy(*by, "_range").orderBy(*order)
    out = t.join(last, F.col("_range") == F.col("_k"), "left").withColumn("_previous", F.when(F.row_number().over(inside) == 1, F.col("_from")).otherwise(F.lag(value).over(inside)))
    return out.drop("_range", "_from", "_k")


def profile(b: DataFrame, by: Sequence[str], points: DataFrame, start: str = "b_start", end: str = "b_end", size: int = 4096) -> DataFrame:
    """For each position of ``points`` (``by``, ``pos``), over half-open intervals ``b``: starts before it (``begun``),
    ends at or before it (``ended``), and the positions before it that are covered (``covered``) or covered with their
    multiplicity (``bases``). Work grows with the number of distinct positions and not with the overlaps."""
    zero = F.lit(0).cast("long")
    one = F.lit(1).cast("long")
    events = b.where(F.col(end) > F.col(start)).select(*by, F.col(start).alias("pos"), one.alias("s"), zero.alias("e")).unionByName(b.where(F.col(end) > F.col(start)).select(*by, F.col(end).alias("pos"), zero.alias("s"), one.alias("e")))
    events = events.groupBy(*by, "pos").agg(F.sum("s").alias("s"), F.sum("e").alias("e"))
    marks = points.select(*by, "pos").distinct().select("*", zero.alias("s"), zero.alias("e"))
    steps = events.unionByName(marks).groupBy(*by, "pos").agg(F.sum("s").alias("s"), F.sum("e").alias("e"))
    steps = carried(steps, by, F.col("pos"), size, {"_s0": F.sum("s"), "_e0": F.sum("e"), "_p_max": F.max("pos")})
    here, inside = within(by, "pos"), Window.partitionBy(*by, "_range").orderBy("pos")
    begun, ended = F.coalesce("_s0", zero) + F.sum("s").over(here), F.coalesce("_e0", zero) + F.sum("e").over(here)
    # between the last position and this one, the depth is what had begun and not ended before this one
    d = begun - ended - F.col("s") + F.col("e")
    gain = F.coalesce(F.col("pos") - F.coalesce(F.lag("pos").over(inside), "_p_max"), zero)
    steps = steps.select(*by, "pos", (begun - F.col("s")).alias("begun"), ended.alias("ended"), F.when(d > 0, gain).otherwise(zero).alias("g"), (d * gain).alias("h"))
    steps = carried(steps, by, F.col("pos"), size, {"_g0": F.sum("g"), "_h0": F.sum("h")})
    return steps.select(*by, "pos", "begun", "ended", (F.coalesce("_g0", zero) + F.sum("g").over(here)).alias("covered"), (F.coalesce("_h0", zero) + F.sum("h").over(here)).alias("bases"))


def measure(a: DataFrame, b: DataFrame, by: Sequence[str] = ("chrom",), size: int = 4096) -> DataFrame:
    """``a`` (``start``, ``end``, half-open) with, over ``b`` (``b_start``, ``b_end``): ``n_overlaps``, ``bp_covered`` (by
    the union of ``b``) and ``bp_shared`` (summed over the pairs), by looking up both ends in :func:`profile`."""
    points = a.select(*by, F.col("start").alias("pos")).unionByName(a.select(*by, F.col("end").alias("pos")))
    at = profile(b, by, points, size=size)
    zero = F.lit(0).cast("long")

    def side(name: str) -> DataFrame:
        return at.select(*(F.col(k).alias(f"_{name}_{k}") for k in by), F.col("pos").alias(f"_{name}"), *(F.col(c).alias(f"_{name}_{c}") for c in ("begun", "ended", "covered", "bases")))

    def on(name: str, col: str):
        cond = F.col(col) == F.col(f"_{name}")
        for k in by:
            cond = cond & (F.col(k) == F.col(f"_{name}_{k}"))
        return cond

    out = a.join(side("x"), on("x", "start"), "left").join(side("y"), on("y", "end"), "left")
    some = F.col("end") > F.col("start")
    pick = lambda c: F.when(some, F.coalesce(c, zero)).otherwise(zero)
    return out.select(*a.columns, pick(F.col("_y_begun") - F.col("_x_ended")).alias("n_overlaps"), pick(F.col("_y_covered") - F.col("_x_covered")).alias("bp_covered"), pick(F.col("_y_bases") - F.col("_x_bases")).alias("bp_shared"))
