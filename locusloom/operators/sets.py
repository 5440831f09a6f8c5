"""Id sets, updates by key, reports and splits of feature tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .evidence import first_by
from .sweep import carried, within


def membership(t: DataFrame, sets: dict[str, DataFrame], key: str) -> DataFrame:
    """``t`` with a boolean per named set of keys (a table with the column ``key``)."""
    for name, ids in sets.items():
        mark = ids.select(key).distinct().withColumn(f"_{name}", F.lit(True))
        t = t.join(mark, key, "left").withColumn(name, F.col(f"_{name}").isNotNull()).drop(f"_{name}")
    return t


def updated(t: DataFrame, changes: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """``t`` with ``cols`` replaced where ``changes`` (one row per key) has a value."""
    new = changes.select(key, *(F.col(c).alias(f"_{c}") for c in cols))
    out = t.join(new, key, "left")
    return out.select(*(F.coalesce(f"_{c}", c).alias(c) if c in cols else F.col(c) for c in t.columns))


def first_of_equal(t: DataFrame, keys: list[str], *order) -> DataFrame:
    """One row of those with equal keys, the first in ``order``: a union of partitions without repeats."""
    return first_by(t.withColumn("_k", F.struct(*keys)), "_k", *order).drop("_k")


def summed(tables: list[DataFrame], key: str, value: str) -> DataFrame:
    """Values of several samples added up by key, whatever their order."""
    out = tables[0].select(key, value)
    for t in tables[1:]:
        out = out.unionByName(t.select(key, value))
    return out.groupBy(key).agg(F.sum(value).alias(value))


def childless_report(features: DataFrame, lost: DataFrame) -> DataFrame:
    """Where the mRNAs in ``lost`` (``mrna``) come from: ``mrna, gene, seqid, start, end, source, siblings``."""
    m = features.where("type = 'mRNA'").select(F.col("id").alias("mrna"), F.element_at("parents", 1).alias("gene"), "seqid", "start", "end", "source")
    n = m.groupBy("gene").agg((F.count(F.lit(1)) - 1).alias("siblings"))
    return m.join(lost.select("mrna"), "mrna", "left_semi").join(n, "gene").select("mrna", "gene", "seqid", "start", "end", "source", "siblings")


def removed(before: DataFrame, after: DataFrame, why: str) -> DataFrame:
    """Audit of a step: ``type, id, why`` of features that it took away."""
    return before.where("id IS NOT NULL").select("type", "id").distinct().join(after.select("type", "id").distinct(), ["type", "id"], "left_anti").withColumn("why", F.lit(why))


def looked_up(ids: DataFrame, t: DataFrame, key: str) -> DataFrame:
    """Every row of ``ids`` with what ``t`` (one row per key, or the first in no order) has for it, nulls where it has nothing."""
    return ids.join(t.dropDuplicates([key]), key, "left")


def placed(t: DataFrame, by: list[str], at: str, *order: str, size: int = 4096) -> DataFrame:
    """``t`` with ``place``: its number from 1 in the order of ``at`` (a number) and then ``order`` (total) within ``by``. Ranges of
    ``at`` are counted first, so that no task orders a whole group."""
    one = F.count(F.lit(1))
    c = carried(t, by, F.col(at), size, {"_before": one})
    return c.withColumn("place", F.coalesce("_before", F.lit(0).cast("long")) + one.over(within(by, at, *order))).drop("_before", "_range")


def numbered_within(t: DataFrame, by: list[str], *order, name: str = "place") -> DataFrame:
    """``t`` numbered within small groups, such as the domains of a gene by e-value."""
    return t.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def first_of_equal_texts(t: DataFrame, text: str, *order: str) -> DataFrame:
    """One row of those with equal texts, the first in ``order``. Only digests and keys are exchanged; the rows that stay
    are taken from ``t`` by their order columns, which must be unique."""
    digest = F.sha2(F.col(text), 256)
    first = t.select(digest.alias("_d"), F.struct(*order).alias("_k")).groupBy("_d").agg(F.min("_k").alias("_k"))
    kept = first.select(*(F.col(f"_k.{c}").alias(c) for c in order))
    return t.join(kept, list(order), "left_semi")


def primary_names(t: DataFrame, col: str, suffix: str = ".t1") -> DataFrame:
    """Rows whose id ends in the suffix, with ``gene`` (the id without it) and how often that occurs."""
    kept = t.where(F.col(col).endswith(suffix)).withColumn("gene", F.expr(f"left({col}, length({col}) - {len(suffix)})"))
    n = kept.groupBy("gene").agg(F.count(F.lit(1)).alias("copies"))
    return kept.join(n, "gene")


def id_prefix(explicit: str | None, pattern: str | None, default: str = "GENE") -> str:
    """Prefix of new ids: the one given, else the letters that a chromosome pattern begins with, else a constant; each ends
    in G and none may look like a path."""
    tag = explicit or next(iter(re.findall("[A-Za-z]+", pattern or "")), "") or default
    if "/" in tag:
        raise ValueError(f"an id prefix must be no path: {tag!r}")
    return tag if explicit or tag.endswith("G") else tag + "G"
