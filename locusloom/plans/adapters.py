"""Operator inputs made from the star-schema test tables, expressible the same way in Spark and in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def hours(col: str):
    return F.datediff(F.to_date(col), F.lit("1995-01-01").cast("date")).cast("long") * 24


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-open intervals from line items; the name is unique."""
    l = read(spark, sf_dir, "lineitem")
    name = F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    start = hours("l_shipdate") + F.col("l_linenumber")
    return l.select(F.col("l_returnflag").alias("chrom"), F.when(F.col("l_linestatus") == "F", "+").otherwise("-").alias("strand"), start.alias("start"), (start + F.col("l_quantity").cast("long")).alias("end"), name.alias("name"))


FEATURES_SQL = """
features AS (SELECT l_returnflag AS chrom, CASE WHEN l_linestatus = 'F' THEN '+' ELSE '-' END AS strand,
  (date_diff('day', DATE '1995-01-01', l_shipdate::DATE) * 24 + l_linenumber)::BIGINT AS "start",
  (date_diff('day', DATE '1995-01-01', l_shipdate::DATE) * 24 + l_linenumber + l_quantity::BIGINT)::BIGINT AS "end",
  concat_ws('_', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS name FROM lineitem)"""


def evidence_intervals(spark: SparkSession, sf_dir: str, length: int = 20) -> DataFrame:
    """Half-open intervals from all orders: a second track."""
    o = read(spark, sf_dir, "orders")
    chrom = F.element_at(F.array(F.lit("N"), F.lit("A"), F.lit("R")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    return o.select(chrom.alias("chrom"), hours("o_orderdate").alias("b_start"), (hours("o_orderdate") + length).alias("b_end"), F.col("o_orderkey").alias("b_name"))


EVIDENCE_SQL = """
evidence AS (SELECT ['N', 'A', 'R'][o_orderkey % 3 + 1] AS chrom, (date_diff('day', DATE '1995-01-01', o_orderdate::DATE) * 24)::BIGINT AS b_start,
  (date_diff('day', DATE '1995-01-01', o_orderdate::DATE) * 24 + 20)::BIGINT AS b_end, o_orderkey AS b_name FROM orders)"""
