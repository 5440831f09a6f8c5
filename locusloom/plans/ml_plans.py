"""Queries over the classifiers. What they learn cannot be said in SQL; tests hold them to their invariants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..ml import bagging, filtering
from ..operators import evidence as ev
from ..written import written
from .evidence_plans import evidence
from .filter_plans import busco_table

FEATURES = ["tpm", "coverage", "augustus", "helixer", "repeat", "lnc"]


def semi_supervised_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts that the forest workflow keeps, with the reason."""
    t = ev.seed_label(ev.flags(evidence(spark, sf_dir)))
    busco = busco_table(spark, sf_dir).select(F.col("p_partkey").alias("transcript_id"), "status")
    return filtering.semi_supervised(t, FEATURES, busco, errors=False)[0]


def out_of_bag_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the trees that did not see a seed transcript judge it."""
    t = ev.seed_label(ev.flags(evidence(spark, sf_dir))).where("label IN ('Keep', 'Discard')").withColumn("y", F.when(F.col("label") == "Keep", 1.0).otherwise(0.0))
    rows = written(filtering.assembled(t, FEATURES).join(t.select("transcript_id", "y"), "transcript_id"), "seeds")
    return bagging.out_of_bag(rows, bagging.bag(rows, 20, 3, 123), 123)


def out_of_fold_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of pseudo-labelled transcripts by models that did not see them."""
    t = evidence(spark, sf_dir).withColumn("pfam", F.col("pfam") & (F.col("transcript_id") % 9 == 0))
    t = filtering.pseudo_labels(t, F.col("blast_pident") > 60)
    return filtering.out_of_fold(t, FEATURES)


QUERIES = {f.__name__: f for f in (semi_supervised_keep, out_of_bag_votes, out_of_fold_scores)}
ORACLES: dict[str, str] = {}
