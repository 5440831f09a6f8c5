"""Classifiers of the filter workflow on Spark ML: a forest trained on its own confident calls, and a score model."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.evidence import feature_matrix, rescue_tier
from ..operators.loci import split_evenly
from ..written import written
from . import bagging


def assembled(data: DataFrame, features: Sequence[str]) -> DataFrame:
    """``transcript_id`` and ``x``: the features as numbers with their missing flags."""
    m = feature_matrix(data, list(features))
    cols = [c for c in m.columns if c != "transcript_id"]
    return VectorAssembler(inputCols=cols, outputCol="x").transform(m).select("transcript_id", "x")


def _forest(trees: int, per_split: int, seed: int, **more) -> RandomForestClassifier:
    """Trees grown deep, as forests of single leaves are; ``per_split`` features are tried at each split. Rows keep the node that
    they are at in each tree: deep trees would else be gone through from the root for every level."""
    return RandomForestClassifier(featuresCol="x", labelCol="y", numTrees=trees, featureSubsetStrategy=str(per_split), seed=seed, maxDepth=20, minInstancesPerNode=1, cacheNodeIds=True, **more)


def spread(rows: DataFrame, key: str = "transcript_id") -> DataFrame:
    """``rows`` dealt evenly over the cluster's cores, each part in the order of ``key``. Tables of features are small files, for
    which Spark takes a task or two, but all trees look at every row on every level."""
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism, key).sortWithinPartitions(key)


def positive(model, rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with the probability of class 1."""
    return model.transform(rows).withColumn(name, vector_to_array("probability")[1]).drop("probability", "rawPrediction", "prediction")


def bag_error(rows: DataFrame, trees: int, per_split: int, seed: int) -> float | None:
    """Out-of-bag error of labelled rows, by a bag of trees of the same kind whose samples are known (:mod:`.bagging`):
    Spark ML's own forests don't tell which rows a tree saw."""
    return bagging.error(bagging.out_of_bag(rows, bagging.bag(rows, trees, per_split, seed), seed))


def semi_supervised(data: DataFrame, features: Sequence[str], busco: DataFrame, trees: int = 100, per_split: int = 6, seed: int = 123, recycle: float = 0.95, max_iter: int = 5, repeat_cutoff: float = 0.5, errors: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(kept, process)`` from transcripts with seed labels (``label``: Keep, Discard or None) and evidence.

    A forest learns the seeds and calls the rest; calls with a probability above ``recycle`` (strictly) become labels,
    and a new forest is grown, until no call is that sure, none is left or ``max_iter`` rounds are over; calls of the last
    round count as well. What stays undecided is rescued by :func:`rescue_tier`, and conserved genes (``busco``:
    ``transcript_id, status``) come back whatever was decided. With only one kind of seed all transcripts are kept.
    ``kept``: ``transcript_id, reason``; ``process``: one row a round. Each round's labels are a written table, which holds the
    features as well, so that rounds need no joins."""
    if max_iter < 1:
        raise ValueError("max_iter must be at least 1")
    spark = data.sparkSession
    y = F.when(F.col("label") == "Keep", 1.0).when(F.col("label") == "Discard", 0.0)
    x = assembled(data, features).join(data.select("transcript_id", y.alias("y"), F.lit(0).alias("round")), "transcript_id")
    labels = written(spread(x), "labels")
    names = "round int, keep long, discard long, undecided long, error double, busco_keep long, busco_discard long, busco_undecided long"
    conserved = busco.where("status <> 'Missing'").select("transcript_id").distinct()
    process = []
    model = None
    for k in range(1, max_iter + 1):
        known = labels.where("y IS NOT NULL")
        if known.select("y").distinct().count() < 2:
            break
        model = _forest(trees, per_split, seed).fit(known)
        counts = lambda t: t.agg(F.count_if(F.col("y") == 1), F.count_if(F.col("y") == 0), F.count_if(F.col("y").isNull())).first()
        n, b = counts(labels), counts(labels.join(conserved, "transcript_id", "left_semi"))
        process.append((k, n[0], n[1], n[2], bag_error(known, trees, per_split, seed) if errors else None, b[0], b[1], b[2]))
        if not n[2]:
            break
        called = positive(model, labels.where("y IS NULL"), "p")
        sure = F.greatest(F.col("p"), 1 - F.col("p")) > recycle
        called = called.select("transcript_id", "x", F.when(sure, F.when(F.col("p") > 0.5, 1.0).otherwise(0.0)).alias("y"), F.when(sure, F.lit(k)).otherwise(F.col("round")).alias("round"))
        labels = written(spread(known.select(*called.columns).unionByName(called)), "labels")
        if labels.where(F.col("round") == k).isEmpty():
            break
    if model is None:
        return data.select("transcript_id", F.lit("all").alias("reason")), spark.createDataFrame([], names)
    rest = positive(model, labels.where("y IS NULL"), "prob").select("transcript_id", "prob")
    complete = busco.where("status IN ('Complete', 'Duplicated')").select("transcript_id").distinct().withColumn("busco", F.lit(True))
    t = data.select("transcript_id", "rex_pident", "blast_pident", "pfam", "repeat").join(labels.drop("x"), "transcript_id").join(rest, "transcript_id", "left").join(complete, "transcript_id", "left")
    tier = F.when(F.col("y") == 1, F.when(F.col("round") == 0, "seed").otherwise("recycled")).when(F.col("y").isNull(), F.nullif(rescue_tier(repeat_cutoff), F.lit("none")))
    reason = F.coalesce(tier, F.when(F.coalesce("busco", F.lit(False)), "conserved"))
    return t.select("transcript_id", reason.alias("reason")).where("reason IS NOT NULL"), spark.createDataFrame(process, names)


def ablation(data: DataFrame, features: Sequence[str], busco: DataFrame, **options) -> DataFrame:
    """One row for all features and one for each left out: ``left_out, kept, error, rounds`` and the differences from all."""
    spark, rows = data.sparkSession, []
    for out in (None, *features):
        kept, process = semi_supervised(data, [f for f in features if f != out], busco, **options)
        last = last_round(process).first()
        rows.append((out, kept.count(), last.error if last else None, last.round if last else 0))
    t = spark.createDataFrame(rows, "left_out string, kept long, error double, rounds int")
    base = t.where("left_out IS NULL").select(F.col("kept").alias("_k"), F.col("error").alias("_e"))
    return t.crossJoin(F.broadcast(base)).select("left_out", "kept", "error", "rounds", (F.col("kept") - F.col("_k")).alias("kept_change"), (F.col("error") - F.col("_e")).alias("error_change"))


def last_round(process: DataFrame) -> DataFrame:
    """The row of the last round."""
    return process.agg(F.max_by(F.struct(*process.columns), "round").alias("last")).where("last IS NOT NULL").select("last.*")


def pseudo_labels(t: DataFrame, homolog: Column) -> DataFrame:
    """Rows to learn from, with ``y``: 1 for a domain or a homologue, 0 for a transposon hit alone."""
    pos = F.coalesce(F.col("pfam"), F.lit(False)) | F.coalesce(homolog, F.lit(False))
    return t.where(pos | (F.coalesce(F.col("rex_pident"), F.lit(0.0)) > 0)).withColumn("y", F.when(pos, 1.0).otherwise(0.0))


def out_of_fold(labelled: DataFrame, features: Sequence[str], kind: str = "logistic", trees: int = 200, seed: int = 42) -> DataFrame:
    """``transcript_id, y, score`` of every row by a model that did not see it: up to five folds, even within each class.
    ``kind``: ``logistic``, or ``forest`` with classes weighted to balance. No rows for fewer than ten or one class."""
    n = dict(labelled.groupBy("y").count().collect())
    if len(n) < 2 or sum(n.values()) < 10 or min(n.values()) < 2:
        return labelled.select("transcript_id", F.col("y").cast("int").alias("y"), F.lit(0.0).alias("score")).limit(0)
    folds = min(5, *n.values())
    x = assembled(labelled, features).join(labelled.select("transcript_id", "y"), "transcript_id")
    parts = [split_evenly(x.where(F.col("y") == c), folds, "transcript_id") for c in (0.0, 1.0)]
    rows = written(parts[0].unionByName(parts[1]).withColumn("w", F.when(F.col("y") == 1, sum(n.values()) / (2 * n[1.0])).otherwise(sum(n.values()) / (2 * n[0.0]))), "folds")
    out = None
    for k in range(folds):
        rest, held = rows.where(F.col("part") != k), rows.where(F.col("part") == k)
        learner = LogisticRegression(featuresCol="x", labelCol="y", maxIter=1000) if kind == "logistic" else _forest(trees, ceil((2 * len(features)) ** 0.5), seed, weightCol="w")
        scored = positive(learner.fit(rest), held, "score").select("transcript_id", F.col("y").cast("int").alias("y"), "score")
        out = scored if out is None else out.unionByName(scored)
    return out
