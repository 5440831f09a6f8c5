"""A training corpus from ``documents``: language ID, line dedup, near-dedup, decontamination, packing.

Every stage takes what its predecessor kept. All but the last return the columns of ``documents``, whatever they are
called. Rows are decided one by one, not by doc_id: null ids and rows that repeat an id are rows like others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusloom.llm import decontamination, language_id, line_dedup, near_dedup, packing
from locusloom.llm.scratch import Scratch, if_small, read

SMALL_ROWS = 20_000


def _packed(docs: DataFrame, *more) -> DataFrame:
    """The row as one struct beside columns of our own, so that no names can clash."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *more)


def _unpacked(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*(F.col(f"row.`{c}`").alias(c) for c in columns))


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter go, and those for which no language is clearly likelier than by chance. Where there is
    nothing to learn from, all stay."""
    model = language_id.train(docs)
    if not model.classes:
        return docs
    return _unpacked(language_id.predict_rows(docs, model).where("NOT (lang_pred = 'und' OR score < 0.3)"), docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; so does a document that has no text left because of that."""
    out = line_dedup.line_dedup(docs)
    removed = F.col(f"`{out.columns[-1]}`")
    return out.where((removed == 0) | (F.trim("text") != "")).select(*(F.col(f"`{c}`") for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates stays. Rows are numbered in a table of their own first."""
    scratch = Scratch(spark, "near-duplicates")
    rows = scratch.cut(_packed(docs, F.monotonically_increasing_id().alias("n")), "rows")
    with scratch.alone():
        judged = near_dedup.near_dedup(rows.select(F.col("n").alias("doc_id"), F.col("row.text").alias("text")))
        gone = scratch.cut(judged.where("NOT kept").select(F.col("doc_id").alias("gone")), "gone")
    return _unpacked(rows.join(if_small(gone, SMALL_ROWS), F.col("n") == F.col("gone"), "left_anti"), docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated with benchmark items go. Contamination is a matter of the text alone, so that texts are
    known by their hash here."""
    scratch = Scratch(spark, "benchmark")
    key = F.xxhash64("text")
    with scratch.alone():
        judged = decontamination.contamination(docs.select(key.alias("doc_id"), "text"), read(spark, sf_dir, "benchmark"))
        gone = scratch.cut(judged.where("contaminated").select(F.col("doc_id").alias("gone")).distinct(), "gone")
    return _unpacked(_packed(docs, key.alias("key")).join(if_small(gone, SMALL_ROWS), F.col("key") == F.col("gone"), "left_anti"), docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents, tokenised and packed."""
    return packing.pack_documents(docs)


STAGES = [("language ID", languages), ("line dedup", lines), ("near-dedup", near_duplicates), ("decontamination", benchmark), ("packing", sequences)]

#: The stages use trained and randomised models that SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written and reread."""
    scratch, docs = Scratch(spark, "pipeline"), read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.cut(stage(spark, docs, sf_dir), f"stage{k}")
        scratch.drop(f"stage{k - 1}")
    return docs
