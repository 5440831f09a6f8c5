"""Exact dedup by distributed MSD radix partitioning: documents are split by successive bytes of the normalised text.

Each level groups the documents that are still together by the next run of bytes (runs grow fourfold, so levels grow
with the logarithm of the longest text). A document that is alone leaves, and so does a group whose run is shorter
than the level's width: its texts have ended and are equal byte for byte, no digest decides. Only groups are shuffled
(pre-aggregated, one row for each prefix and map task); they are joined back to the documents by a skew-splitting join
(the first level's, which meet every text, by broadcast while they are few).

Cases: null text is empty; a row that repeats an id counts as a document of its own; null ids never become
``keep_id`` unless a group has no other; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch, if_small, read, text_of

WHITE = r"[\x20\x09-\x0D]+"


def exact_dedup(docs: DataFrame, width: int = 64, growth: int = 4, small_rows: int = 100_000) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    scratch = Scratch(docs.sparkSession, "radix")
    normal = F.regexp_replace(text_of(), WHITE, " ")
    now = docs.select("doc_id", F.lit(0).cast("long").alias("grp"), normal.cast("binary").alias("rest"), F.sha2(normal, 256).alias("text_sha256"))
    done: list[DataFrame] = []
    level = 0
    while True:
        digit = F.substring("rest", 1, width)
        groups = now.select("grp", digit.alias("digit"), "doc_id").groupBy("grp", "digit").agg(F.count(F.lit(1)).alias("size"), F.min("doc_id").alias("keep"))
        groups = scratch.cut(groups.where("size > 1").select("*", F.monotonically_increasing_id().alias("next")), f"groups{level}")
        groups = groups.select(F.col("grp").alias("g_grp"), "digit", "size", "keep", "next")
        small = groups if level else if_small(groups, small_rows)
        ended = F.octet_length("digit") < width
        rows = now.join(small, (F.col("grp") == F.col("g_grp")) & (digit == F.col("digit")), "left")
        goes_on = F.col("next").isNotNull() & ~ended
        rows = rows.select(
            "doc_id", "text_sha256",
            F.when(goes_on, F.col("next")).alias("grp"),
            F.when(goes_on, F.substring("rest", width + 1, 2**31 - 1)).alias("rest"),
            F.coalesce("keep", "doc_id").alias("keep_id"), F.coalesce("size", F.lit(1).cast("long")).alias("group_size"),
        )
        rows = scratch.cut(rows, f"rows{level}")
        done.append(rows.where(F.col("grp").isNull()).drop("grp", "rest"))
        now = rows.where(F.col("grp").isNotNull()).select("doc_id", "grp", "rest", "text_sha256")
        scratch.drop(f"groups{level}")
        if now.isEmpty():
            break
        level, width = level + 1, min(width * growth, 1 << 20)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS n FROM documents),
g AS (SELECT n, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY n)
SELECT t.doc_id, coalesce(g.keep_id, t.doc_id) AS keep_id, g.group_size,
       t.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(t.n) AS text_sha256
FROM t JOIN g ON t.n = g.n
"""
