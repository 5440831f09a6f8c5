"""Packing without padding or mixed sequences: every document is cut by the binary digits of its length.

A document of L tokens becomes L // longest pieces of the longest length, and one piece for every binary digit of the
rest, longest first. Each piece is a sequence; sequences of equal length form a bucket, from which batches are drawn
(:func:`batches`). All lengths are powers of two, so nothing is padded and no sequence crosses documents. A document is
cut in the task that reads it; no shuffle is needed before batches are made.

Cases: null text is empty (the final id alone, a sequence of one); null and repeated ids are documents of their own; an
empty table gives no rows; very long texts leave their task in blocks of pieces; extra columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import read, text_of
from .vectors import kind_of

BLOCK = 4096  # pieces that leave a task together
#: How byte-level tokenizers of this kind cut a text before they merge.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def encoder(tokenizer_json: str) -> Callable[[str], bytes]:
    """text -> little-endian uint32 ids, as ``tokenizers`` gives them.

    A byte-level tokenizer whose merges are numbered in the order in which they apply is the same function as a table of
    ranks, which ``tiktoken`` merges in a third of the time; a test holds the two to each other on every code point. Texts
    that name a special token, and other kinds of tokenizers, go through ``tokenizers`` itself."""
    from tokenizers import Tokenizer

    tok, model = Tokenizer.from_str(tokenizer_json), json.loads(tokenizer_json)
    special = [t.content for t in tok.get_added_tokens_decoder().values()]

    def whole(text: str) -> bytes:
        return np.array(tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    ranks = ranks_of(model)
    if ranks is None:
        return whole
    import tiktoken

    merged = tiktoken.Encoding("ranks", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> bytes:
        if any(s in text for s in special):
            return whole(text)
        return np.array(merged.encode_ordinary(text), "<u4").tobytes()

    return encode


def ranks_of(model: dict) -> dict[bytes, int] | None:
    """The ranks of a byte-level BPE tokenizer's tokens by their bytes; None if it is of another kind, or if its merges
    aren't numbered in their order."""
    cut, bpe = model.get("pre_tokenizer") or {}, model["model"]
    if (cut.get("type"), cut.get("add_prefix_space"), cut.get("use_regex"), bpe.get("type")) != ("ByteLevel", False, True, "BPE") or model.get("normalizer"):
        return None
    # bytes as the byte-level alphabet spells them: printable ones as themselves, the others from U+0100 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}
    named = {t["content"] for t in model["added_tokens"]}
    vocabulary = {t: i for t, i in bpe["vocab"].items() if t not in named}
    order = [vocabulary.get("".join(m if isinstance(m, list) else m.split(" ")), -1) for m in bpe["merges"]]
    if any(not set(t) <= set(byte) for t in vocabulary) or not all(c in vocabulary for c in byte) or any(a >= b for a, b in pairwise(order)):
        return None
    if len(vocabulary) != len(byte) + len(order) or (order and max(vocabulary[c] for c in byte) >= order[0]):
        return None
    return {bytes(byte[c] for c in t): i for t, i in vocabulary.items()}


def binary_lengths(n: int, longest: int) -> list[int]:
    """Powers of two that add up to ``n``, largest first, none above ``longest`` (a power of two itself)."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << k for k in range(longest.bit_length() - 2, -1, -1) if rest >> k & 1]


def decompose(docs: DataFrame, tokenizer_json: str, longest: int = 1024, end_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per sequence: ``doc_id, piece, start, length, ids`` (little-endian uint32), ``doc_tokens``."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    names = ["doc_id", "piece", "start", "length", "ids", "doc_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode, end = encoder(shared.value), np.array([end_id], "<u4").tobytes()
        for b in batches:
            own, out = [], []

            def block(own: list[int], out: list[tuple], keys: pa.Array = b.column(0)) -> pa.RecordBatch:
                piece, start, length, ids, tokens = zip(*out, strict=True)
                return pa.record_batch([keys.take(pa.array(own, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary()), pa.array(tokens, pa.int64())], names=names)

            for k, value in enumerate(b.column(1)):
                ids = encode(value.as_py()) + end
                tokens, at = len(ids) // 4, 0
                for piece, n in enumerate(binary_lengths(tokens, longest)):
                    own.append(k)
                    out.append((piece, at, n, ids[4 * at : 4 * (at + n)], tokens))
                    at += n
                    if len(out) == BLOCK:
                        yield block(own, out)
                        own, out = [], []
            if out:
                yield block(own, out)

    schema = f"doc_id {kind_of(docs, key)}, piece int, start long, length long, ids binary, doc_tokens long"
    return docs.select(F.col(f"`{key}`").alias("doc_id"), text_of(f"`{text}`").alias("text")).mapInArrow(run, schema)


def batches(sequences: DataFrame, tokens: int = 65_536, seed: int = 0, range_rows: int = 100_000) -> DataFrame:
    """``sequences`` (a written table) with ``batch`` and ``slot``: every batch holds ``tokens`` tokens in sequences of one
    length (the last of a length may hold fewer), drawn in an order that ``seed`` decides.

    Sequences are dealt by hash to ranges of some ``range_rows``; counts of ranges give the number at which each begins.
    """
    order = F.xxhash64(F.lit(seed), "doc_id", "start", "ids")
    ranges = max(1, sequences.count() // range_rows)
    t = sequences.withColumn("_h", order).withColumn("_range", F.pmod("_h", F.lit(ranges)))
    per = t.groupBy("length", "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    per = per.select(F.col("length").alias("_l"), F.col("_range").alias("_r"), F.coalesce(before, F.lit(0).cast("long")).alias("_before"))
    number = F.row_number().over(Window.partitionBy("length", "_range").orderBy("_h", "doc_id", "piece")) - 1
    t = t.withColumn("_k", number).join(per, (F.col("length") == F.col("_l")) & (F.col("_range") == F.col("_r"))).withColumn("_k", F.col("_k") + F.col("_before"))
    each = F.greatest(F.lit(1), F.floor(F.lit(tokens) / F.col("length")))
    return t.withColumn("batch", F.floor(F.col("_k") / each)).withColumn("slot", F.col("_k") % each).drop("_h", "_range", "_l", "_r", "_k", "_before")


def write_buckets(sequences: DataFrame, path: str) -> None:
    """One folder per length, written by the tasks that cut the documents."""
    sequences.write.partitionBy("length").option("compression", "zstd").parquet(path)


def op12_binary_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        model = f.read()
    rows = decompose(read(spark, sf_dir, "documents"), model)
    return rows.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
