"""MinHash near-dedup by a multi-index Hamming join.

Every document gets b-bit MinHash symbols of its distinct five-word shingles. The signature is split into chunks; by
the pigeonhole principle two signatures that differ in at most ``chunks * (errors + 1) - 1`` symbols differ in at most
``errors`` symbols of some chunk. All choices of ``errors`` symbols to leave out of a chunk are enumerated as join
keys, so every pair under that distance meets. Pairs that meet are confirmed on the full shingle sets.

Documents with equal sets are first folded into the one with the smallest id. Inside a bucket documents are compared
with its most central one first; what is then linked forms components, and only pairs of different components that
share a bucket are compared next (but for pairs whose whole signatures differ by five standard deviations more than
the similarity allows). A bucket that is large is split by the keys of a second, independent signature.

Cases: null and wordless texts have no set, so they link with nothing; null ids get a null component and stay; rows
that repeat an id are one document and any row's link counts for it; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .graph import central_pairs, components, cross_pairs, link_buckets, split_buckets
from .scratch import Scratch, if_small, read, text_of

SHINGLE, CHUNKS, WIDTH, ERRORS = 5, 12, 5, 1
SYMBOLS = CHUNKS * WIDTH
_RNG = np.random.default_rng(20240229)
_XOR = _RNG.integers(0, 2**32, 2 * SYMBOLS, dtype=np.uint32)
_MUL = _RNG.integers(0, 2**32, 2 * SYMBOLS, dtype=np.uint32) | np.uint32(1)
_LEFT = [(c, left) for c in range(CHUNKS) for left in combinations(range(WIDTH), WIDTH - ERRORS)]
_P = np.uint64(0x9E3779B97F4A7C15)


class WordHash(dict):
    """word -> 64-bit hash, remembered up to ``limit`` words."""

    def __init__(self, limit: int = 500_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, with A-Z (only) lower-cased."""
    return text.encode().lower().split()


def shingle_hashes(words: list[bytes], known: WordHash) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles, sorted."""
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    k = min(SHINGLE, len(h))
    n = len(h) - k + 1
    s = h[:n].copy() + np.uint64(k)
    for i in range(1, k):
        s = (s ^ (s >> np.uint64(29))) * _P + h[i : i + n]
    s ^= s >> np.uint64(32)
    return np.unique(s * _P)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Two independent signatures in a row, of 16 bits a symbol."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(2 * SYMBOLS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 2048):
        low = np.minimum(low, ((x[at : at + 2048, None] ^ _XOR) * _MUL).min(axis=0))
    return ((low ^ (low >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> np.uint32(16)).astype(np.uint16)


def bucket_keys(sig: np.ndarray) -> np.ndarray:
    """(documents, SYMBOLS) symbols -> (documents, keys): each chunk with ``ERRORS`` of its symbols left out."""
    sig = sig.astype(np.uint64)
    out = np.empty((len(sig), len(_LEFT)), np.uint64)
    for j, (c, left) in enumerate(_LEFT):
        k = np.full(len(sig), (j + 1) * 0x632BE59BD9B4E019 & (2**64 - 1), np.uint64)
        for i in left:
            k = (k ^ (k >> np.uint64(31)) ^ sig[:, c * WIDTH + i]) * _P
        out[:, j] = k ^ (k >> np.uint64(29))
    return out.view(np.int64)


SIGNED = "doc_id long, n_shingles long, set_a long, set_b long, sig binary"


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles``, a 128-bit fingerprint of the set, and the signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHash()
        for b in batches:
            n, a, c, sigs = [], [], [], []
            for text in b.column(1):
                s = shingle_hashes(words_of(text.as_py()), known)
                d = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64)
                n.append(len(s))
                a.append(d[0])
                c.append(d[1])
                sigs.append(signature(s).tobytes() if len(s) else None)
            yield pa.record_batch([b.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(c, pa.int64()), pa.array(sigs, pa.binary())], names=["doc_id", "n_shingles", "set_a", "set_b", "sig"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, SIGNED)


def _bucket_rows(signed: DataFrame, second: bool = False) -> DataFrame:
    """One row per key and document: ``key, node, n``. With ``second``, ``signed`` has the first key as well, and the
    new key is made of it and of the second signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint16).reshape(b.num_rows, -1)
            keys = bucket_keys(sig[:, SYMBOLS:] if second else sig[:, :SYMBOLS])
            if second:
                keys = ((keys ^ b.column("key").to_numpy()[:, None]).view(np.uint64) * _P).view(np.int64)
            k = keys.shape[1]
            for at in range(0, b.num_rows, 2000):
                part = slice(at, at + 2000)
                yield pa.record_batch([pa.array(keys[part].ravel()), pa.array(np.repeat(b.column("node").to_numpy()[part], k)), pa.array(np.repeat(b.column("n").to_numpy()[part], k))], names=["key", "node", "n"])

    return signed.mapInArrow(run, "key long, node long, n long")


def _shared(rows: DataFrame) -> DataFrame:
    """The rows whose key more than one document has, with the smallest of them and their number."""
    keys = rows.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count(F.lit(1)).alias("size")).where("low <> high").drop("high")
    return rows.join(keys, "key")


def most_differing(percent: int) -> int:
    """Symbols that differ in a pair of exactly the similarity asked for: mean and five standard deviations."""
    n, p = 2 * SYMBOLS, 1 - percent / 100
    return int(n * p + 5 * (n * p * (1 - p)) ** 0.5) + 1


def family_pairs(live: DataFrame, families: DataFrame, nodes: DataFrame, docs: DataFrame, scratch: Scratch, percent: int, block: int, largest: int, small_rows: int) -> tuple[DataFrame, DataFrame]:
    """Likely links ``a, b`` between the components of a family, and the nodes of families too large for that.

    ``live``: ``node, comp``; a family is what buckets connect, so pairs never cross families. A family's nodes are
    dealt to blocks; each task meets two blocks with their signatures and full sets and emits only pairs that reach the
    similarity by hashed sets, never the pairs it looked at.
    """
    named = live.distinct().join(families, "node", "left").withColumn("fam", F.coalesce("fam", "node"))
    sizes = named.groupBy("fam").agg(F.count(F.lit(1)).alias("g"), F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 <> c1").select("fam", "g")
    dealt = scratch.cut(named.join(sizes, "fam").select("node", "comp", "fam", "g"), "families")
    wanted = if_small(dealt.where(F.col("g") <= largest).select("node").distinct(), small_rows)
    texts = docs.select(F.col("doc_id").alias("node"), text_of().alias("text")).join(wanted, "node", "left_semi")

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHash()
        for b in batches:
            yield pa.record_batch([b.column("node"), pa.array([shingle_hashes(words_of(t.as_py()), known).tobytes() for t in b.column("text")], pa.binary())], names=["node", "shingles"])

    sets = texts.mapInArrow(shingle, "node long, shingles binary")
    k = F.ceil(F.col("g") / block).cast("int")
    rows = dealt.where(F.col("g") <= largest).withColumn("blk", F.pmod(F.xxhash64("node"), k).cast("int"))
    rows = rows.join(nodes.select("node", "sig"), "node").join(sets, "node")
    met = rows.select("*", F.explode(F.sequence(F.lit(0), k - 1)).alias("other")).select("node", "comp", "fam", "blk", F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j"), "sig", "shingles")
    most = most_differing(percent)

    def compare(t: pa.Table) -> pa.Table:
        node, comp, blk = (t.column(c).to_numpy() for c in ("node", "comp", "blk"))
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint16).reshape(len(node), -1)
        sets = [np.frombuffer(s, np.uint64) for s in t.column("shingles").to_pylist()]
        size = np.array([len(s) for s in sets])
        right = np.flatnonzero(blk == j)
        a, b = [], []
        for x in np.flatnonzero(blk == i).tolist():
            ys = right if i != j else right[right > x]
            ys = ys[(comp[ys] != comp[x]) & (100 * np.minimum(size[ys], size[x]) >= percent * np.maximum(size[ys], size[x]))]
            for y in ys[(sig[ys] != sig[x]).sum(axis=1) <= most].tolist():
                at = np.searchsorted(sets[x], sets[y])
                both = int((sets[x][np.minimum(at, size[x] - 1)] == sets[y]).sum())
                if 100 * both >= percent * (size[x] + size[y] - both):
                    a.append(min(node[x], node[y]))
                    b.append(max(node[x], node[y]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return met.groupBy("fam", "i", "j").applyInArrow(compare, "a long, b long").distinct(), dealt.where(F.col("g") > largest).select("node")


def confirm(pairs: DataFrame, docs: DataFrame, scratch: Scratch, tag: str, percent: int, small_rows: int) -> DataFrame:
    """The pairs ``a, b`` whose full shingle sets have 100 * intersection >= percent * union."""
    pairs = scratch.cut(pairs, f"{tag}-pairs")
    nodes = scratch.cut(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct(), f"{tag}-nodes")
    texts = docs.select(F.col("doc_id").alias("node"), text_of().alias("text")).join(if_small(nodes, small_rows), "node", "left_semi")
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def sets(text: str) -> set:
        w = words_of(text)
        return set(zip(*(w[i:] for i in range(SHINGLE)))) if len(w) >= SHINGLE else ({tuple(w)} if w else set())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, set()
        for batch in batches:
            a, b, keep = batch.column("a").to_pylist(), batch.column("b").to_pylist(), []
            for i in range(len(a)):
                x = batch.column("text_a")[i].as_py()
                if x != last:
                    last, held = x, sets(x)
                y = sets(batch.column("text_b")[i].as_py())
                both = len(held & y)
                keep.append(bool(held) and bool(y) and 100 * both >= percent * (len(held) + len(y) - both))
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return scratch.cut(joined.mapInArrow(run, "a long, b long").distinct(), f"{tag}-links")


def near_dedup(docs: DataFrame, percent: int = 75, hot_bucket: int = 2000, block: int = 256, largest_family: int = 20_000, small_rows: int = 200_000) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``."""
    scratch = Scratch(docs.sparkSession, "neardup")
    signed = scratch.cut(signatures(docs), "signed")
    named = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    sets = scratch.cut(named.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("top")).where("rep <> top").drop("top"), "sets")
    copies = scratch.cut(named.select("doc_id", "set_a", "set_b", "n_shingles").join(if_small(sets, small_rows), ["set_a", "set_b", "n_shingles"]).where("doc_id <> rep").select("doc_id", "rep").distinct(), "copies")
    repeated = named.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    same_id = copies.join(repeated, "doc_id", "left_semi").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))

    firsts = named.join(if_small(copies.select("doc_id").distinct(), small_rows), "doc_id", "left_anti")
    firsts = firsts.unionByName(named.join(repeated, "doc_id", "left_semi")) if not repeated.isEmpty() else firsts
    nodes = firsts.select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), "sig")
    rows = scratch.cut(_shared(_bucket_rows(nodes)), "rows")
    hot = rows.where(F.col("size") > hot_bucket)
    if not hot.isEmpty():
        # the star to the smallest id links most of a hot bucket; what it misses is met again by finer keys
        again = _shared(_bucket_rows(hot.select("key", "node", "low").join(nodes, "node").select("key", "node", "n", "sig"), second=True))
        finer = scratch.cut(again, "finer")
    else:
        finer = None

    met = rows.where(F.col("size") <= hot_bucket).select("key", "node", "n", "size")
    if finer is not None:
        stars = hot.select("key", "node", "n", "size")
        met = met.unionByName(finer.select("key", "node", "n", "size"))
    seeds = same_id if finer is None else same_id.unionByName(confirm(central_pairs(stars), docs, scratch, "hot", percent, small_rows))

    def finish(labels: DataFrame) -> DataFrame:
        tried = scratch.spark.read.schema("a long, b long").parquet(scratch.path("star0-pairs"))
        families = components(tried, scratch, "families-of").withColumnRenamed("comp", "fam")
        live = split_buckets(met, labels, 0).select("node", "comp")
        pairs, rest = family_pairs(live, families, nodes, docs, scratch, percent, block, largest_family, small_rows)
        return pairs if rest.isEmpty() else pairs.unionByName(cross_pairs(met.join(rest.distinct(), "node", "left_semi"), labels, f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)"))

    labels = link_buckets(met, lambda pairs, tag: confirm(pairs, docs, scratch, tag, percent, small_rows), finish, scratch, seeds)

    reps = copies.join(repeated, "doc_id", "left_anti").select(F.col("doc_id").alias("copy_id"), "rep")
    out = signed.select("doc_id", "n_shingles").join(reps, F.col("doc_id") == F.col("copy_id"), "left")
    out = out.withColumn("node", F.when(F.col("n_shingles") > 0, F.coalesce("rep", "doc_id")))
    out = out.join(labels, "node", "left").withColumn("component_id", F.coalesce("comp", "node", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(read(spark, sf_dir, "documents"))


OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, sh FROM (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS sh FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
b AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, b.b FROM r JOIN b ON r.b = b.a),
c AS (SELECT a, min(b) AS c FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.c, d.doc_id) AS component_id, d.doc_id = coalesce(c.c, d.doc_id) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.a = d.doc_id
"""
