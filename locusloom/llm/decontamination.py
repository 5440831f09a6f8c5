"""Benchmark decontamination with an FM-index per training shard.

A shard is a bounded run of documents of one partition. Its words become symbols; words that no benchmark item has can
be in no window, so only stretches of benchmark words that are as long as the shortest window enter the index (this
loses no occurrence). The index is the Burrows-Wheeler transform of the stretches with a wavelet matrix for rank. All
windows are searched backwards at once; occurrences are located by walking to the nearest sampled suffix position;
the spans of a document are merged.

The windows of a benchmark of at most ``block_bytes`` go to the tasks by broadcast; a larger benchmark is searched in
as many blocks as it takes, each bounded so, and the spans of all blocks are merged for each document.

Cases: null text has no words; an item without words has no window; null item ids hit but are not listed; repeated
item ids are one item; rows that repeat a doc_id are judged one by one; an empty benchmark hits nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch, read, text_of

WINDOW = 13
#: Bytes of words: digits, ASCII letters (lower-cased) and everything beyond ASCII; the rest separates words.
_TABLE = bytes((c + 32 if 65 <= c <= 90 else c) if 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_TABLE).split()


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """By prefix doubling. ``seq`` must end with a 0 that occurs nowhere else."""
    rank = np.unique(seq, return_inverse=True)[1].astype(np.int64)
    n, k = len(seq), 1
    while True:
        key = rank * (n + 1)
        key[: n - k] += rank[k:] + 1
        sa = np.argsort(key, kind="stable")
        ordered = key[sa]
        new = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = np.empty(n, np.int64)
        rank[sa] = new
        if new[-1] == n - 1 or k >= n:
            return sa
        k *= 2


class FMIndex:
    """Counts and locates patterns in ``seq`` (symbols >= 1; a 0 is added as the end)."""

    def __init__(self, seq: np.ndarray, sample: int = 8):
        seq = np.concatenate([seq, [0]]).astype(np.int64)
        sa, self.n = suffix_array(seq), len(seq)
        bwt = seq[sa - 1]
        self.sigma = int(seq.max()) + 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=self.sigma))])
        self.bits = max(1, int(self.sigma - 1).bit_length())
        self.ones, self.zeros, cur = [], [], bwt
        for level in range(self.bits - 1, -1, -1):
            bit = (cur >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(int(len(bit) - bit.sum()))
            cur = np.concatenate([cur[bit == 0], cur[bit == 1]])
        sampled = sa % sample == 0
        self.sampled, self.at = np.concatenate([[0], np.cumsum(sampled)]), sa[sampled]

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often symbol ``c`` occurs in the first ``i`` places of the transform."""
        start, i = np.zeros_like(i), i.copy()
        for level, ones, zeros in zip(range(self.bits - 1, -1, -1), self.ones, self.zeros, strict=True):
            one = ((c >> level) & 1).astype(bool)
            a, b = ones[start], ones[i]
            start, i = np.where(one, zeros + a, start - a), np.where(one, zeros + b, i - b)
        return i - start

    def step(self, i: np.ndarray) -> np.ndarray:
        """The rows of the suffixes that start one symbol earlier (LF mapping)."""
        c, start, at = np.zeros_like(i), np.zeros_like(i), i.copy()
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            a, b = ones[start], ones[at]
            one = ones[at + 1] > b
            c = 2 * c + one
            start, at = np.where(one, zeros + a, start - a), np.where(one, zeros + b, at - b)
        return self.first[c] + at - start

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of the patterns: right-aligned rows of symbols, 0 in front of shorter ones."""
        lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        live = np.arange(len(patterns))
        for k in range(patterns.shape[1]):
            live = live[(lengths[live] > k) & (lo[live] < hi[live])]
            if not len(live):
                break
            c = patterns[live, patterns.shape[1] - 1 - k]
            known = c < self.sigma
            hi[live[~known]] = lo[live[~known]]
            live, c = live[known], c[known]
            lo[live], hi[live] = self.first[c] + self.rank(c, lo[live]), self.first[c] + self.rank(c, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        rows, steps, todo = rows.copy(), np.zeros(len(rows), np.int64), np.arange(len(rows))
        while len(todo := todo[self.sampled[rows[todo] + 1] == self.sampled[rows[todo]]]):
            rows[todo] = self.step(rows[todo])
            steps[todo] += 1
        return self.at[self.sampled[rows]] + steps


def windows_of(items: list[tuple[int | None, str]], window: int = WINDOW) -> dict:
    """The distinct windows of benchmark items as symbols (2 and up; 1 separates), and the items of each."""
    symbol: dict[bytes, int] = {}
    found: dict[tuple, set] = {}
    for item, text in items:
        ids = [symbol.setdefault(w, len(symbol) + 2) for w in words_of(text)]
        for at in range(max(1, len(ids) - window + 1) if ids else 0):
            found.setdefault(tuple(ids[at : at + window]), set()).add(item)
    lengths = np.array([len(w) for w in found], np.int64)
    patterns = np.zeros((len(found), window), np.int64)
    for k, w in enumerate(found):
        patterns[k, window - len(w) :] = w
    return {"symbol": symbol, "patterns": patterns, "lengths": lengths, "items": [sorted(x - {None}) for x in found.values()]}


HITS = "row long, doc_id long, n_words long, starts array<int>, ends array<int>, items array<long>"


def merge(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open spans."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], s[1:] > e[:-1]])
    return s[new], e[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(s) - 1]])]


def _search_shard(runs: list[np.ndarray], doc: list[int], offset: list[int], w: dict) -> dict[int, tuple[np.ndarray, np.ndarray, list]]:
    """doc number -> merged spans and items. ``runs`` are stretches of symbols with their document and place in it."""
    if not runs:
        return {}
    gaps = [np.concatenate([r, [1]]) for r in runs]
    begin = np.cumsum([0] + [len(g) for g in gaps[:-1]])
    index = FMIndex(np.concatenate(gaps))
    lo, hi = index.search(w["patterns"], w["lengths"])
    count = hi - lo
    total = int(count.sum())
    if not total:
        return {}
    which = np.repeat(np.arange(len(count)), count)
    rows = np.arange(total) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
    at = index.locate(rows)
    run = np.searchsorted(begin, at, side="right") - 1
    d = np.array(doc)[run]
    start = at - begin[run] + np.array(offset)[run]
    end = start + w["lengths"][which]
    out = {}
    order = np.argsort(d, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(d[order])) + 1):
        s, e = merge(start[part], end[part])
        out[int(d[part[0]])] = s, e, sorted({i for k in np.unique(which[part]).tolist() for i in w["items"][k]})
    return out


def find_hits(docs: DataFrame, windows: dict, shard_words: int = 1_000_000) -> DataFrame:
    """One row per document of ``docs`` (``row, doc_id, text``) with its merged spans of hit words, see :data:`HITS`."""
    shared = docs.sparkSession.sparkContext.broadcast(windows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        get, least = w["symbol"].get, int(w["lengths"].min()) if len(w["lengths"]) else 0
        head: list[tuple] = []
        runs: list[np.ndarray] = []
        doc: list[int] = []
        offset: list[int] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal held
            hits = _search_shard(runs, doc, offset, w)
            none = np.zeros(0, np.int64), np.zeros(0, np.int64), []
            got = [hits.get(k, none) for k in range(len(head))]
            r, i, n = zip(*head, strict=True)
            out = pa.record_batch([pa.array(r, pa.int64()), pa.array(i, pa.int64()), pa.array(n, pa.int64()), pa.array([g[0] for g in got], pa.list_(pa.int32())), pa.array([g[1] for g in got], pa.list_(pa.int32())), pa.array([g[2] for g in got], pa.list_(pa.int64()))], names=["row", "doc_id", "n_words", "starts", "ends", "items"])
            for x in (head, runs, doc, offset):
                x.clear()
            held = 0
            return out

        for b in batches:
            for row, doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                words = words_of(text.as_py())
                if least and len(words) >= least:
                    ids = np.array([get(x, 0) for x in words], np.int64)
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], (ids > 0).view(np.int8), [0]])))
                    for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                        if e - s >= least:
                            runs.append(ids[s:e])
                            doc.append(len(head))
                            offset.append(s)
                            held += e - s
                head.append((row, doc_id, len(words)))
                if held >= shard_words or len(head) >= 50_000:
                    yield flush()
        if head:
            yield flush()

    return docs.mapInArrow(run, HITS)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = 8 << 20, shard_words: int = 1_000_000) -> DataFrame:
    """One row per document: ``row, doc_id, n_words``, the merged spans of hit words (``starts``, ``ends``: word
    numbers, half-open) and the ``items`` whose windows occur."""
    spark = docs.sparkSession
    items = benchmark.select("item_id", text_of().alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    keyed = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text_of().alias("text"))
    found = []
    scratch = Scratch(spark, "decontamination") if blocks > 1 else None
    keyed = scratch.cut(keyed, "rows") if blocks > 1 else keyed  # so that a row has one number in all blocks
    for k in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        windows = windows_of([(r.item_id, r.text) for r in part.toLocalIterator()], window)
        hits = find_hits(keyed, windows, shard_words)
        found.append(hits if blocks == 1 else scratch.cut(hits, f"block{k}"))
    if blocks == 1:
        return found[0]
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    every = every.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

    def join_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans = [merge(np.array(s, np.int64), np.array(e, np.int64)) for s, e in zip(b.column("starts").to_pylist(), b.column("ends").to_pylist(), strict=True)]
            yield pa.record_batch([b.column("row"), b.column("doc_id"), b.column("n_words"), pa.array([s for s, _ in spans], pa.list_(pa.int32())), pa.array([e for _, e in spans], pa.list_(pa.int32())), b.column("items")], names=["row", "doc_id", "n_words", "starts", "ends", "items"])

    return every.mapInArrow(join_spans, HITS)


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The digest: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    hits = decontaminate(docs, benchmark, **options)
    n_hit = F.aggregate(F.zip_with("starts", "ends", lambda s, e: (e - s).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    names = F.array_join(F.sort_array(F.transform("items", lambda x: x.cast("string"))), ",")
    out = hits.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


OP7_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
v AS (SELECT DISTINCT item_id, least(len(w), 13) AS k, array_to_string(w[i:i+least(len(w), 13)-1], ' ') AS s
      FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM v),
o AS (SELECT doc_id, k, i, array_to_string(w[i:i+k-1], ' ') AS s
      FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
h AS (SELECT o.doc_id, o.i, o.k, v.item_id FROM o JOIN v ON o.s = v.s AND o.k = v.k),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM h)) GROUP BY 1),
it AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS s FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM h) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(it.n, 0) AS n_items, sha256(coalesce(it.s, '')) AS items_sha256,
       coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN it ON it.doc_id = d.doc_id
"""
