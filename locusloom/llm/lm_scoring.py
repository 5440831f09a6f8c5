"""Language-model scores by a weighted backoff automaton.

The model is a bigram model with absolute discounting. Every word that training texts have is a state; an arc from
state h on word w carries log10((c(hw) - D) / c(h)); the failure arc of h leads to the root and carries the mass that
discounting freed, D * (distinct words after h) / c(h); the root's arcs carry the add-one unigrams. A text is traversed once from left to right: take the arc, or the failure arc and the root's.

No task holds the whole model. Texts are dealt to chunks of about ``chunk_bytes``; a chunk's distinct words and
bigrams go to buckets by hash, where the counts of all chunks meet; each bucket sends back, for each chunk, the totals
of what that chunk asked for, in the order asked. So every chunk builds the part of the automaton that its texts can
reach, with the counts of the whole corpus. Blobs and not single n-grams are shuffled; a frequent n-gram is one entry
per chunk. Failure weights need sums over all chunks, so the traversal counts how often each state's failure arc was
taken; each chunk sends the distinct pairs it owns of each state to buckets and gets the states' totals back the same way.

Cases: null text is empty (its only token is the end); null ids count by the crc of the empty text; rows that repeat
an id are texts of their own; an empty table gives no rows; with no training text everything is scored by the empty
model, log10(1 / 1) a token; extra columns are ignored.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .near_dedup import WordHash, words_of
from .scratch import Scratch, crc_mod, read, text_of

END, START = 0x5851F42D4C957F2D, 0x14057B7EF767814F
DISCOUNT = 0.6
_P = np.uint64(0x9E3779B97F4A7C15)


class Tokens:
    """All tokens of a chunk in a row: hashes of tokens and of bigrams, and which belong to training texts."""

    def __init__(self, texts: pa.ChunkedArray, held_out: list[bool]):
        known, parts, sizes = WordHash(), [], []
        for t in texts:
            w = words_of(t.as_py())
            parts.append(np.fromiter(map(known.__getitem__, w), np.uint64, len(w)))
            parts.append(np.array([END], np.uint64))
            sizes.append(len(w) + 1)
        self.sizes = np.array(sizes, np.int64)
        self.hash = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        first = np.cumsum(self.sizes) - self.sizes
        prev = np.empty_like(self.hash)
        prev[1:] = self.hash[:-1]
        prev[first] = START
        self.train = np.repeat(~np.array(held_out, bool), self.sizes)
        x = (prev ^ (prev >> np.uint64(31))) * _P + self.hash
        x = (x ^ (x >> np.uint64(29))) * _P
        self.pair = (x ^ (x >> np.uint64(32))) >> np.uint64(8)  # 56 bits
        # START is asked for like a word: its count is the number of training texts
        self.words, self.word_of = np.unique(np.concatenate([self.hash, prev[first]]), return_inverse=True)
        self.pairs, self.pair_at, self.pair_of = np.unique(self.pair, return_index=True, return_inverse=True)
        self.n, self.first = len(self.hash), first
        train_all = np.concatenate([self.train, self.train[first]])
        self.word_count = np.bincount(self.word_of, train_all, len(self.words)).astype(np.int64)
        self.pair_count = np.bincount(self.pair_of, self.train, len(self.pairs)).astype(np.int64)

    @staticmethod
    def edges(sorted_hashes: np.ndarray, buckets: int, bits: int = 64) -> np.ndarray:
        """Where each bucket's part of the sorted hashes begins, and the end."""
        b = ((sorted_hashes >> np.uint64(bits - 32)) * np.uint64(buckets)) >> np.uint64(32)
        return np.searchsorted(b, np.arange(buckets + 1).astype(np.uint64))


ASKED = "bucket int, chunk int, words binary, word_counts binary, pairs binary, pair_counts binary"
ANSWER = "chunk int, bucket int, words binary, pairs binary"
SEEN = "kind int, doc_id long, held_out boolean, n_tokens long, n_known long, base double, arcs double, at_root long, a array<long>, b array<long>, chunk int, bucket int, states binary, owned binary"
TOTALS = "chunk int, bucket int, distinct binary"
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, arcs double, at_root long"


def _table(rows: list[tuple], types: list, schema: str) -> pa.Table:
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in types]
    return pa.table([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=[f.strip().split(" ")[0] for f in schema.split(",")])


def _planes(x: np.ndarray, width: int) -> bytes:
    """The lowest bytes of whole numbers, all first bytes before all second ones: high bytes are mostly 0, and shuffles
    compress them away."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _from_planes(data: bytes, width: int) -> np.ndarray:
    part = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((part.shape[1], 8), np.uint8)
    out[:, :width] = part.T
    return out.view("<u8").ravel()


def _width(x: np.ndarray) -> int:
    return max(1, (int(x.max(initial=0)).bit_length() + 7) // 8)


def _steps(h: np.ndarray) -> bytes:
    """Sorted hashes: the first, and then the steps between them in as few bytes each as the largest needs."""
    if not len(h):
        return b""
    d = np.diff(h)
    width = _width(d)
    return int(h[0]).to_bytes(8, "little") + bytes([width]) + _planes(d, width)


def _from_steps(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    first = np.array([int.from_bytes(data[:8], "little")], np.uint64)
    return np.cumsum(np.concatenate([first, _from_planes(data[9:], data[8])]), dtype=np.uint64)


def _small(counts: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest needs, named by the first byte."""
    width = _width(counts)
    return bytes([width]) + _planes(counts, width)


def _from_small(data: bytes) -> np.ndarray:
    return _from_planes(data[1:], data[0]).astype(np.int64)


def _all_small(parts: list[bytes]) -> np.ndarray:
    return np.concatenate([_from_small(x) for x in parts]) if parts else np.zeros(0, np.int64)


def _ask(buckets: int):
    def run(t: pa.Table) -> pa.Table:
        k, chunk = Tokens(t.column("text"), t.column("held_out").to_pylist()), t.column("chunk")[0].as_py()
        w, p, rows = Tokens.edges(k.words, buckets), Tokens.edges(k.pairs, buckets, 56), []
        for b in range(buckets):
            ws, ps = slice(w[b], w[b + 1]), slice(p[b], p[b + 1])
            if ws.stop > ws.start or ps.stop > ps.start:
                rows.append((b, chunk, _steps(k.words[ws]), _small(k.word_count[ws]), _steps(k.pairs[ps]), _small(k.pair_count[ps])))
        return _table(rows, [pa.int32(), pa.int32()] + [pa.binary()] * 4, ASKED)

    return run


def _answer(t: pa.Table) -> pa.Table:
    """Totals of a bucket for each chunk that asked. Pairs: twice the total, plus 1 for the one chunk that counts the
    pair as distinct. Chunk -1 gets the bucket's tokens and distinct training tokens."""
    t = t.sort_by("chunk")
    rows: list[list] = [[c, t.column("bucket")[0].as_py(), b"", b""] for c in t.column("chunk").to_pylist()]
    n_tokens = n_types = 0
    for name, place in (("word", 2), ("pair", 3)):
        h = [_from_steps(x) for x in t.column(f"{name}s").to_pylist()]
        c = _all_small(t.column(f"{name}_counts").to_pylist())
        flat = np.concatenate(h)
        u, inverse = np.unique(flat, return_inverse=True)
        total = np.bincount(inverse, c, len(u)).astype(np.int64)
        if name == "word":
            real = u != np.uint64(START)
            n_tokens, n_types, sent = int(total[real].sum()), int((total[real] > 0).sum()), total[inverse]
        else:
            trained = np.flatnonzero(c > 0)
            owner = np.zeros(len(flat), np.int64)
            owner[trained[np.unique(inverse[trained], return_index=True)[1]]] = 1
            sent = 2 * total[inverse] + owner
        for r, part in zip(rows, np.split(sent, np.cumsum([len(x) for x in h])[:-1]), strict=True):
            r[place] = _small(part)
    rows.append([-1, rows[0][1], _small(np.array([n_tokens])), _small(np.array([n_types]))])
    return _table([tuple(r) for r in rows], [pa.int32(), pa.int32(), pa.binary(), pa.binary()], ANSWER)


class BackoffAutomaton:
    """The part of the model that a chunk's texts can reach. States and words are numbers below ``size``."""

    def __init__(self, word_total: np.ndarray, arcs: dict[int, float], size: int):
        self.arcs, self.size = arcs, size
        self.root = np.log10(word_total + 1.0).tolist()  # less log10 of all mass, applied at the end
        self.trained = (word_total > 0).tolist()

    def traverse(self, state: int, words: list[int]) -> tuple[float, int, dict[int, int]]:
        """Sum of arc weights, tokens scored at the root, and failure arcs taken by state."""
        arcs, root, trained, size = self.arcs.get, self.root, self.trained, self.size
        total, at_root, failed = 0.0, 0, {}
        for w in words:
            weight = arcs(state * size + w)
            if weight is None:
                total += root[w]
                at_root += 1
                if trained[state]:
                    failed[state] = failed.get(state, 0) + 1
            else:
                total += weight
            state = w
        return total, at_root, failed


def _score(key: tuple, left: pa.Table, right: pa.Table, buckets: int) -> pa.Table:
    types = [pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    right = right.sort_by("bucket")
    words = _all_small(right.column("words").to_pylist())
    pairs = _all_small(right.column("pairs").to_pylist())
    if not left.num_rows:  # chunk -1
        return _table([(2, None, None, 0, 0, 0.0, 0.0, 0, [int(words.sum())], [int(pairs.sum())], -1, -1, None, None)], types, SEEN)
    chunk = left.column("chunk")[0].as_py()
    held = left.column("held_out").to_pylist()
    k = Tokens(left.column("text"), held)
    size = len(k.words)
    before = np.concatenate([k.word_of[: k.n][:-1], [0]]) if k.n else np.zeros(0, np.int64)
    before = np.roll(before, 1) if k.n else before
    before[k.first] = k.word_of[k.n :]
    total, owner = pairs >> 1, pairs & 1
    h, w = before[k.pair_at], k.word_of[: k.n][k.pair_at]
    owned = np.bincount(h, owner, size).astype(np.int64)
    seen = total > 0
    keys = (h[seen] * size + w[seen]).tolist()
    auto = BackoffAutomaton(words, dict(zip(keys, np.log10((total[seen] - DISCOUNT) / words[h[seen]]).tolist(), strict=True)), size)
    flat, start = k.word_of[: k.n].tolist(), k.word_of[k.n :].tolist()
    base = np.add.reduceat(np.log10(words[k.word_of[: k.n]] + 1.0), k.first)
    known = np.add.reduceat((words[k.word_of[: k.n]] > 0).astype(np.int64), k.first)
    found = []
    for d, i in enumerate(k.first.tolist()):
        found.append(auto.traverse(start[d], flat[i : i + int(k.sizes[d])]))
    wanted = owned > 0
    wanted[[state for _, _, failed in found for state in failed]] = True
    place = np.cumsum(wanted) - 1
    rows = []
    for d, (doc_id, (arcs, at_root, failed)) in enumerate(zip(left.column("doc_id").to_pylist(), found, strict=True)):
        arcs += sum(n * float(np.log10(DISCOUNT / words[state])) for state, n in failed.items())
        rows.append((0, doc_id, held[d], int(k.sizes[d]), int(known[d]), float(base[d]), arcs, at_root, place[list(failed)].tolist() if failed else [], list(failed.values()), chunk, None, None, None))
    states, owned = k.words[wanted], owned[wanted]
    edge = Tokens.edges(states, buckets)
    for b in range(buckets):
        part = slice(edge[b], edge[b + 1])
        if part.stop > part.start:
            rows.append((1, None, None, 0, 0, 0.0, 0.0, 0, None, None, chunk, b, _steps(states[part]), _small(owned[part])))
    return _table(rows, types, SEEN)


def _totals(t: pa.Table) -> pa.Table:
    """Distinct training pairs of each state of a bucket, for each chunk in the order asked."""
    h = [_from_steps(x) for x in t.column("states").to_pylist()]
    u, inverse = np.unique(np.concatenate(h), return_inverse=True)
    total = np.bincount(inverse, _all_small(t.column("owned").to_pylist()), len(u)).astype(np.int64)
    parts = np.split(total[inverse], np.cumsum([len(x) for x in h])[:-1])
    rows = [(c, b, _small(x)) for c, b, x in zip(t.column("chunk").to_pylist(), t.column("bucket").to_pylist(), parts, strict=True)]
    return _table(rows, [pa.int32(), pa.int32(), pa.binary()], TOTALS)


def _fail(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """A chunk's texts with the failure arcs' weights in ``arcs``."""
    parts = [_from_small(x) for x in right.sort_by("bucket").column("distinct").to_pylist()]
    weight = np.log10(np.maximum(np.concatenate(parts), 1)) if parts else np.zeros(0)
    arcs = [x + float(weight[np.array(a, np.int64)] @ np.array(n, np.float64)) if a else x for x, a, n in zip(left.column("arcs").to_pylist(), left.column("a").to_pylist(), left.column("b").to_pylist(), strict=True)]
    names = [f.strip().split(" ")[0] for f in SCORED.split(",")]
    return pa.table([pa.array(arcs, pa.float64()) if n == "arcs" else left.column(n) for n in names], names=names)


def lm_score(docs: DataFrame, fold: int = 7, held: int = 2, chunk_bytes: int = 6 << 20) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` (log10)."""
    scratch = Scratch(docs.sparkSession, "lm")
    rows = docs.select("doc_id", text_of().alias("text"), (crc_mod("doc_id", fold) == held).alias("held_out"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, -(-size // chunk_bytes))
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int"))
    answers = dealt.groupBy("chunk").applyInArrow(_ask(chunks), ASKED).groupBy("bucket").applyInArrow(_answer, ANSWER)

    def score(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return _score(key, left, right, chunks)

    seen = scratch.cut(dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(score, SEEN), "seen")
    totals = seen.where("kind = 1").select("chunk", "bucket", "states", "owned").groupBy("bucket").applyInArrow(_totals, TOTALS)
    whole = seen.where("kind = 2").agg(F.sum(F.element_at("a", 1)), F.sum(F.element_at("b", 1))).first()
    n, v = whole[0] or 0, whole[1] or 0
    log_all = float(np.log10(n + v + 1))
    out = seen.where("kind = 0").drop("states", "owned").groupBy("chunk").cogroup(totals.groupBy("chunk")).applyInArrow(_fail, SCORED)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), (F.col("base") - F.col("n_tokens") * log_all).alias("base_score"), (F.col("arcs") - F.col("at_root") * log_all).alias("score"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score(read(spark, sf_dir, "documents"))
