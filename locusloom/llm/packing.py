"""Best-fit packing of tokenised documents into fixed-length sequences by a distributed grouping genetic algorithm.

Documents become token ids; longer ones are cut into pieces of the sequence length. Pieces that fill a sequence are
done. The others are dealt by hash to blocks of a bounded number of pieces. For every block several islands evolve
populations of packings: crossover injects whole well-filled bins of one parent into another, drops the bins that hold
duplicates of the injected pieces, and best-fits the displaced pieces. Between epochs each island's elite migrates to
the next island of its block (a shuffle of blobs). Bins that stay loose go into a next round of fewer blocks, so that
blocks can share them.

Cases: null text is empty (one token, id 0); null or repeated ids are packed as rows of their own; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch, text_of

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"


def _encoder(tokenizer_json: str, cache_size: int = 400_000):
    """text -> little-endian uint32 ids. Words between spaces are encoded once and remembered (``cache_size`` bounds
    the memory, not the result): the tokenizer never merges over white space, nor from a letter over a full stop."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_str(tokenizer_json)
    whole, merge_word = getattr(tok, "encode_batch_fast", tok.encode_batch), tok.model.tokenize
    known: dict[str, bytes] = {"": b""}
    # bytes as the byte-level alphabet spells them: printable ones as themselves, the others from U+0100 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spelled = {b: b for b in plain} | {b: 256 + k for k, b in enumerate(x for x in range(256) if x not in plain)}

    def learn(words: set[str]) -> None:
        tails, hard = {}, []
        for w in words:
            core, tail = w, ""
            if len(w) > 1 and w[-1] in ".," and w[-2].isalnum() and w[-2].lower().isalnum():  # not of a letter that lower case makes two
                core, tail = w[:-1], w[-1]
                tails[w] = core, tail
            for x in (core, tail) if tail else (core,):
                if x in known:
                    continue
                if x.isascii():
                    if x.isalpha():  # one word, whose normal form is its lower case
                        low = x.lower()
                        if low not in known:
                            known[low] = array("I", [t.id for t in merge_word(low)]).tobytes()
                        known[x] = known[low]
                        continue
                elif x.isalpha() and x.lower().isalpha() and "\u03a3" not in x and is_normalized("NFC", x):
                    known[x] = array("I", [t.id for t in merge_word(x.lower().encode().decode("latin-1").translate(spelled))]).tobytes()
                    continue
                known[x] = b""
                hard.append(x)
        for at in range(0, len(hard), 20_000):
            part = hard[at : at + 20_000]
            for x, e in zip(part, whole(part, add_special_tokens=False), strict=True):
                known[x] = array("I", e.ids).tobytes()
        for w, (core, tail) in tails.items():
            known[w] = known[core] + known[tail]

    def encode(text: str) -> bytes:
        words = text.replace("\n", " ").split(" ")
        if missing := set(words).difference(known):
            if len(known) > cache_size:
                known.clear()
                known[""] = b""
                missing = set(words)
            learn(missing)
        return b"".join(map(known.__getitem__, words))

    return encode


def pieces(docs: DataFrame, tokenizer_json: str, seq_len: int = 2048, end_id: int = 0) -> DataFrame:
    """One row per piece of at most ``seq_len`` tokens: ``doc_id, piece, start, length, ids_crc32``."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode, end = _encoder(shared.value), np.array([end_id], "<u4").tobytes()
        for b in batches:
            out: list[tuple] = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids = encode(text.as_py()) + end
                for k, at in enumerate(range(0, len(ids), 4 * seq_len)):
                    part = ids[at : at + 4 * seq_len]
                    out.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
            yield _batch(out, PIECES)

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, PIECES)


_TYPES = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.strip().split(" ") for f in schema.split(",")]
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.record_batch([pa.array(c, _TYPES[t]) for c, (_, t) in zip(cols, fields, strict=True)], names=[n for n, _ in fields])


class _Bins:
    """Free room of open bins, indexed so that the tightest bin with enough room is found by one bit scan."""

    def __init__(self, cap: int):
        self.cap, self.mask, self.by_room = cap, 0, [[] for _ in range(cap + 1)]

    def put(self, b: int, room: int) -> None:
        self.by_room[room].append(b)
        self.mask |= 1 << room

    def take(self, need: int) -> tuple[int, int] | None:
        m = self.mask >> need
        if not m:
            return None
        room = need + (m & -m).bit_length() - 1
        stack = self.by_room[room]
        b = stack.pop()
        if not stack:
            self.mask &= ~(1 << room)
        return b, room


def best_fit(sizes: np.ndarray, items: np.ndarray, bin_of: np.ndarray, rooms: np.ndarray, cap: int) -> np.ndarray:
    """Best-fit ``items`` in the given order into bins with ``rooms`` left, opening new ones; returns ``bin_of``."""
    bins, n = _Bins(cap), len(rooms)
    for b, r in enumerate(rooms.tolist()):
        if r > 0:
            bins.put(b, r)
    for i, s in zip(items.tolist(), sizes[items].tolist(), strict=True):
        got = bins.take(s)
        b, room = got if got else (n, cap)
        n += got is None
        if room > s:
            bins.put(b, room - s)
        bin_of[i] = b
    return bin_of


def _compact(bin_of: np.ndarray) -> np.ndarray:
    return np.unique(bin_of, return_inverse=True)[1].astype(np.int32)


def _fitness(sizes: np.ndarray, bin_of: np.ndarray, cap: int) -> tuple[int, float]:
    """Fewer bins first, then the mean square of the fill."""
    fill = np.bincount(bin_of, sizes)
    return -len(fill), float(np.mean((fill / cap) ** 2)) if len(fill) else 0.0


def crossover(sizes: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int, rng: np.random.Generator) -> np.ndarray:
    """A child of ``a``: whole well-filled bins of ``b`` come in, bins of ``a`` with duplicates go, and the pieces so
    displaced are best-fitted, largest first."""
    fill_b = np.bincount(b, sizes)
    odds = (fill_b / cap) ** 4
    share = rng.uniform(0.1, 0.4)
    chosen = rng.random(len(fill_b)) < share * odds / max(odds.mean(), 1e-9)
    came = chosen[b]
    n_a = int(a.max()) + 1
    hit = np.zeros(n_a, bool)
    hit[a[came]] = True
    loose = np.bincount(a, sizes, n_a) < 0.98 * cap  # and some loosely filled bins are opened again
    hit |= loose & (rng.random(n_a) < 0.5)
    child = np.where(came, n_a + b, a)
    displaced = hit[a] & ~came
    keep = ~displaced
    child[keep] = _compact(child[keep])
    n = int(child[keep].max()) + 1 if keep.any() else 0
    rooms = cap - np.bincount(child[keep], sizes[keep], n).astype(np.int64)
    order = np.flatnonzero(displaced)
    order = order[np.argsort(-sizes[order], kind="stable")]
    return _compact(best_fit(sizes, order, child, rooms, cap))


def evolve(sizes: np.ndarray, population: list[np.ndarray], migrants: list[np.ndarray], cap: int, generations: int, size: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Best first. An empty population starts with best-fit decreasing and shuffled variants."""
    n = len(sizes)
    if not population:
        order = np.argsort(-sizes, kind="stable")
        none = np.zeros(0, np.int64)
        population = [_compact(best_fit(sizes, order, np.zeros(n, np.int64), none, cap))]
        for _ in range(size - 1):
            noisy = np.argsort(-sizes * rng.uniform(0.8, 1.0, n), kind="stable")
            population.append(_compact(best_fit(sizes, noisy, np.zeros(n, np.int64), none, cap)))
    ranked = sorted(((_fitness(sizes, p, cap), k, p) for k, p in enumerate([*population, *migrants])), key=lambda x: (x[0], -x[1]), reverse=True)
    bound = -(-int(sizes.sum()) // cap)
    for g in range(generations):
        if -ranked[0][0][0] <= bound:
            break
        i, j = sorted(rng.choice(len(ranked), 2, replace=False))
        child = crossover(sizes, ranked[i][2], ranked[j][2], cap, rng)
        ranked.append((_fitness(sizes, child, cap), 1000 + g, child))
        ranked = sorted(ranked, key=lambda x: (x[0], -x[1]), reverse=True)[:size]
    return [p for _, _, p in ranked[:size]]


BLOCK = "block long, doc_id array<long>, piece array<int>, start array<long>, length array<long>, ids_crc32 array<long>"
STATE = "block long, island int, sizes binary, population binary, elite binary, bins long, fill double"


def _blocks(items: DataFrame, n_blocks: int) -> DataFrame:
    """One row per block with its pieces as arrays, largest first. The hash deals rows evenly whatever their ids."""

    def gather(t: pa.Table) -> pa.Table:
        t = t.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
        return pa.table({"block": t.column("block").slice(0, 1), **{c: pa.array([t.column(c).to_pylist()], pa.list_(t.schema.field(c).type)) for c in cols}})

    dealt = items.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(n_blocks)))
    return dealt.groupBy("block").applyInArrow(gather, BLOCK)


def _islands(blocks: DataFrame, scratch: Scratch, tag: str, cap: int, islands: int, epochs: int, generations: int, size: int, seed: int) -> DataFrame:
    """The best packing of each block: ``block, population`` (int32 bin numbers of the best individual)."""

    def step(epoch: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                out = []
                for r in b.to_pylist():
                    sizes = np.frombuffer(r["sizes"], np.int32).astype(np.int64)
                    rng = np.random.default_rng([seed, epoch, r["block"] & 0x7FFFFFFF, r["island"]])
                    population = list(np.frombuffer(r["population"], np.int32).reshape(-1, len(sizes))) if r["population"] else []
                    migrants = list(np.frombuffer(r["elite"], np.int32).reshape(-1, len(sizes))) if r["elite"] else []
                    best = evolve(sizes, population, migrants, cap, generations, size, rng)
                    (bins, fill), flat = _fitness(sizes, best[0], cap), np.concatenate(best).astype(np.int32)
                    out.append((r["block"], r["island"], r["sizes"], flat.tobytes(), best[0].astype(np.int32).tobytes(), -bins, fill))
                yield _batch(out, STATE)

        return run

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _batch([(r["block"], i, np.array(r["length"], np.int32).tobytes(), b"", b"", 0, 0.0) for r in b.to_pylist() for i in range(islands)], STATE)

    parts = max(2, blocks.sparkSession.sparkContext.defaultParallelism)
    state = blocks.select("block", "length").mapInArrow(start, STATE)
    for epoch in range(epochs):
        if epoch:
            came = state.select("block", F.pmod(F.col("island") + 1, F.lit(islands)).cast("int").alias("island"), F.col("elite").alias("migrant"))
            state = state.join(came, ["block", "island"]).withColumn("elite", F.col("migrant")).drop("migrant")
        state = state.repartition(parts * 4, "block", "island") if not epoch else state
        state = scratch.cut(state.select(*(f.split(" ")[0] for f in STATE.split(", "))).mapInArrow(step(epoch), STATE), f"{tag}-epoch{epoch}")
    return state.groupBy("block").agg(F.max_by("elite", F.struct(-F.col("bins"), F.col("fill"), -F.col("island"))).alias("best"))


def pack(piece_rows: DataFrame, scratch: Scratch, seq_len: int = 2048, block_size: int = 8192, islands: int = 3, epochs: int = 2, generations: int = 12, population: int = 4, tight: float = 0.97, seed: int = 7) -> DataFrame:
    """Place every piece: the columns of ``piece_rows`` plus ``sequence_id`` and ``offset`` (gapless from 0).

    ``piece_rows`` must be a written table. ``block_size`` bounds what one task holds; rounds go on while loose bins
    (filled below ``tight``) fit into at most half as many blocks as before.
    """
    spark = piece_rows.sparkSession
    full = piece_rows.where(F.col("length") == seq_len).select("*", (-F.monotonically_increasing_id() - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    done, rest, n = [full], piece_rows.where(F.col("length") < seq_len), None
    for level in range(40):
        count = rest.count()
        if not count:
            break
        n_blocks = -(-count // block_size)
        last = n_blocks == 1 or (n is not None and n_blocks * 2 > n)
        n = n_blocks
        blocks = scratch.cut(_blocks(rest, n_blocks), f"blocks{level}")
        best = _islands(blocks, scratch, f"round{level}", seq_len, islands, epochs, generations, population, seed + level)

        def place(batches: Iterator[pa.RecordBatch], level: int = level, last: bool = last) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for r in b.to_pylist():
                    bin_of, sizes = np.frombuffer(r["best"], np.int32), np.array(r["length"], np.int64)
                    fill = np.bincount(bin_of, sizes)
                    settled = np.ones(len(fill), bool) if last else fill >= tight * seq_len
                    order = np.argsort(bin_of, kind="stable")
                    ends = np.cumsum(sizes[order])
                    first = np.concatenate([[0], np.cumsum(fill)[:-1]]).astype(np.int64)
                    offset = np.empty(len(sizes), np.int64)
                    offset[order] = ends - sizes[order] - first[bin_of[order]]
                    ids = (level << 57) + (int(r["block"]) << 24) + bin_of.astype(np.int64)
                    mask = settled[bin_of]
                    yield pa.record_batch(
                        [
                            pa.array(r["doc_id"], pa.int64()), pa.array(r["piece"], pa.int32()), pa.array(r["start"], pa.int64()), pa.array(r["length"], pa.int64()), pa.array(r["ids_crc32"], pa.int64()),
                            pa.array(ids, pa.int64(), mask=~mask), pa.array(offset, pa.int64(), mask=~mask),
                        ],
                        names=[f.strip().split(" ")[0] for f in PACKED.split(",")],
                    )

        placed = scratch.cut(blocks.join(best, "block").mapInArrow(place, PACKED), f"placed{level}")
        scratch.drop(f"blocks{level}", *(f"round{level}-epoch{e}" for e in range(epochs)))
        done.append(placed.where(F.col("sequence_id").isNotNull()))
        rest = placed.where(F.col("sequence_id").isNull()).drop("sequence_id", "offset")
        if last:
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, seq_len: int = 2048, **options) -> DataFrame:
    """Tokenise and pack ``docs`` (``doc_id``, ``text``). One row per piece, see :data:`PACKED`."""
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    with open(tokenizer_path, encoding="utf-8") as f:
        model = f.read()
    scratch = Scratch(docs.sparkSession, "packing")
    rows = scratch.cut(pieces(docs, model, seq_len), "pieces")
    return pack(rows, scratch, seq_len, **options)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
