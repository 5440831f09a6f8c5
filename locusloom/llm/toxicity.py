"""Toxicity scores from subword-bag embeddings averaged into a linear softmax.

A word is a bag of hashed character n-grams and itself. A window of words averages their embeddings; a linear softmax
over the average gives the odds. Embeddings and softmax are trained jointly in numpy: first every window of a labelled
document carries the document's label, then only the document's most toxic window does, as a document is toxic if any
part of it is. Unseen misspellings share n-grams with what was learned. A document's score is that of its worst window;
all windows of the whole text count. A run of letters of more than ``LONG`` bytes, such as a passage without ASCII
separators, is cut into pieces that each count as a word and overlap, so that no n-gram is lost.

Since the softmax is linear in the average, a word adds one number (its n-grams' sum); tasks look words up in a cache.
The training sample is bounded: about ``per_class`` toxic and ``clean`` times as many other documents,
chosen by a hash of the id (at most twice that), and ``per_doc`` windows of each.

Cases: null and wordless texts get the score of an empty window, which the bias decides; documents without a label are
scored and not learned; without training rows all scores are 0; rows that repeat an id are scored one by one; null ids
have no label; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontamination import words_of
from .scratch import crc_mod, read

WINDOW, BUCKETS, DIM, GRAMS = 32, 1 << 18, 8, (3, 4, 5)

#: Longer words are cut into pieces of ``PIECE`` bytes.
LONG, PIECE = 200, 32


def pieces_of(text: str) -> list[bytes]:
    """The words of a text, long ones cut."""
    words = words_of(text)
    if max(map(len, words), default=0) <= LONG:
        return words
    step = PIECE - max(GRAMS) + 1
    return [p for w in words for p in ([w] if len(w) <= LONG else [w[i : i + PIECE] for i in range(0, len(w) - max(GRAMS) + 1, step)])]


def grams_of(word: bytes) -> list[int]:
    """Buckets of the word's n-grams (with ends marked) and of the word itself."""
    w = b"<" + word + b">"
    return [zlib.crc32(w[i : i + n]) % BUCKETS for n in GRAMS for i in range(len(w) - n + 1)] + [zlib.crc32(word, 1) % BUCKETS]


class SubwordBag:
    """``score`` of a bucket is embedding . (softmax column 1 - column 0)."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.emb = rng.normal(0, 0.02, (BUCKETS, DIM)).astype(np.float32)
        self.soft = rng.normal(0, 0.5, (DIM, 2)).astype(np.float32)
        self.bias = np.zeros(2, np.float32)

    def bucket_scores(self) -> tuple[np.ndarray, float]:
        return (self.emb @ (self.soft[:, 1] - self.soft[:, 0])).astype(np.float64), float(self.bias[1] - self.bias[0])

    def fit(self, docs: list[tuple[int, list[list[bytes]]]], rounds: tuple[int, int] = (30, 100), rate: float = 0.003, decay: float = 0.01) -> SubwordBag:
        """``docs``: label and windows of words. Full-batch descent with momentum, first on all windows, then
        on each document's worst. One step size for all n-grams: those of a few documents hardly move."""
        scale = 0.0
        ids: dict[bytes, int] = {}
        label, doc, win, word = [], [], [], []
        for d, (y, windows) in enumerate(docs):
            label.append(y)
            for w in windows:
                k = len(doc)
                doc.append(d)
                for x in w:
                    win.append(k)
                    word.append(ids.setdefault(x, len(ids)))
        label, doc, win, word = (np.array(x, np.int64) for x in (label, doc, win, word))
        bags = [grams_of(w) for w in ids]
        size = np.array([len(b) for b in bags])
        gram, owner = np.concatenate([np.array(b) for b in bags]), np.repeat(np.arange(len(bags)), size)
        n_win, n_doc = len(doc), len(label)
        total = np.maximum(np.bincount(win, size[word], n_win), 1)
        weight = np.where(label == 1, 2.0, 1.0)
        per_doc = np.bincount(doc, minlength=n_doc)
        params = [self.emb, self.soft, self.bias]
        speed = [np.zeros_like(p) for p in params]
        for t in range(sum(rounds)):
            z, bias = self.bucket_scores()
            by_word = np.bincount(owner, z[gram], len(bags))
            odds = np.bincount(win, by_word[word], n_win) / total + bias
            if t < rounds[0]:
                coef = weight[doc] / per_doc[doc]
            else:
                order = np.lexsort((odds, doc))
                worst = order[np.append(np.flatnonzero(np.diff(doc[order])), len(order) - 1)]
                coef = np.zeros(n_win)
                coef[worst] = weight[doc[worst]]
            g = coef * (1 / (1 + np.exp(-np.clip(odds, -500, 500))) - label[doc]) / n_doc
            by_word = np.bincount(word, (g / total)[win], len(bags))
            by_gram = np.bincount(gram, by_word[owner], BUCKETS).astype(np.float32)
            scale = scale or float(np.sqrt(np.mean(by_gram[by_gram != 0] ** 2))) or 1.0
            d = self.soft[:, 1] - self.soft[:, 0]
            slope = self.emb.T @ by_gram / np.float32(max(1.0, np.abs(self.emb).max()))
            step = (by_gram[:, None] * d * (rate / scale), np.stack([-slope, slope], axis=1), np.array([-g.sum(), g.sum()], np.float32))
            for p, v, grad in zip(params, speed, step, strict=True):
                v *= 0.9
                v += grad.astype(np.float32)
                p -= v
            self.emb *= 1 - decay
        return self


def training_docs(docs: DataFrame, labels: DataFrame, per_class: int, per_doc: int, fold: int, clean: int = 2) -> list[tuple[int, list[list[bytes]]]]:
    """A bounded sample of labelled training documents as windows of words, in a stable order."""
    marked = labels.select(F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("y")).where("y IN (0, 1)").groupBy("label_id").agg(F.max("y").alias("y")).where(crc_mod("label_id", fold) != 0)
    counts = dict(marked.groupBy("y").count().collect())
    if len(counts) < 2:
        return []
    share = F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, (per_class if k else clean * per_class) / n)))[F.col("y")]
    chosen = marked.where(F.pmod(F.xxhash64("label_id"), F.lit(1_000_000)) < share * 1_000_000).limit(2 * (1 + clean) * per_class)  # the share gives about that many: the limit is only a bound
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text in b.column("text"):
                w = pieces_of(text.as_py() or "")
                starts = np.arange(0, len(w), WINDOW)
                starts = starts[np.unique(np.linspace(0, len(starts) - 1, min(per_doc, len(starts))).astype(int))] if len(starts) else starts
                out.append(b"\n".join(b" ".join(w[s : s + WINDOW]) for s in starts.tolist()))
            yield pa.record_batch([b.column("doc_id").cast(pa.int64()), b.column("y").cast(pa.int32()), pa.array(out, pa.binary())], names=["doc_id", "y", "windows"])

    got = rows.mapInArrow(run, "doc_id long, y int, windows binary").collect()
    got.sort(key=lambda r: (r.doc_id, bytes(r.windows)))
    return [(r.y, [w.split(b" ") for w in bytes(r.windows).split(b"\n")]) for r in got if r.windows]


def train(docs: DataFrame, labels: DataFrame, per_class: int = 1500, per_doc: int = 16, fold: int = 5) -> tuple[np.ndarray, float] | None:
    got = training_docs(docs, labels, per_class, per_doc, fold)
    return SubwordBag().fit(got).bucket_scores() if got else None


def predict(docs: DataFrame, model: tuple[np.ndarray, float] | None, fold: int = 5, cache: int = 500_000) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z, bias = shared.value if shared.value is not None else (None, -np.inf)

        class Words(dict):
            def __missing__(self, w: bytes) -> complex:
                if len(self) >= cache:
                    self.clear()
                g = grams_of(w)
                x = self[w] = complex(z[g].sum(), len(g))  # the sum and the number of n-grams in one value
                return x

        known = Words()
        for b in batches:
            scores = []
            for text in b.column(1):
                w = pieces_of(text.as_py() or "") if z is not None else []
                if not w:
                    scores.append(bias)
                    continue
                x = np.add.reduceat(np.fromiter(map(known.__getitem__, w), np.complex128, len(w)), np.arange(0, len(w), WINDOW))
                scores.append(float((x.real / x.imag).max()) + bias)
            p = 1 / (1 + np.exp(-np.clip(scores, -500, 500)))
            yield pa.record_batch([b.column(0).cast(pa.int64()), pa.array(p if z is not None else np.zeros(len(p)), pa.float64())], names=["doc_id", "score"])

    out = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", (crc_mod("doc_id", fold) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return predict(docs, train(docs, read(spark, sf_dir, "labels")))
