"""Language identification by a byte convolutional network.

Text is cut into windows of a fixed number of bytes; every window of the whole text is scored. Filters of several
widths slide over the bytes (one-hot input, so a filter is a table of bytes), each filter's largest response in the
window is kept, and a softmax layer gives the languages. A document gets the mean of its windows' logits, weighted by
their bytes. The network is trained in numpy on a bounded sample: at most ``per_lang`` documents per language (chosen
by a hash of the id) and ``per_doc`` windows of each, so the driver holds a few MB whatever the input.

Cases: null texts and texts without a letter are ``und`` with score 0; null languages are not learned; without
training rows everything is ``und``; rows that repeat an id are predicted one by one; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import crc_mod, read

WINDOW, WIDTHS, FILTERS = 256, (2, 3, 4), 16
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def cut_windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts (the last of each padded with 0), the text of each, and its number of bytes."""
    parts, owner, sizes = [], [], []
    for k, text in enumerate(texts):
        data = text.encode("utf-8", "replace").translate(_LOWER)
        n = -(-len(data) // WINDOW)
        parts.append(data.ljust(n * WINDOW, b"\0"))
        owner.append(np.full(n, k))
        size = np.full(n, WINDOW)
        if n:
            size[-1] = len(data) - (n - 1) * WINDOW
        sizes.append(size)
    flat = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, WINDOW)
    none = np.zeros(0, np.int64)
    return flat, np.concatenate(owner) if owner else none, np.concatenate(sizes) if sizes else none


class ByteConv:
    """Multi-width byte filters, max pooling over the window, softmax."""

    def __init__(self, classes: list[str], seed: int = 11):
        rng = np.random.default_rng(seed)
        self.classes = classes
        self.tables = [[rng.normal(0, 0.1, (256, FILTERS)).astype(np.float32) for _ in range(k)] for k in WIDTHS]
        self.out = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(classes))).astype(np.float32)
        self.bias = np.zeros(len(classes), np.float32)

    def pooled(self, x: np.ndarray, where: bool = False) -> tuple[np.ndarray, list[np.ndarray]]:
        """(windows, filters) largest responses, not below 0; with ``where`` also their places."""
        feats, places = [], []
        for tables in self.tables:
            span = WINDOW - len(tables) + 1
            z = tables[0][x[:, :span]]
            for j in range(1, len(tables)):
                z += tables[j][x[:, j : j + span]]
            if where:
                at = z.argmax(axis=1)
                places.append(at)
                feats.append(np.take_along_axis(z, at[:, None, :], 1)[:, 0])
            else:
                feats.append(z.max(axis=1))
        return np.maximum(np.concatenate(feats, axis=1), 0), places

    def logits(self, x: np.ndarray, batch: int = 64) -> np.ndarray:
        out = np.empty((len(x), len(self.classes)), np.float32)
        for at in range(0, len(x), batch):
            out[at : at + batch] = self.pooled(x[at : at + batch])[0] @ self.out + self.bias
        return out

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.05, seed: int = 5) -> ByteConv:
        """Adagrad on the cross-entropy."""
        rng = np.random.default_rng(seed)
        params = [t for tables in self.tables for t in tables] + [self.out, self.bias]
        seen = [np.full_like(p, 1e-4) for p in params]
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                part = order[at : at + batch]
                xb, n = x[part], len(part)
                h, places = self.pooled(xb, where=True)
                z = h @ self.out + self.bias
                p = np.exp(z - z.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                p[np.arange(n), y[part]] -= 1
                p /= n
                dh = (p @ self.out.T) * (h > 0)
                grads = []
                for w, at_w in enumerate(places):
                    g = dh[:, w * FILTERS : (w + 1) * FILTERS]
                    for j in range(len(self.tables[w])):
                        cell = xb[np.arange(n)[:, None], at_w + j].astype(np.int64) * FILTERS + np.arange(FILTERS)
                        grads.append(np.bincount(cell.ravel(), g.ravel(), 256 * FILTERS).reshape(256, FILTERS).astype(np.float32))
                grads += [h.T @ p, p.sum(axis=0)]
                for q, s, g in zip(params, seen, grads, strict=True):
                    s += g * g
                    q -= rate * g / np.sqrt(s)
        return self


def training_windows(docs: DataFrame, per_lang: int, per_doc: int, fold: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """A bounded sample of windows of the training rows, in a stable order."""
    rows = docs.select("doc_id", "text", "lang").where((crc_mod("doc_id", fold) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = dict(rows.groupBy("lang").count().collect())
    if not counts:
        return [], np.zeros((0, WINDOW), np.uint8), np.zeros(0, np.int64)
    share = F.create_map(*(F.lit(v) for k, n in counts.items() for v in (k, per_lang / n)))[F.col("lang")]
    chosen = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc_id, text, lang in zip(*(c.to_pylist() for c in b.columns), strict=True):
                x, _, size = cut_windows([text])
                full = np.flatnonzero(size >= min(WINDOW // 2, size.max(initial=0)))
                for k in np.unique(full[np.linspace(0, len(full) - 1, min(per_doc, len(full))).astype(int)]) if len(full) else []:
                    out.append((doc_id, lang, int(k), x[k].tobytes()))
            cols = list(zip(*out, strict=True)) if out else [[]] * 4
            yield pa.record_batch([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.binary())], names=["doc_id", "lang", "k", "x"])

    got = chosen.mapInArrow(run, "doc_id long, lang string, k int, x binary").collect()
    got.sort(key=lambda r: (r.doc_id or 0, r.k, r.x))
    classes = sorted({r.lang for r in got})
    return classes, np.frombuffer(b"".join(r.x for r in got), np.uint8).reshape(-1, WINDOW), np.array([classes.index(r.lang) for r in got], np.int64)


def train(docs: DataFrame, per_lang: int = 800, per_doc: int = 3, fold: int = 5) -> ByteConv:
    classes, x, y = training_windows(docs, per_lang, per_doc, fold)
    return ByteConv(classes).fit(x, y) if classes else ByteConv([])


def predict_rows(docs: DataFrame, model: ByteConv) -> DataFrame:
    """``row`` (a struct of all columns of ``docs``), ``lang_pred`` and ``score`` of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                texts = [t or "" for t in b.column(1).to_pylist()]
                known = np.array([bool(m.classes) and any(map(str.isalpha, t)) for t in texts], bool)
                x, owner, size = cut_windows([t if k else "" for t, k in zip(texts, known, strict=True)])
                best, score = np.full(len(texts), -1), np.zeros(len(texts))
                if len(x):
                    z = m.logits(x) * size[:, None]
                    total = np.stack([np.bincount(owner, z[:, c], len(texts)) for c in range(len(m.classes))], axis=1)
                    total /= np.maximum(np.bincount(owner, size, len(texts)), 1)[:, None]
                    p = np.exp(total - total.max(axis=1, keepdims=True))
                    p /= p.sum(axis=1, keepdims=True)
                    best[known], score[known] = p.argmax(axis=1)[known], p.max(axis=1)[known]
                names = [m.classes[k] if k >= 0 else "und" for k in best]
                yield pa.record_batch([b.column(0), pa.array(names, pa.string()), pa.array(score, pa.float64())], names=["row", "lang_pred", "score"])

    schema = T.StructType([rows.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, schema)


def predict(docs: DataFrame, model: ByteConv, fold: int = 5) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every whole text."""
    out = predict_rows(docs.select("doc_id", "text"), model)
    return out.select(F.col("row.doc_id").alias("doc_id"), (crc_mod("row.doc_id", fold) == 0).alias("held_out"), "lang_pred", "score")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return predict(docs, train(docs))
