"""Whitening of embeddings: two passes for the covariance, LAPACK for its eigenvectors, and a broadcast projection.

Pass one sums the integer entries exactly. Pass two centres every vector with these sums (``n * x - S`` is an integer)
and adds up outer products by one matrix product per batch. Each task hands over one matrix; ``treeAggregate`` merges
them, so that the driver gets few. A third pass of the same kind takes the covariance of the whitened vectors, as a check.
The driver holds matrices of dims x dims, whatever the number of rows.

Cases: rows whose vector is null or holds null or non-finite entries are left out, and so are those of another length
than ``dims`` (when not given: the commonest length among all lists, the longer of two). Null and repeated ids are rows
like others. Components without variance (fewer vectors than dimensions, constant entries) have null ``whitened``, and
no part in the identity check; ``explained`` is null where all vectors are equal. ``deviation`` is null where it doesn't
fit into 64 bits. An empty table gives no rows; extra columns are ignored. Entries whose integer reaches 2**26 raise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import read
from .vectors import doubles, integers, kind_of, whole_rows


@dataclass
class Whitening:
    """``axes``: unit eigenvectors as rows, by falling variance; ``variances``: of all dimensions; ``rank``: how many of
    the axes have variance."""

    n: int
    sums: np.ndarray
    axes: np.ndarray
    variances: np.ndarray
    rank: int
    scale: float
    shift: int

    @property
    def dims(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return centre(x, self.n, self.sums) / self.n

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened values of integer vectors along the axes that have variance."""
        return self.centred(x) @ self.axes[: self.rank].T / np.sqrt(self.variances[: min(self.rank, len(self.axes))])


def centre(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - S``, exactly."""
    return n * x - sums


def commonest_length(table: DataFrame, vector: str) -> int:
    first = table.where(F.col(f"`{vector}`").isNotNull()).groupBy(F.size(f"`{vector}`").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return first.d if first else 0


def _merged(table: DataFrame, dims: int, scale: float, shift: int, shape: tuple[int, ...], kind: str, add: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``add(x)`` over all batches ``x`` of integer vectors: one matrix per task, merged as a tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, kind)
        for b in batches:
            x = integers(whole_rows(b.column("v"), dims)[1], scale) + shift
            if len(x):
                total += add(x)
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["total"])

    parts = table.mapInArrow(run, "total binary").rdd.map(lambda r: np.frombuffer(bytes(r.total), kind).reshape(shape))
    return parts.treeAggregate(np.zeros(shape, kind), lambda a, b: a + b, lambda a, b: a + b, depth=2)


def fit(table: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 8, dims: int | None = None, scale: float = 1024.0, shift: int = 100_000) -> Whitening:
    """Mean and covariance over all vectors of ``table``, and the leading eigenvectors."""
    dims = commonest_length(table, vector) if dims is None else dims
    rows = doubles(table, key, vector).select("v")
    first = _merged(rows, dims, scale, shift, (dims + 1,), "<i8", lambda x: np.append(x.sum(axis=0), len(x)))
    n, sums = int(first[-1]), first[:-1]
    if not n or not dims:
        return Whitening(n, sums, np.zeros((0, dims)), np.zeros(0), 0, scale, shift)

    def outer(x: np.ndarray) -> np.ndarray:
        y = centre(x, n, sums) / n
        return y.T @ y

    v = _merged(rows, dims, scale, shift, (dims, dims), "<f8", outer) / n
    values, vectors = np.linalg.eigh((v + v.T) / 2)
    values, axes = np.maximum(values[::-1], 0.0), vectors.T[::-1][:components]
    axes = axes * np.where(np.take_along_axis(axes, np.abs(axes).argmax(axis=1)[:, None], axis=1) < 0, -1.0, 1.0)
    rank = int((values[: len(axes)] > values[0] * dims * np.finfo(float).eps * 8).sum())
    return Whitening(n, sums, axes, values, rank, scale, shift)


def identity_error(table: DataFrame, model: Whitening, key: str = "vec_id", vector: str = "embedding") -> float:
    """The largest entry, as to its amount, of the covariance of the whitened vectors minus the identity."""
    if not model.rank:
        return 0.0
    shared = table.sparkSession.sparkContext.broadcast(model)

    def outer(x: np.ndarray) -> np.ndarray:
        w = shared.value.project(x)
        return w.T @ w

    v = _merged(doubles(table, key, vector).select("v"), model.dims, model.scale, model.shift, (model.rank, model.rank), "<f8", outer) / model.n
    return float(np.abs(v - np.eye(model.rank)).max())


def deviations(z: np.ndarray) -> list[int | None]:
    """Sums of squares of each row of ``z``, exactly; None where they don't fit into 64 bits."""
    if not z.size:
        return [0] * len(z)
    if float(np.abs(z).max()) ** 2 * z.shape[1] < 2.0**62:
        return np.einsum("ij,ij->i", z, z).tolist()
    exact = [sum(int(e) ** 2 for e in r) for r in z]
    return [d if d < 1 << 63 else None for d in exact]


def whitened(table: DataFrame, model: Whitening, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per vector: ``key, deviation, whitened`` (an array with one entry per component)."""
    shared, kind, n_axes = table.sparkSession.sparkContext.broadcast(model), kind_of(table, key), len(model.axes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            at, rows = whole_rows(b.column("v"), m.dims)
            x = integers(rows, m.scale) + m.shift
            w = [[*r, *[None] * (n_axes - m.rank)] for r in m.project(x).tolist()]
            yield pa.record_batch([b.column("key").take(pa.array(at)), pa.array(deviations(centre(x, m.n, m.sums)), pa.int64()), pa.array(w, pa.list_(pa.float64()))], names=["key", "deviation", "whitened"])

    return doubles(table, key, vector).mapInArrow(run, f"key {kind}, deviation long, whitened array<double>")


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read(spark, sf_dir, "embeddings")
    model = fit(table)
    trace = float(model.variances.sum())
    shares = F.array(*(F.lit(float(e / trace) if trace else None).cast("double") for e in model.variances[: len(model.axes)]))
    rows = whitened(table, model).select("key", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    error = identity_error(table, model)
    return rows.select(F.col("key").alias("vec_id"), (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
