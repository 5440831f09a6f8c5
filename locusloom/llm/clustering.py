"""Yinyang k-means over integer vectors, with exact distances and exact centroids.

Centroids are put into groups once, by a small k-means over themselves. Every vector carries its cluster, an upper bound
of the distance to its own centroid and one lower bound per group for the others. After centroids have moved, bounds
move by as much; a vector whose smallest lower bound is above its upper bound is settled at once (global filter), then
each group whose bound is above the best distance is skipped (group filter), then single centroids of a surviving group
(local filter), and only what survives is compared, in integers. Bounds are rounded outwards, so the result is that of
plain k-means with ties to the smaller number.

Vectors and bounds travel together in one table that each round rewrites (the one before goes); nothing is shuffled by
key. Centroids follow from integer sums of the vectors that changed cluster: one row per task, cluster and dimension.
The driver holds k centroids and their sums. A round in which no centroid moves ends the loop, as further ones change nothing.

Cases: vectors that are null, of another length or with null or non-finite entries are left out; null and repeated ids
are rows like others (null ids are hashed last); with fewer vectors than ``k`` there are fewer centroids; an empty table
gives no rows; extra columns are ignored. Entries whose integer reaches 2**26 raise a ValueError.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch, read
from .vectors import doubles, integers, kind_of, whole_rows

#: Relative slack of bounds, far above the rounding of square roots and their sums.
SLACK = 1e-9
#: Stands for no distance: above all squares.
NONE = 1 << 62


@dataclass
class Clusters:
    """``rows``: ``key, x, cluster, distance`` (a written table; ``x`` as little-endian int32), with k centroids, their
    sizes, and the number of distances that the last assignment computed."""

    rows: DataFrame
    centroids: np.ndarray
    sizes: np.ndarray
    compared: int


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = x - c
    return np.einsum("ij,ij->i", d, d)


def group_centroids(c: np.ndarray, groups: int, rounds: int = 5) -> np.ndarray:
    """The group of each centroid: a small k-means over the centroids, begun at evenly spaced ones."""
    groups = max(1, min(groups, len(c)))
    mid = c[np.linspace(0, len(c) - 1, groups).astype(int)].astype(float)
    of = np.zeros(len(c), int)
    for _ in range(rounds):
        of = ((c[:, None, :] - mid[None]) ** 2).sum(axis=2).argmin(axis=1)
        for g in range(groups):
            if (of == g).any():
                mid[g] = c[of == g].mean(axis=0)
    return np.unique(of, return_inverse=True)[1]


def first_assignment(x: np.ndarray, c: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Cluster, upper bound, lower bounds (rows x groups) and the number of distances."""
    d2 = np.stack([squared(x, y) for y in c], axis=1)
    a = d2.argmin(axis=1)
    d = np.sqrt(d2)
    rows = np.arange(len(x))
    upper = d[rows, a] * (1 + SLACK)
    d[rows, a] = np.inf
    lower = np.stack([d[:, group == g].min(axis=1) for g in range(group.max() + 1)], axis=1) * (1 - SLACK)
    return a, upper, lower, d2.size


def reassignment(x: np.ndarray, a: np.ndarray, upper: np.ndarray, lower: np.ndarray, old: np.ndarray, new: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The same after the centroids ``old`` have moved to ``new``."""
    drift = np.sqrt(squared(new, old)) * (1 + SLACK)
    most = np.array([drift[group == g].max() for g in range(group.max() + 1)])
    before, a = lower, a.copy()
    upper, lower = (upper + drift[a]) * (1 + SLACK), lower - most
    lower = lower - SLACK * np.abs(np.where(np.isfinite(lower), lower, 0.0))
    open_ = np.flatnonzero(lower.min(axis=1) <= upper)  # global filter
    if not len(open_):
        return a, upper, lower, 0
    own2 = squared(x[open_], new[a[open_]])
    compared = len(open_)
    upper[open_] = np.sqrt(own2) * (1 + SLACK)
    tight = lower[open_].min(axis=1) <= upper[open_]
    open_, own2 = open_[tight], own2[tight]
    was, best, best2 = a[open_], a[open_].copy(), own2.copy()
    seen: list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
    for g in range(group.max() + 1):
        at = np.flatnonzero(lower[open_, g] <= np.sqrt(best2) * (1 + SLACK))  # group filter
        if not len(at):
            continue
        xs, start = x[open_[at]], before[open_[at], g]
        first2, second2 = np.full(len(at), NONE), np.full(len(at), NONE)
        nearest = np.full(len(at), -1)
        for j in np.flatnonzero(group == g):
            mine = was[at] == j
            far = ~mine & ((start - drift[j]) * (1 - SLACK) > np.sqrt(second2))  # local filter
            todo = np.flatnonzero(~far & ~mine)
            d2 = np.full(len(at), NONE)
            d2[todo] = squared(xs[todo], new[j])
            d2[mine] = own2[at[mine]]
            compared += len(todo)
            closer = d2 < first2
            second2 = np.where(closer, first2, np.minimum(second2, d2))
            nearest = np.where(closer, j, nearest)
            first2 = np.where(closer, d2, first2)
        seen.append((g, at, nearest, first2, second2))
        better = (first2 < best2[at]) | ((first2 == best2[at]) & (nearest < best[at]))
        best[at[better]], best2[at[better]] = nearest[better], first2[better]
    moved = best != was
    # the centroid that was left counts for its group's bound from now on
    left = lower[open_[moved], group[was[moved]]]
    lower[open_[moved], group[was[moved]]] = np.minimum(left, np.sqrt(own2[moved]) * (1 - SLACK))
    for g, at, nearest, first2, second2 in seen:
        lower[open_[at], g] = np.sqrt(np.where(nearest == best[at], second2, first2)) * (1 - SLACK)
    a[open_], upper[open_] = best, np.sqrt(best2) * (1 + SLACK)
    return a, upper, lower, compared


def _table(t: pa.Table | pa.RecordBatch, x: np.ndarray, a: np.ndarray, left: np.ndarray, upper: np.ndarray, lower: np.ndarray, compared: int) -> pa.RecordBatch:
    """A batch of state rows; the batch's number of distances stands in its first row."""
    n = len(a)
    blob = lambda m, kind: pa.array([r.tobytes() for r in np.ascontiguousarray(m, kind)], pa.binary())
    count = np.zeros(n, np.int64)
    count[:1] = compared
    return pa.record_batch([t.column("key"), blob(x, "<i4"), pa.array(a.astype(np.int32)), pa.array(left.astype(np.int32)), pa.array(upper), blob(lower, "<f8"), pa.array(count)], names=["key", "x", "cluster", "previous", "upper", "lower", "compared"])


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _sums(state: DataFrame, k: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """What the vectors that changed cluster add to the sizes and sums of clusters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dims + 1), np.int64)
        for b in batches:
            x = _matrix(b.column(0), "<i4").astype(np.int64) if len(b) else np.zeros((0, dims), np.int64)
            x = np.concatenate([x, np.ones((len(x), 1), np.int64)], axis=1)
            for to, sign in ((b.column(1), 1), (b.column(2), -1)):
                to = to.to_numpy()
                for j in np.unique(to[to >= 0]):
                    total[j] += sign * x[to == j].sum(axis=0)
        some = np.flatnonzero(total.any(axis=1))
        yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array(list(total[some]), pa.list_(pa.int64()))], names=["cluster", "total"])

    parts = state.where("cluster <> previous").select("x", "cluster", "previous").mapInArrow(run, "cluster int, total array<long>")
    out = np.zeros((k, dims + 1), np.int64)
    for r in parts.select("cluster", F.posexplode("total")).groupBy("cluster", "pos").agg(F.sum("col").alias("s")).collect():  # k * (dims + 1) rows at most
        out[r.cluster, r.pos] = r.s
    return out[:, -1], out[:, :-1]


def yinyang(table: DataFrame, scratch: Scratch, key: str = "vec_id", vector: str = "embedding", dims: int = 64, k: int = 8, rounds: int = 10, seed: str = "3:", scale: float = 1024.0, groups: int | None = None) -> Clusters:
    """Cluster the vectors of ``table``. Centroids begin as the ``k`` vectors with the smallest SHA-256 of ``seed`` and key."""
    kind = kind_of(table, key)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, m = whole_rows(b.column("v"), dims)
            x = integers(m, scale)
            yield pa.record_batch([b.column("key").take(pa.array(at)), pa.array([r.tobytes() for r in x.astype("<i4")], pa.binary())], names=["key", "x"])

    points = scratch.cut(doubles(table, key, vector).mapInArrow(whole, f"key {kind}, x binary"), "points")
    begin = points.select("x", F.sha2(F.concat(F.lit(seed), F.col("key").cast("string")), 256).alias("h")).orderBy(F.asc_nulls_last("h"), "x").limit(k)
    c = np.array([np.frombuffer(r.x, "<i4") for r in begin.collect()], np.int64).reshape(-1, dims)
    k, sizes, sums = len(c), np.zeros(len(c), np.int64), np.zeros(c.shape, np.int64)
    if not k:
        return Clusters(points.select("key", "x", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), c, sizes, 0)
    group = group_centroids(c, groups or -(-k // 4))
    schema = f"key {kind}, x binary, cluster int, previous int, upper double, lower binary, compared long"

    def begin_with(c: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if len(b):
                    x = _matrix(b.column("x"), "<i4").astype(np.int64)
                    a, upper, lower, n = first_assignment(x, c, group)
                    yield _table(b, x, a, np.full(len(a), -1), upper, lower, n)

        return run

    def go_on(old: np.ndarray, new: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if len(b):
                    x, was = _matrix(b.column("x"), "<i4").astype(np.int64), b.column("cluster").to_numpy()
                    a, upper, lower, n = reassignment(x, was, b.column("upper").to_numpy(), _matrix(b.column("lower"), "<f8"), old, new, group)
                    yield _table(b, x, a, was, upper, lower, n)

        return run

    state = scratch.cut(points.mapInArrow(begin_with(c), schema), "round0")
    for r in range(1, rounds + 1):
        more, add = _sums(state, k, dims)
        sizes, sums = sizes + more, sums + add
        new = np.where(sizes[:, None] > 0, sums // np.maximum(sizes, 1)[:, None], c)
        if (new == c).all():
            break
        state = scratch.cut(state.mapInArrow(go_on(c, new), schema), f"round{r}")
        scratch.drop("points", f"round{r - 1}")
        c = new
    last = c

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                a = b.column("cluster").to_numpy()
                d2 = squared(_matrix(b.column("x"), "<i4").astype(np.int64), last[a])
                yield pa.record_batch([b.column("key"), b.column("x"), b.column("cluster"), pa.array(d2), b.column("compared")], names=["key", "x", "cluster", "distance", "compared"])

    rows = scratch.cut(state.mapInArrow(measure, f"key {kind}, x binary, cluster int, distance long, compared long"), "rows")
    more, _ = _sums(state, k, dims)
    compared = rows.agg(F.sum("compared")).first()[0]
    scratch.drop(*(n for n in scratch.names if n.startswith("round")), "points")
    return Clusters(rows.drop("compared"), last, sizes + more, compared)


def centroid_digest(c: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()


def clustered(table: DataFrame, **options) -> DataFrame:
    """One row per clustered vector: the key, ``cluster, distance, cluster_inertia, inertia, centroid_sha256``."""
    key, spark = options.get("key", "vec_id"), table.sparkSession
    found = yinyang(table, Scratch(spark, "yinyang"), **options)
    per = found.rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # k rows at most
    total = sum(r.cluster_inertia for r in per)
    said = [(r.cluster, r.cluster_inertia, total, centroid_digest(found.centroids[r.cluster])) for r in per]
    each = spark.createDataFrame(said, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.rows.join(F.broadcast(each), "cluster").select(F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op11_yinyang_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(read(spark, sf_dir, "embeddings"))


def _sql(k: int = 8, rounds: int = 10, dims: int = 64) -> str:
    """Plain k-means, unrolled: entries in long form, each round's nearest centroid and floor of the means."""
    out = [
        f"""WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST) - 1 AS r, vec_id,
  list_transform(embedding, lambda e: floor(1024 * e::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda e: isfinite(e))) = {dims}),
e AS MATERIALIZED (SELECT r, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM kept),
c0 AS MATERIALIZED (SELECT r AS c, i, v FROM e WHERE r < {k})"""
    ]
    for t in range(rounds + 1):
        out.append(f"""d{t} AS MATERIALIZED (SELECT e.r, c{t}.c, sum((e.v - c{t}.v) * (e.v - c{t}.v))::BIGINT AS d FROM e JOIN c{t} USING (i) GROUP BY ALL),
a{t} AS MATERIALIZED (SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM d{t} GROUP BY r)""")
        if t < rounds:
            out.append(f"""s{t} AS (SELECT a.c, e.i, sum(e.v)::BIGINT AS s, count(*) AS n FROM a{t} a JOIN e USING (r) GROUP BY ALL),
c{t + 1} AS MATERIALIZED (SELECT c.c, c.i, CASE WHEN s.n IS NULL THEN c.v ELSE (s.s - ((s.s % s.n) + s.n) % s.n) // s.n END AS v FROM c{t} c LEFT JOIN s{t} s USING (c, i))""")
    return ",\n".join(out) + f""",
h AS (SELECT c, sha256(string_agg(v::VARCHAR, ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY c)
SELECT k.vec_id, a.c::INTEGER AS cluster, a.d AS distance, (sum(a.d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
  (sum(a.d) OVER ())::BIGINT AS inertia, h.h AS centroid_sha256 FROM a{rounds} a JOIN kept k USING (r) JOIN h ON h.c = a.c"""


OP11_SQL = _sql()
